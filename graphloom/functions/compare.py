"""Comparison, ordering and truth of values that may have any datatype."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from graphloom.functions.terms import XSD, _c


def is_term(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.names[:4] == ["kind", "lex", "dt", "lang"]


# Order of the datatypes in ORDER BY, MIN and MAX; unbound comes before all of them.
RANKS = {"boolean": 1, "number": 2, "text": 3, "iri": 3, "date": 4, "bnode": 5}


def _rank(term: Column) -> Column:
    return (
        F.when(term["b"].isNotNull(), RANKS["boolean"])
        .when(term["d"].isNotNull(), RANKS["number"])
        .when(term["ts"].isNotNull(), RANKS["date"])
        .when(term["kind"] == "bnode", RANKS["bnode"])
        .when(term.isNotNull(), RANKS["text"])
    )


def sort_key(term) -> Column:
    """A struct whose natural order is the order of ORDER BY; NULL for unbound.

    Whole numbers order by their exact value where the double form ties.
    """
    term = _c(term)
    number = F.coalesce(term["b"].cast("double"), term["d"])
    text = F.when(term["ts"].isNull() & number.isNull(), term["lex"])
    return F.when(
        term.isNotNull(),
        F.struct(
            _rank(term).alias("rank"), number.alias("number"), term["i"].alias("whole"), term["ts"].alias("time"),
            F.when(text.isNotNull(), F.when(term["kind"] == "lit", 0).otherwise(1)).alias("form"),
            text.alias("text"), term["lang"].alias("lang"),
        ),
    )


def _class(term: Column) -> Column:
    return (
        F.when(term["b"].isNotNull(), "boolean").when(term["d"].isNotNull(), "number")
        .when(term["ts"].isNotNull(), "time").otherwise(F.concat(term["kind"], F.lit(":"), F.coalesce(term["dt"], F.lit(""))))
    )


def _compare(a, b, op: str) -> Column:
    a, b = _c(a), _c(b)

    def apply(x: Column, y: Column) -> Column:
        return {
            "=": x == y, "!=": x != y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y,
        }[op]

    exact = a["i"].isNotNull() & b["i"].isNotNull()
    # A comparison with NaN is false, except that NaN differs from everything.
    nan = F.isnan(a["d"]) | F.isnan(b["d"])
    number = F.when(exact, apply(a["i"], b["i"])).when(nan, F.lit(op == "!=")).otherwise(apply(a["d"], b["d"]))
    text = (
        F.when(a["lang"].eqNullSafe(b["lang"]), apply(a["lex"], b["lex"]))
        .otherwise(apply(F.struct(a["lex"], F.coalesce(a["lang"], F.lit(""))),
                         F.struct(b["lex"], F.coalesce(b["lang"], F.lit("")))))
    )
    return (
        F.when(a["b"].isNotNull() & b["b"].isNotNull(), apply(a["b"], b["b"]))
        .when(a["d"].isNotNull() & b["d"].isNotNull(), number)
        .when(a["ts"].isNotNull() & b["ts"].isNotNull(), apply(a["ts"], b["ts"]))
        .when(_class(a) == _class(b), text)
    )


def term_eq(a, b) -> Column:
    """Typed ``=``; NULL for incompatible datatypes.  The other comparisons follow the same rule."""
    return _compare(a, b, "=")


def term_ne(a, b) -> Column:
    return _compare(a, b, "!=")


def term_lt(a, b) -> Column:
    return _compare(a, b, "<")


def term_le(a, b) -> Column:
    return _compare(a, b, "<=")


def term_gt(a, b) -> Column:
    return _compare(a, b, ">")


def term_ge(a, b) -> Column:
    return _compare(a, b, ">=")


def term_in(a, *options) -> Column:
    """IN: a chain of ``=`` joined by OR, so an incompatible option is unbound, not false."""
    out = F.lit(False)
    for option in options:
        out = out | term_eq(a, option)
    return out


def term_not_in(a, *options) -> Column:
    return ~term_in(a, *options)


def ebv(value: Column, kind: T.DataType) -> Column:
    """Effective boolean value.  0, NaN, false and "" are false; blank nodes and unbound are unbound."""
    if is_term(kind):
        number = (value["d"] != 0) & ~F.isnan(value["d"])
        return (
            F.when(value["b"].isNotNull(), value["b"])
            .when(value["d"].isNotNull(), number)
            .when((value["kind"] == "iri") | value["ts"].isNotNull(), True)
            .when(value["kind"] == "lit", F.when(value["dt"].isin(XSD + "string") | value["lang"].isNotNull(),
                                                 value["lex"] != "").otherwise(True))
        )
    if isinstance(kind, T.BooleanType):
        return value
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value != 0) & ~F.isnan(value)
    if isinstance(kind, T.NumericType):
        return value != 0
    if isinstance(kind, T.StringType):
        return value != ""
    return F.when(value.isNotNull(), True)


def logical_not(value: Column, kind: T.DataType) -> Column:
    return ~ebv(value, kind)


