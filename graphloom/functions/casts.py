"""Constructor functions of XML Schema types on plain strings.  What does not parse is unbound."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graphloom.functions.terms import number_text, parse_time


def _s(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _signless(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", ""), r"^\+", "")


def to_integer(x) -> Column:
    """xsd:integer from text: blanks around it and one leading + are accepted."""
    text = _signless(_s(x))
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))


def integer_of_number(x) -> Column:
    """xsd:integer from a number: truncated."""
    return _s(x).try_cast("bigint")


def to_decimal(x) -> Column:
    """xsd:decimal from text: no exponent."""
    text = _signless(_s(x))
    return F.when(text.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), text.try_cast("double"))


def to_double(x) -> Column:
    """xsd:double or xsd:float from text."""
    text = _signless(_s(x))
    number = text.rlike(r"^-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    special = F.lower(F.regexp_replace(text, "^-", ""))
    value = (
        F.when(special.isin("inf", "infinity"), F.lit(float("inf")))
        .when(special == "nan", F.lit(float("nan")))
    )
    return F.when(number, text.try_cast("double")).otherwise(F.when(text.startswith("-"), -value).otherwise(value))


def to_boolean(x) -> Column:
    """xsd:boolean from text: true, false, 1 and 0 only."""
    text = _s(x)
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def boolean_of_number(x) -> Column:
    return _s(x) != 0


def to_string(x) -> Column:
    """xsd:string of a double."""
    return number_text(_s(x).cast("double"))


def to_date(x) -> Column:
    text = _s(x)
    day = F.regexp_extract(text, r"^(\d{4}-\d\d-\d\d)(?:T.*)?(?:Z|[+-]\d\d:\d\d)?$", 1)
    return F.when(day != "", day.try_cast("date"))


def to_datetime(x) -> Column:
    text = _s(x)
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), parse_time(text))
