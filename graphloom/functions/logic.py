"""Conditionals and tests on terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graphloom.functions.terms import INTEGER_TYPES, REAL_TYPES, WKT, XSD, _c


def if_else(condition: Column, then, otherwise) -> Column:
    """IF: an unbound condition gives an unbound result."""
    return F.when(condition, then).when(~condition, otherwise)


def coalesce(*values) -> Column:
    return F.coalesce(*[_c(v) for v in values])


def bound(x) -> Column:
    return _c(x).isNotNull()


def is_iri(term) -> Column:
    return _c(term)["kind"] == "iri"


def is_blank(term) -> Column:
    return _c(term)["kind"] == "bnode"


def is_literal(term) -> Column:
    return _c(term)["kind"] == "lit"


def is_numeric(term) -> Column:
    term = _c(term)
    return F.when(term.isNotNull(), term["d"].isNotNull() & term["dt"].isin(
        [XSD + t for t in INTEGER_TYPES + REAL_TYPES]))


def is_geo_point(term) -> Column:
    term = _c(term)
    point = F.coalesce(term["dt"] == WKT, F.lit(False)) & term["lex"].rlike(r"(?i)^\s*POINT\s*\(")
    return F.when(term.isNotNull(), F.coalesce(point, F.lit(False)))
