"""Date and time functions on lexical forms.

They read the literal's own text, so the zone and missing parts (a year has no month) are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graphloom.functions.terms import parse_time, zone_offset

_ZONE = r"(Z|[+-]\d\d:\d\d)?$"


def _s(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _part(lex: Column, regex: str, ddl: str) -> Column:
    return F.when(lex.rlike(regex), F.regexp_extract(lex, regex, 1).try_cast(ddl))


def year(lex) -> Column:
    return _part(_s(lex), r"^(-?\d{4,})(?:-\d\d(?:-\d\d(?:T.*)?)?)?" + _ZONE, "bigint")


def month(lex) -> Column:
    return _part(_s(lex), r"^-?\d{4,}-(\d\d)(?:-\d\d(?:T.*)?)?" + _ZONE, "int")


def day(lex) -> Column:
    return _part(_s(lex), r"^-?\d{4,}-\d\d-(\d\d)(?:T.*)?" + _ZONE, "int")


def hours(lex) -> Column:
    """HOURS; a pure date has none."""
    return _part(_s(lex), r"^-?\d{4,}-\d\d-\d\dT(\d\d):", "int")


def minutes(lex) -> Column:
    return _part(_s(lex), r"^-?\d{4,}-\d\d-\d\dT\d\d:(\d\d)", "int")


def seconds(lex) -> Column:
    """SECONDS with their fraction."""
    return _part(_s(lex), r"^-?\d{4,}-\d\d-\d\dT\d\d:\d\d:(\d\d(?:\.\d+)?)", "double")


def tz(lex) -> Column:
    """TZ: the zone as written, "" without one."""
    lex = _s(lex)
    return F.when(lex.rlike(r"^-?\d{4,}-\d\d-\d\d"), F.regexp_extract(lex, r"^-?\d{4,}-\d\d-\d\d.*?" + _ZONE, 1))


def timezone(lex) -> Column:
    """TIMEZONE as a day-time interval; unbound without a zone."""
    lex = _s(lex)
    return F.when(tz(lex) != "", zone_offset(lex))


def now() -> Column:
    return F.current_timestamp()


def to_epoch(lex) -> Column:
    """Seconds since 1970-01-01 of a date or dateTime."""
    ts = parse_time(_s(lex))
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def timestamp_difference(a, b) -> Column:
    return _s(a) - _s(b)
