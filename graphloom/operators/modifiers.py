"""Projection, binding, filtering, union, ordering and slicing of solution tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.functions.compare import ebv, is_term, sort_key
from graphloom.operators.joins import compat_join


def select(df: DataFrame, *names: str, **expressions: Column) -> DataFrame:
    """SELECT variables and ``(expression AS name)``; no argument means ``*``."""
    if not names and not expressions:
        return df
    return df.select(*names, *[e.alias(n) for n, e in expressions.items()])


def bind(df: DataFrame, name: str, expression: Column) -> DataFrame:
    if name in df.columns:
        raise ValueError(f"variable {name} is already bound")
    return df.withColumn(name, expression)


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    """FILTER: keep rows whose effective boolean value is true."""
    kind = df.select(condition.alias("c")).schema["c"].dataType
    return df.where(ebv(condition, kind))


def language_filter(df: DataFrame, term: str, *langs: str) -> DataFrame:
    """Keep rows whose literal has one of the languages; "" stands for literals without a tag."""
    lang = F.when(F.col(term)["kind"] == "lit", F.coalesce(F.col(term)["lang"], F.lit("")))
    return df.where(F.lower(lang).isin([x.lower() for x in langs]))


def union(*parts: DataFrame) -> DataFrame:
    """Bag union; a variable missing on one side is unbound there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distinct(df: DataFrame, *names: str) -> DataFrame:
    """DISTINCT on the selected variables; unbound equals unbound."""
    return (df.select(*names) if names else df).dropDuplicates()


def reduced(df: DataFrame) -> DataFrame:
    """REDUCED allows but does not require dropping duplicates: nothing to do."""
    return df


def order_by(df: DataFrame, *keys: str | Column | tuple) -> DataFrame:
    """ORDER BY; a key is a name or expression, or ``(key, "desc")``.

    Unbound comes first ascending and last descending.  A TERM sorts by datatype rank, then value.
    """
    out = []
    for key in keys:
        key, direction = key if isinstance(key, tuple) else (key, "asc")
        column = F.col(key) if isinstance(key, str) else key
        if is_term(df.select(column.alias("k")).schema["k"].dataType):
            column = sort_key(column)
        out.append(column.desc_nulls_last() if direction == "desc" else column.asc_nulls_first())
    return df.orderBy(*out)


def limit(df: DataFrame, n: int | None = None, offset: int = 0) -> DataFrame:
    if offset:
        df = df.offset(offset)
    return df if n is None else df.limit(n)


def values(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """VALUES: an inline table, ``None`` cells are unbound."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def join_values(df: DataFrame, inline: DataFrame, unbound: Sequence[str] = ()) -> DataFrame:
    """Join with an inline or caller-supplied table; ``unbound`` lists shared variables that may be unbound."""
    return compat_join(df, inline, nullable=list(unbound))


def ask(df: DataFrame) -> DataFrame:
    """ASK: one row telling whether a solution exists; the limit stops the scan at the first hit."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("result"))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select([F.col(c).alias(names.get(c, c)) for c in df.columns])
