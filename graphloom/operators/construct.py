"""CONSTRUCT: triples or quads from a template and a solution table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.operators.scan import is_var


def _cell(value: str, row_key: Sequence[str]) -> Column:
    if is_var(value):
        return F.col(value[1:])
    if value.startswith("_:"):
        keys = [F.coalesce(F.col(k).cast("string"), F.lit("\x01")) for k in row_key]
        return F.concat(F.lit("_:b"), F.md5(F.concat_ws("\x00", F.lit(value), *keys)))
    return F.lit(value)


def instantiate(df: DataFrame, template: Sequence[Sequence[str]], row_key: Sequence[str] | None = None,
                graph: str = DEFAULT_GRAPH) -> DataFrame:
    """``(s, p, o, g)`` of each template entry ``(s, p, o[, g])`` and row; entries with an unbound position are skipped.

    ``?name`` is a variable in canonical text.  ``_:label`` is a blank node, fresh per row: its label is made from the
    columns ``row_key``, so repeating a lost task gives the same node.  Without a key it is made from all columns and
    equal rows are numbered, which costs a shuffle that a unique key saves.
    """
    key = list(row_key) if row_key is not None else df.columns
    if row_key is None and any(x.startswith("_:") for entry in template for x in entry):
        # Equal rows are interchangeable, so any order among them will do.
        same = Window.partitionBy(*df.columns).orderBy(F.lit(0))
        df = df.withColumn("__nth", F.row_number().over(same))
        key = [*key, "__nth"]
    entries = []
    for entry in template:
        s, p, o = (_cell(x, key) for x in entry[:3])
        g = _cell(entry[3], key) if len(entry) > 3 else F.lit(graph)
        valid = [~s.startswith('"'), p.startswith("<")]
        triple = F.struct(s.alias("s"), p.alias("p"), o.alias("o"), g.alias("g"))
        bound = reduce(Column.__and__, [x.isNotNull() for x in (s, p, o, g)] + valid)
        entries.append(F.when(bound, triple))
    exploded = df.select(F.explode(F.array(*entries)).alias("t")).where("t is not null")
    return exploded.select("t.s", "t.p", "t.o", "t.g")


def construct(df: DataFrame, template: Sequence[Sequence[str]], row_key: Sequence[str] | None = None,
              distinct: bool = False) -> DataFrame:
    """CONSTRUCT; ``distinct`` removes duplicate triples over the whole result."""
    triples = instantiate(df, template, row_key).select("s", "p", "o")
    return triples.dropDuplicates() if distinct else triples
