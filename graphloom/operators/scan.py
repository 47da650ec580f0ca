"""Triple-pattern scans and graph restriction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH, typed
from graphloom.sources.mapping import QuadSource, distinct_quads
from graphloom.sources.store import PREDICATE_BUCKET, predicate_bucket


def is_var(x) -> bool:
    return isinstance(x, str) and x.startswith("?")


def as_quads(graph, predicates: Sequence[str] | None = None) -> DataFrame:
    """Quads of a DataFrame, a mapped or a stored graph, cut down to constant predicates where known."""
    if isinstance(graph, QuadSource):
        return graph.quads(predicates)
    if predicates is None:
        return graph
    if PREDICATE_BUCKET in graph.columns:
        graph = graph.where(F.col(PREDICATE_BUCKET).isin([predicate_bucket(p) for p in predicates]))
    return graph.where(F.col("p").isin(list(predicates)))


def pattern(graph, s: str, p: str, o: str, g: str | None = None, as_type: str | None = None) -> DataFrame:
    """Solutions of one triple pattern.

    ``?name`` is a variable, anything else a constant in canonical text.  The same variable twice means equality.
    ``as_type`` gives the object variable as a plain typed column instead of canonical text.
    """
    held = isinstance(graph, QuadSource)
    if held:
        quads = graph.quads(None if is_var(p) else [p], s=None if is_var(s) else s, o=None if is_var(o) else o)
    else:
        quads = as_quads(graph, None if is_var(p) else [p])
    if g is not None and is_var(g):
        quads = quads.where(F.col("g") != DEFAULT_GRAPH)
    parts = [("s", s), ("p", p), ("o", o)] + ([("g", g)] if g is not None else [])
    first: dict[str, str] = {}
    for column, value in parts:
        if not is_var(value):
            # Mapped and stored graphs have already compared subject, predicate and object with their own columns.
            if column == "g" or not held:
                quads = quads.where(F.col(column) == F.lit(value))
        elif value in first:
            quads = quads.where(F.col(column) == F.col(first[value]))
        else:
            first[value] = column
    out = []
    for var, column in first.items():
        value = F.col(column)
        if column == "o" and as_type:
            value = typed(F.col("o_term"), as_type)
        out.append(value.alias(var[1:]))
    return quads.select(*out) if out else quads.select(F.lit(True).alias("matched"))


def from_graphs(graph, graphs: Sequence[str]):
    """FROM: the listed graphs merged into one default graph, as a set of triples."""
    if isinstance(graph, QuadSource):
        return graph.merged_graphs(graphs)
    merged = graph.where(F.col("g").isin(list(graphs))).withColumn("g", F.lit(DEFAULT_GRAPH))
    return merged if len(set(graphs)) == 1 else distinct_quads(merged)


def from_named(graph, graphs: Sequence[str]):
    """FROM NAMED: only the listed graphs can be reached by a graph variable."""
    if isinstance(graph, QuadSource):
        return graph.only(graphs)
    return graph.where(F.col("g").isin(list(graphs)))


def graph_only(graph, name: str):
    return from_named(graph, [name])


def graph_except(graph, name: str):
    if isinstance(graph, QuadSource):
        return graph.without(name)
    return graph.where(F.col("g") != name)
