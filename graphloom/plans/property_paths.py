"""Property paths as a small algebra over edge tables ``(start, end)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.operators.scan import as_quads, is_var, pattern
from graphloom.plans.skew import packed_join
from graphloom.plans.transitive import reach
from graphloom.session import cut_lineage


class Path:
    def __truediv__(self, other: "Path") -> "Path":
        return Sequence_((self, other))

    def __or__(self, other: "Path") -> "Path":
        return Alternative((self, other))

    def __invert__(self) -> "Path":
        return Inverse(self)

    def repeat(self, low: int, high: int | None = None) -> "Path":
        return Repeat(self, low, high)

    def plus(self) -> "Path":
        return Repeat(self, 1, None)

    def star(self) -> "Path":
        return Repeat(self, 0, None)

    def maybe(self) -> "Path":
        return Repeat(self, 0, 1)


@dataclass(frozen=True)
class Step(Path):
    predicate: str


@dataclass(frozen=True)
class Inverse(Path):
    inner: Path


@dataclass(frozen=True)
class Sequence_(Path):
    parts: tuple


@dataclass(frozen=True)
class Alternative(Path):
    parts: tuple


@dataclass(frozen=True)
class Negated(Path):
    """Any predicate but the listed ones; ``inverse`` lists the ones excluded backwards."""

    forward: tuple = ()
    inverse: tuple | None = None


@dataclass(frozen=True)
class Repeat(Path):
    inner: Path
    low: int
    high: int | None

    def __post_init__(self):
        if self.low < 0 or (self.high is not None and self.high < self.low):
            raise ValueError("path bounds must satisfy 0 <= low <= high")


def edges(graph, path: Path | str, g: str | None = None, start: str | DataFrame | None = None,
          end: str | DataFrame | None = None) -> DataFrame:
    """All ``(start, end)`` pairs of a path.

    Sequences and alternatives keep duplicates; repetitions are sets.  ``start`` and ``end`` are a constant or a table of
    nodes (its first column); they seed repetitions, so that these search from there and never build the full closure.
    Within a sequence the nodes that one part reaches seed the next one.  ``g`` is a constant graph, or a variable: then
    every path stays within one named graph, which is a further column.
    """
    path = Step(path) if isinstance(path, str) else path
    pairs = _per_graph(graph, path, g[1:]) if g and is_var(g) else _edges(graph, path, g, start, end)
    return _at(_at(pairs, "start", start), "end", end)


def _at(pairs: DataFrame, column: str, bound: str | DataFrame | None) -> DataFrame:
    """Pairs whose ``column`` is the constant or in the table."""
    if bound is None:
        return pairs
    if isinstance(bound, str):
        return pairs.where(F.col(column) == bound)
    nodes = bound.select(F.col(bound.columns[0]).alias("__node"))
    return pairs.join(nodes, F.col(column) == F.col("__node"), "left_semi")


def _nodes(spark, bound: str | DataFrame | None, name: str) -> DataFrame | None:
    if bound is None:
        return None
    if isinstance(bound, str):
        return spark.createDataFrame([(bound,)], f"{name} string")
    return bound.select(F.col(bound.columns[0]).alias(name)).dropDuplicates()


def _repeats(path: Path) -> bool:
    """Does the path hold a repetition, which gains from seeds?"""
    if isinstance(path, Repeat):
        return True
    return any(map(_repeats, getattr(path, "parts", [path.inner] if hasattr(path, "inner") else [])))


def _per_graph(graph, path: Path, name: str) -> DataFrame:
    """Nodes are tagged with their graph, so that no step can lead into another one."""
    quads = as_quads(graph).where(F.col("g") != DEFAULT_GRAPH)
    tag = lambda c: F.concat(F.col("g"), F.lit(" "), F.col(c)).alias(c)
    pairs = _edges(quads.select(tag("s"), "p", tag("o"), "o_term", "g"), path, None, None, None)
    bare = lambda c: F.substring(F.col(c), F.position(F.lit(" "), F.col(c)) + 1, F.length(c)).alias(c)
    return pairs.select(bare("start"), bare("end"), F.substring_index("start", " ", 1).alias(name))


def _edges(graph, path: Path, g, start, end) -> DataFrame:
    if isinstance(path, Step):
        return pattern(graph, "?start", path.predicate, "?end", g)
    if isinstance(path, Inverse):
        return _swap(_edges(graph, path.inner, g, end, start))
    if isinstance(path, Sequence_):
        return _sequence(graph, path, g, start, end)
    if isinstance(path, Alternative):
        return reduce(DataFrame.unionByName, [_edges(graph, p, g, start, end) for p in path.parts])
    if isinstance(path, Negated):
        return _negated(graph, path, g)
    if isinstance(path, Repeat):
        inner = _edges(graph, path.inner, g, None, None)
        spark = inner.sparkSession
        seeds, targets = _nodes(spark, start, "start"), _nodes(spark, end, "end")
        return reach(inner, path.low, path.high, seeds, targets, nodes=graph_nodes(graph, g) if path.low == 0 else None)
    raise TypeError(f"not a path: {path!r}")


def _sequence(graph, path: Sequence_, g, start, end) -> DataFrame:
    """The parts of a sequence, the bound one first; its nodes seed repetitions in the other."""
    one, two = path.parts
    backwards = start is None and (end is not None or _repeats(one) and not _repeats(two))
    if backwards:
        second = _at(_edges(graph, two, g, None, end), "end", end)
        if _repeats(one):
            second = cut_lineage(second, "sequence")
        first = _edges(graph, one, g, None, second.select("start") if _repeats(one) else None)
    else:
        first = _at(_edges(graph, one, g, start, None), "start", start)
        if _repeats(two):
            first = cut_lineage(first, "sequence")
        second = _edges(graph, two, g, first.select("end") if _repeats(two) else None, end)
    first, second = first.withColumnRenamed("end", "__mid"), second.withColumnRenamed("start", "__mid")
    if _objects(one, last=True) and _objects(two, last=False):
        # Many subjects may share an object, so a node may have very many edges on both sides.
        return packed_join(first, second, ["__mid"]).select("start", "end")
    return first.join(second, "__mid").select("start", "end")


def _objects(path: Path, last: bool) -> bool:
    """Are the nodes where a path ends (``last``) or starts objects of its triples, and not subjects?"""
    if isinstance(path, Step):
        return last
    if isinstance(path, Inverse):
        return _objects(path.inner, not last)
    if isinstance(path, Sequence_):
        return _objects(path.parts[-1 if last else 0], last)
    if isinstance(path, Alternative):
        return any(_objects(p, last) for p in path.parts)
    return isinstance(path, Negated)


def _negated(graph, path: Negated, g) -> DataFrame:
    quads = as_quads(graph)
    if g is not None:
        quads = quads.where(F.col("g") == g)
    parts = []
    if path.forward or path.inverse is None:
        kept = quads.where(~F.col("p").isin(list(path.forward))) if path.forward else quads
        parts.append(kept.select(F.col("s").alias("start"), F.col("o").alias("end")))
    if path.inverse:
        kept = quads.where(~F.col("p").isin(list(path.inverse)))
        parts.append(kept.select(F.col("o").alias("start"), F.col("s").alias("end")))
    return reduce(DataFrame.unionByName, parts)


def _swap(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("end").alias("start"), F.col("start").alias("end"))


def graph_nodes(graph, g: str | None = None) -> DataFrame:
    """Every subject and object once."""
    quads = as_quads(graph)
    if g is not None:
        quads = quads.where(F.col("g") == g)
    return quads.select(F.explode(F.array("s", "o")).alias("node")).dropDuplicates()


def alternatives(*predicates: str) -> Path:
    return Alternative(tuple(Step(p) for p in predicates))


def sequence(*parts: Path | str) -> Path:
    steps: Sequence[Path] = [Step(p) if isinstance(p, str) else p for p in parts]
    return reduce(lambda a, b: Sequence_((a, b)), steps)
