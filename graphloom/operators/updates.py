"""Updates as set operations on quads ``(s, p, o, g)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH, QUADS_DDL, parse_term
from graphloom.operators.construct import instantiate

KEY = ["s", "p", "o", "g"]


def with_terms(quads: DataFrame) -> DataFrame:
    """Add the decoded object to quads that lack it."""
    if "o_term" in quads.columns:
        return quads
    return quads.withColumn("o_term", parse_term("o")).select("s", "p", "o", "o_term", "g")


def quads_of(spark, rows: Sequence[Sequence[str]], graph: str = DEFAULT_GRAPH) -> DataFrame:
    """Quads of literal data: (s, p, o) or (s, p, o, g)."""
    full = [tuple(r) if len(r) == 4 else (*r, graph) for r in rows]
    return with_terms(spark.createDataFrame(full, "s string, p string, o string, g string"))


def none(spark) -> DataFrame:
    return spark.createDataFrame([], QUADS_DDL)


def apply_update(base: DataFrame, inserts: DataFrame | None = None, deletes: DataFrame | None = None) -> DataFrame:
    """``base`` without the deletes, plus the inserts, as a set.

    Deletes come first, so a quad in both sets ends up inserted.  The base meets the change sets in one anti-join; it is
    never de-duplicated as a whole, and small change sets are broadcast by Spark so that it is not even shuffled.
    """
    columns = [*KEY[:3], "o_term", "g"]
    touched = [c.select(KEY) for c in (inserts, deletes) if c is not None]
    if not touched:
        return base.select(columns)
    kept = base.join(reduce(DataFrame.unionByName, touched), KEY, "left_anti").select(columns)
    if inserts is None:
        return kept
    return kept.unionByName(with_terms(inserts.select(KEY).dropDuplicates()).select(columns))


def update_where(base: DataFrame, solutions: DataFrame, insert: Sequence[Sequence[str]] = (),
                 delete: Sequence[Sequence[str]] = (), graph: str = DEFAULT_GRAPH,
                 row_key: Sequence[str] | None = None) -> DataFrame:
    """DELETE/INSERT WHERE: templates over the solutions of the WHERE part; ``graph`` is the WITH graph."""
    inserts = instantiate(solutions, insert, row_key, graph) if insert else None
    deletes = instantiate(solutions, delete, row_key, graph) if delete else None
    return apply_update(base, inserts, deletes)


def clear(base: DataFrame, target: str) -> DataFrame:
    """CLEAR or DROP: "ALL", "DEFAULT", "NAMED" or a graph name."""
    if target == "ALL":
        return base.where(F.lit(False))
    if target == "DEFAULT":
        return base.where(F.col("g") != DEFAULT_GRAPH)
    if target == "NAMED":
        return base.where(F.col("g") == DEFAULT_GRAPH)
    return base.where(F.col("g") != target)


drop = clear


def create(base: DataFrame, graph: str) -> DataFrame:
    """CREATE: graphs exist by their quads, so nothing changes."""
    return base


def add_graph(base: DataFrame, source: str, target: str) -> DataFrame:
    """ADD: the source graph's triples also go to the target."""
    if source == target:
        return base
    return apply_update(base, base.where(F.col("g") == source).withColumn("g", F.lit(target)))


def copy_graph(base: DataFrame, source: str, target: str) -> DataFrame:
    """COPY: the target becomes a copy of the source."""
    if source == target:
        return base
    moved = base.where(F.col("g") == source).withColumn("g", F.lit(target))
    return clear(base, target).unionByName(moved)


def move_graph(base: DataFrame, source: str, target: str) -> DataFrame:
    """MOVE: a rename, done in one pass."""
    if source == target:
        return base
    return clear(base, target).withColumn("g", F.when(F.col("g") == source, target).otherwise(F.col("g")))


def graph_read(base: DataFrame, graph: str) -> DataFrame:
    """GET on one graph."""
    return base.where(F.col("g") == graph).select("s", "p", "o")


def graph_drop(base: DataFrame, graph: str) -> DataFrame:
    return clear(base, graph)


def graph_insert(base: DataFrame, graph: str, triples: DataFrame) -> DataFrame:
    """POST on one graph."""
    return apply_update(base, triples.withColumn("g", F.lit(graph)))


def graph_replace(base: DataFrame, graph: str, triples: DataFrame) -> DataFrame:
    """PUT on one graph."""
    new = with_terms(triples.withColumn("g", F.lit(graph)).select(KEY).dropDuplicates())
    return clear(base, graph).unionByName(new.select(base.columns))


def latest(changes: DataFrame) -> DataFrame:
    """The last operation per quad of a change log ``(op, s, p, o, g, seq)``, by batch (``at``, if given) and ``seq``."""
    order = F.struct("at", "seq") if "at" in changes.columns else F.col("seq")
    return changes.groupBy(KEY).agg(F.max_by("op", order).alias("op"))


def merge_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """State after a change log; only the log is grouped, and the base meets it once."""
    columns = [*KEY[:3], "o_term", "g"]
    last = latest(changes)
    kept = base.join(last.select(KEY), KEY, "left_anti").select(columns)
    return kept.unionByName(with_terms(last.where("op = 'insert'").select(KEY)).select(columns))


def diff(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(inserted, deleted)`` between two states."""
    both = (old.select(KEY).withColumn("side", F.lit(1)).unionByName(new.select(KEY).withColumn("side", F.lit(2)))
            .groupBy(KEY).agg(F.bit_or("side").alias("sides")))
    return both.where("sides = 2").select(KEY), both.where("sides = 1").select(KEY)


def effective(base: DataFrame, changes: DataFrame) -> DataFrame:
    """The last operations that change the base: no inserts of present quads, no deletes of absent ones."""
    last = latest(changes)
    held = base.select(*KEY, F.lit(True).alias("__held"))
    return last.join(held, KEY, "left").where((F.col("op") == "insert") == F.col("__held").isNull()).select(*KEY, "op")


def delta_statistics(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Numbers of effective inserts and deletes."""
    return effective(base, changes).agg(
        F.count(F.when(F.col("op") == "insert", 1)).alias("n_inserted"),
        F.count(F.when(F.col("op") == "delete", 1)).alias("n_deleted"))
