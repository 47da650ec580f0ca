"""Quads at rest: Parquet copies clustered by predicate, by subject and by object.

Every copy is dealt into folders by a hash bucket of its column, so the number of folders is bounded, and sorted within them,
so that row groups have tight ranges.  A pattern reads the copy of what it binds: one folder, and there the row groups whose
range holds the constant.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.session import shared_folder
from graphloom.sources.mapping import QuadSource, distinct_quads

PREDICATE_BUCKET = "p_bucket"
N_BUCKETS = 512
#: The copies of a clustered store, by their leading column, and what each is sorted by.
ORDERS = ("p", "s", "o")
#: Quads for which the copies by subject and by object have a folder; most folders of one copy.
BUCKET_ROWS, MOST_BUCKETS = 4_000_000, 8192
#: Bytes of text that one task sorts into a copy; quads in one file of what the copies are made from.
TASK_BYTES, FILE_ROWS = 16 << 20, 1_000_000
_TEXTS = ["s", "p", "o", "g"]
_SORTED = {"p": ("p", "s"), "s": ("s", "p"), "o": ("o", "p", "s")}


def predicate_bucket(text: str, buckets: int = N_BUCKETS) -> int:
    """Bucket of a constant; the same formula as ``_bucket_column``."""
    return zlib.crc32(text.encode("utf-8")) % buckets


def _bucket_column(column: str, buckets: int = N_BUCKETS):
    return (F.crc32(F.col(column)) % buckets).cast("int")


def _write_copy(quads: DataFrame, path: str, column: str, mode: str = "error", buckets: int = N_BUCKETS, tasks: int | None = None,
                distinct: bool = False) -> None:
    """One clustered copy of a quad set; ``distinct`` makes it a set first.

    Range partitioning on (bucket, sort columns) spreads a predicate or object that holds most of the data over many
    tasks and files.  Equal quads meet in one range, so making them distinct moves nothing more.
    """
    bucket = f"{column}_bucket"
    order = [bucket, *_SORTED[column]]
    rows = quads.withColumn(bucket, _bucket_column(column, buckets))
    rows = rows.repartitionByRange(*order) if tasks is None else rows.repartitionByRange(tasks, *order)
    if distinct:
        # In the order of the copy, so equal quads stand side by side and one sort does for both.
        equal = Window.partitionBy(*dict.fromkeys([*order, *_TEXTS])).orderBy(bucket)
        rows = rows.withColumn("__n", F.row_number().over(equal)).where("__n = 1").drop("__n")
    rows.sortWithinPartitions(*order).write.mode(mode).partitionBy(bucket).parquet(path)


def write_quads(quads: DataFrame, path: str, mode: str = "error") -> None:
    """Store a quad set as one copy by predicate."""
    _write_copy(distinct_quads(quads), path, "p", mode)


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_clustered(quads: DataFrame, path: str, orders: Sequence[str] = ORDERS) -> dict[str, int]:
    """Store a quad set in several copies; the number of folders of each.

    Copies hold texts only; readers decode the objects that they use.  The quads are computed once and written out, which
    also tells how many tasks the copies need so that each task has a bounded share.  The set is de-duplicated in the
    first copy and the others are made from it.  Subjects and objects get a folder for about every BUCKET_ROWS quads, so a
    lookup opens a bounded part of the files however large the set is.
    """
    if not orders or not set(orders) <= set(ORDERS):
        raise ValueError(f"copies are some of {ORDERS}")
    spark, first, out, seen = quads.sparkSession, orders[0], {}, Observation()
    texts, size = quads.select(*_TEXTS), F.lit(0)
    for column in _TEXTS:
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    drawn = f"{shared_folder(spark)}/quads-{uuid.uuid4().hex}"
    texts.observe(seen, F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).write.option("maxRecordsPerFile", FILE_ROWS).parquet(drawn)
    texts, tasks = spark.read.schema(texts.schema).parquet(drawn), 1 + seen.get["bytes"] // TASK_BYTES
    for n, column in enumerate(orders):
        source = texts if n == 0 else spark.read.parquet(f"{path}/by_{first}").select(*_TEXTS)
        # The number of folders needs the number of quads, which for a first copy is not written yet.
        count = 0 if column == "p" else (source.distinct() if n == 0 else source).count()
        out[column] = N_BUCKETS if column == "p" else min(MOST_BUCKETS, max(1, count // BUCKET_ROWS))
        _write_copy(source, f"{path}/by_{column}", column, buckets=out[column], tasks=tasks, distinct=n == 0)
    return out


class StoredGraph(QuadSource):
    """Clustered copies of a quad set and the changes logged since they were written.

    Constants reach the scan as a bucket and as a range of the copy, and they cut down the changes too.
    """

    def __init__(self, spark: SparkSession, path: str, orders: Mapping[str, int], changes: DataFrame | None = None,
                 then: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.orders, self.changes, self.then = spark, path, dict(orders), changes, then

    def copy_for(self, predicates: Sequence[str] | None, s: str | None, o: str | None) -> str:
        """The copy that a pattern with these constants reads: a subject is rarest, a predicate commonest."""
        bound = {"s": s is not None, "o": o is not None, "p": predicates is not None}
        return next((c for c in ("s", "o", "p") if bound[c] and c in self.orders), next(c for c in ORDERS if c in self.orders))

    def quads(self, predicates: Sequence[str] | None = None, s: str | None = None, o: str | None = None) -> DataFrame:
        from graphloom.operators.updates import merge_changes, with_terms

        held = {"s": None if s is None else [s], "o": None if o is None else [o], "p": None if predicates is None else list(predicates)}
        column = self.copy_for(predicates, s, o)
        base = self.spark.read.parquet(f"{self.path}/by_{column}")
        if held[column] is not None:
            base = base.where(F.col(f"{column}_bucket").isin([predicate_bucket(x, self.orders[column]) for x in held[column]]))
        out = with_terms(_restricted(base, held)).select("s", "p", "o", "o_term", "g")
        if self.changes is not None:
            out = merge_changes(out, _restricted(self.changes, held))
        return self.then(out) if self.then else out

    def about(self, subjects: DataFrame) -> DataFrame:
        """(s, p) of all quads about ``subjects`` (s).  Objects are compared by digests, so long ones are not moved."""
        from graphloom.operators.updates import merge_changes, with_terms

        wanted = subjects.select("s").dropDuplicates()
        slim = lambda rows: rows.withColumn("o", F.sha2("o", 256)).join(wanted, "s", "left_semi")
        out = with_terms(slim(self.spark.read.parquet(f"{self.path}/by_{self.copy_for(None, None, None)}").select(*_TEXTS)))
        if self.changes is not None:
            out = merge_changes(out, slim(self.changes))
        return (self.then(out) if self.then else out).select("s", "p")

    def _and(self, step: Callable[[DataFrame], DataFrame]) -> "StoredGraph":
        before = self.then
        return StoredGraph(self.spark, self.path, self.orders, self.changes, (lambda df: step(before(df))) if before else step)

    def only(self, graphs: Sequence[str]) -> "StoredGraph":
        return self._and(lambda df: df.where(F.col("g").isin(list(graphs))))

    def without(self, graph: str) -> "StoredGraph":
        return self._and(lambda df: df.where(F.col("g") != graph))

    def merged_graphs(self, graphs: Sequence[str]) -> "StoredGraph":
        merge = lambda df: df.withColumn("g", F.lit(DEFAULT_GRAPH))
        return self.only(graphs)._and(merge if len(set(graphs)) == 1 else lambda df: distinct_quads(merge(df)))


def _restricted(rows: DataFrame, held: dict[str, list[str] | None]) -> DataFrame:
    for column, values in held.items():
        if values is not None:
            rows = rows.where(F.col(column) == values[0] if len(values) == 1 else F.col(column).isin(values))
    return rows
