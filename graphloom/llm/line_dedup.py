"""Line de-duplication by levelled sorted runs of line hashes.

A run holds one row per line key: two 64-bit hashes of it, the number of documents that hold it and the largest id among
them, bucketed and sorted by hash.  A batch of documents is summed up to such rows, merge-anti-joined with every run (keys
that a run has already found in enough documents, with a larger id, need no further row) and added as a run of the
lowest level.  As soon as a level has ``fanout`` runs they are merged into one run of the next level, so a row is
rewritten once per level.  At the end the runs are merged, and the lines of repeated keys go, except in the largest document.

Only DataFrame functions are used.  Hot lines: a batch is summed per task before it is dealt by key, so a line in a third of
all documents sends one row per task; the final join of lines and repeated keys is a sort-merge join that adaptive
execution splits.

Nulls, ties and odd rows: a null or empty text is one empty line; rows without an id count as one document below all
others; rows that share an id are one document, and each of them is cleaned on its own; equal rows give equal rows.  A
line of any length is hashed whole.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.llm.common import table
from graphloom.session import cut_lineage, shared_folder, task_count
from graphloom.sources.commitlog import CommitLog

#: Shortest key that may be dropped, in code points; documents from which on a key is repeated.
MIN_CHARS, MIN_DOCS = 40, 5
#: Runs of a level that are merged; batches into which one table is dealt.
FANOUT, BATCHES = 2, 4

_RUN = "h bigint, g bigint, docs bigint, largest bigint"
_KEY = ["h", "g"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    """The lines of a text, in order; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without spaces and control spaces at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    # ``lower`` changes more than A-Z, but not in a text of ASCII bytes, and is much faster there.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _row() -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, row, pos, h, g: every line that is long enough to be dropped."""
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row().alias("row"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    long = split.where(F.length(F.btrim("line", F.lit(" \t\n\x0b\x0c\r"))) >= min_chars).select("doc_id", "row", "pos", line_key(F.col("line")).alias("k"))
    return long.select("doc_id", "row", "pos", F.xxhash64("k").alias("h"), F.xxhash64(F.lit("g"), "k").alias("g"))


class LineRuns:
    """The runs in a folder.  Which runs count is the newest entry of a log, so a job that dies leaves the runs before it.

    Batches may come in any order, but a document's rows come in one batch.
    """

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder.rstrip("/"), min_docs, fanout
        self.log = CommitLog(spark, f"{self.folder}/log")
        self.buckets = buckets or task_count(spark)

    def levels(self) -> list[list[dict]]:
        """The runs of each level, lowest level first; a run is its folder and its number of buckets."""
        last = self.log.last()
        return self.log.get(last)["levels"] if last >= 0 else []

    def run(self, run: dict) -> DataFrame:
        """A run as a table: bucketed, so that joining it by hash moves the other side only."""
        name = f"line_run_{run['path'].rsplit('/', 1)[1]}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({_RUN}) USING parquet CLUSTERED BY (h) SORTED BY (h, g) INTO {run['buckets']} BUCKETS LOCATION '{run['path']}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame) -> dict:
        """Write rows that are dealt by h as a run."""
        name = uuid.uuid4().hex
        path = f"{self.folder}/runs/{name}"
        (rows.sortWithinPartitions("h", "g").write.bucketBy(self.buckets, "h").sortBy("h", "g")
         .option("path", path).format("parquet").saveAsTable(f"line_run_{name}"))
        return {"path": path, "buckets": self.buckets}

    def merged(self, runs: list[dict]) -> DataFrame:
        """One row per key of several runs."""
        rows = self.run(runs[0])
        for run in runs[1:]:
            rows = rows.unionByName(self.run(run))
        # Dealt explicitly: the union of bucketed tables is not bucketed.
        return rows.repartition(self.buckets, "h").groupBy(*_KEY).agg(F.sum("docs").alias("docs"), F.max("largest").alias("largest"))

    def add(self, batch: DataFrame) -> None:
        """Add the lines (doc_id, h, g) of a batch of documents."""
        levels = self.levels()
        fresh = batch.select(*_KEY, "doc_id").distinct().groupBy(*_KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("largest"))
        for known in [r for level in levels for r in level]:
            done = self.run(known).where(F.col("docs") >= self.min_docs).select(*_KEY, F.col("largest").alias("known"))
            fresh = fresh.join(done, (fresh["h"] == done["h"]) & (fresh["g"] == done["g"]) & (done["known"] >= fresh["largest"]), "left_anti")
        levels = [list(level) for level in levels] or [[]]
        levels[0].append(self._write(fresh.repartition(self.buckets, "h")))
        k = 0
        while k < len(levels) and len(levels[k]) >= self.fanout:
            if k + 1 == len(levels):
                levels.append([])
            levels[k + 1].append(self._write(self.merged(levels[k])))
            levels[k] = []
            k += 1
        self.log.put(self.log.last() + 1, {"levels": levels})

    def repeated(self) -> DataFrame:
        """h, g, largest: keys in at least ``min_docs`` documents."""
        runs = [r for level in self.levels() for r in level]
        if not runs:
            return self.spark.createDataFrame([], "h bigint, g bigint, largest bigint")
        return self.merged(runs).where(F.col("docs") >= self.min_docs).select(*_KEY, "largest")

    def forget(self) -> None:
        """Take the tables out of the session's catalog; the files stay."""
        for level in self.levels():
            for run in level:
                self.spark.sql(f"DROP TABLE IF EXISTS line_run_{run['path'].rsplit('/', 1)[1]}")


def drop_lines(docs: DataFrame, rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text; ``rows`` are their lines, ``repeated`` the keys that go."""
    gone = (
        rows.join(repeated, _KEY).where(~F.col("doc_id").eqNullSafe(F.col("largest")))
        .groupBy("doc_id", "row").agg(F.collect_set("pos").alias("__gone")).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "__gone")
    )
    # Texts are split after the join, so that it moves them once.
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (_row() == F.col("__row")), "left").withColumn("__lines", lines(F.col("text")))
    count = F.size("__lines")
    # Numbers of lines that stay: array_except keeps the order and takes linear time.
    kept = F.array_except(F.sequence(F.lit(0), count - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at("__lines", i + 1)), "\n"))
    return joined.select(
        *docs.columns, count.cast("bigint").alias("n_lines"), F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("bigint").alias("n_dropped"), text.alias("kept_text"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, folder: str | None = None) -> DataFrame:
    """doc_id, text, n_lines, n_dropped, kept_text of ``docs`` (doc_id, text), which are dealt into batches by id."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    found = line_rows(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    path = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    found.write.partitionBy("batch").parquet(path)
    rows = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark, folder or f"{shared_folder(spark)}/line-runs-{uuid.uuid4().hex}", min_docs)
    for batch in range(batches):
        runs.add(rows.where(F.col("batch") == batch))
    # Written once more without buckets: the join with the lines must be one that adaptive execution may split.
    repeated = cut_lineage(runs.repeated(), "repeated-lines")
    runs.forget()
    return drop_lines(docs, rows, repeated)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what is left of every document."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH l AS (
    SELECT doc_id, i, lines[i] AS line,
           translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS t(i)),
r AS (SELECT k, max(doc_id) AS largest FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, largest IS NOT NULL AND doc_id <> largest AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
