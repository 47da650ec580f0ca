"""Delta-maintained token counts: additive totals by source, language and tokenizer version.

Changes carry signed counts: an insert adds a document's tokens, a delete takes them away, a revision adds the difference.
A batch is summed to one row per group before it is stored, under its id, so totals are the sum of a few small files.
Committing an id again changes nothing: a batch counts when its marker exists, and a marker appears once,
complete.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.llm.common import WORD, table
from graphloom.session import cut_lineage, shared_folder

GROUP = ("source", "lang", "tokenizer")
#: Tokenizer versions as patterns of one token each.
TOKENIZERS = {"words-1": WORD, "words-2": r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]"}


def token_count(text: Column, tokenizer: str) -> Column:
    """Tokens of a whole text under one of TOKENIZERS; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def counted(docs: DataFrame, *keep: str, text: Column | None = None, tokenizers: tuple[str, ...] = tuple(TOKENIZERS)) -> DataFrame:
    """source, lang, tokenizer, tokens and ``keep``: one row for each document and tokenizer version."""
    text = F.col("text") if text is None else text
    each = F.array(*[F.struct(F.lit(t).alias("tokenizer"), token_count(text, t).alias("tokens")) for t in tokenizers])
    return docs.select("source", "lang", *keep, each.alias("__each")).selectExpr("source", "lang", *[f"`{k}`" for k in keep], "inline(__each)")


def inserts(counts: DataFrame) -> DataFrame:
    """Signed changes that add rows (source, lang, tokenizer, tokens)."""
    return counts.select(*GROUP, F.lit(1).cast("long").alias("docs"), F.col("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changed counts, and moves to another group: the old rows go and the new ones come."""
    return deletes(before).unionByName(inserts(after))


class TokenTotals:
    """A folder of committed batches, each with its summed changes and a marker that names the attempt that counts.

    Writers that lose a task, die or run twice leave unnamed attempts behind, which nobody reads.  The marker is
    renamed into place, so it is never seen half-written.

    Null sources and languages are groups like any other; an empty batch commits and adds nothing; other columns are not
    read; equal rows count as often as they occur.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.paths = spark._jvm.org.apache.hadoop.fs
        self.fs = self.paths.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path("commits"))

    def _path(self, name: str):
        return self.paths.Path(f"{self.folder}/{name}")

    def committed(self) -> dict[str, str]:
        """Batch id -> attempt.  One marker for each batch."""
        out = {}
        for status in self.fs.listStatus(self._path("commits")):
            stream = self.fs.open(status.getPath())
            try:
                attempt = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out[status.getPath().getName()] = attempt
        return out

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed changes; False if it was there already."""
        if not batch.replace("-", "").isalnum():
            raise ValueError(f"a batch id is letters, digits and dashes: {batch}")
        if batch in self.committed():
            return False
        attempt = uuid.uuid4().hex
        summed = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.where("docs <> 0 or tokens <> 0").write.parquet(f"{self.folder}/attempts/{attempt}")
        # The marker is written aside and renamed: renaming onto an existing marker fails.
        draft, marker = self._path(f"drafts/{attempt}"), self._path(f"commits/{batch}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(attempt.encode()))
        stream.close()
        return not self.fs.exists(marker) and self.fs.rename(draft, marker)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens: groups that still have documents or tokens."""
        attempts = sorted(set(self.committed().values()))
        kind = "source string, lang string, tokenizer string, docs long, tokens long"
        if not attempts:
            return self.spark.createDataFrame([], kind)
        rows = self.spark.read.schema(kind).parquet(*[f"{self.folder}/attempts/{a}" for a in attempts])
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents, two of them delivered twice.

    All documents come with the first tokenizer version; the second version adds its own counts; repeated texts are
    deleted but for their smallest id; what is left of source ``src0`` is revised: moved to source ``web`` and counted anew without their line breaks.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", "lang", F.xxhash64("text").alias("h"), F.md5("text").alias("m"))
    # The texts are read twice, for their counts with and without line breaks; all batches work on the counts.
    keys = ("doc_id", "h", "m")
    counts = cut_lineage(counted(docs, *keys), "counts")
    joined = cut_lineage(counted(docs.where("source = 'src0'"), *keys, text=F.translate("text", "\n", "")), "joined")
    first = cut_lineage(docs.where("text is not null").groupBy("h", "m").agg(F.min("doc_id").alias("first")), "first")

    totals = TokenTotals(spark, f"{shared_folder(spark)}/token-totals-{uuid.uuid4().hex}")
    moved = lambda rows: rows.join(first, ["h", "m"]).where("doc_id = first")
    batches = {
        "load-words-1": inserts(counts.where("tokenizer = 'words-1'")),
        "load-words-2": inserts(counts.where("tokenizer = 'words-2'")),
        "copies": deletes(counts.join(first, ["h", "m"]).where("doc_id > first")),
        "moved": revisions(moved(counts.where("source = 'src0'")), moved(joined).withColumn("source", F.lit("web"))),
    }
    for name, changes in batches.items():
        totals.commit(name, changes)
    for name in ("copies", "moved"):
        totals.commit(name, batches[name])
    return totals.totals()


OP9_SQL = r"""
WITH kept AS (
    SELECT text, source, lang FROM documents
    QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
state AS (
    SELECT CASE WHEN source = 'src0' AND text IS NOT NULL THEN 'web' ELSE source END AS source, lang,
           CASE WHEN source = 'src0' THEN replace(text, chr(10), '') ELSE text END AS text FROM kept),
counts AS (
    SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens FROM state
    UNION ALL
    SELECT source, lang, 'words-2', len(regexp_extract_all(text, '[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]')) FROM state)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens
FROM counts GROUP BY ALL
"""
