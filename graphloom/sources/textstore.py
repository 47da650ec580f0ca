"""A stored text index in segments: every batch of records is tokenized once and becomes a segment of its own.

A segment has postings ``(word, is_entity, record, score, dl)``, dealt and sorted by word so that a word or a prefix
reads few row groups, and ``docs (record, dl)``.  ``score`` is the number of occurrences (or what a words file says), ``dl``
the length of the record.  Deletion marks hide records of older segments; ``merge`` makes one segment of all and leaves out
what is hidden.  ``log/`` orders segments and marks (``CommitLog``); folders are complete before their entry appears.

``postings`` has the schema that the searches in ``operators.text`` take.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from graphloom.operators.text import Scoring, _each, _score, tokens, word_counts
from graphloom.session import cut_lineage
from graphloom.sources.commitlog import CommitLog

_POSTINGS = "word string, is_entity boolean, record bigint, score double, dl bigint"
_DOCS = "record bigint, dl bigint"


class TextStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/log")

    # --- the log ----------------------------------------------------------------------------------------------------

    def _entries(self) -> list[tuple[int, dict]]:
        """Segments and marks that count, in order: the newest merged segment and all that it does not hold."""
        out, upto = [], -1
        for number in reversed(self.commits.numbers()):
            if number <= upto:
                break
            entry = self.commits.get(number)
            if entry["kind"] != "merged":
                out.append((number, entry))
            elif upto < 0:
                # A merged segment stands where the newest entry stood that it holds.
                upto = entry["upto"]
                merged = (upto, entry)
        return ([merged] if upto >= 0 else []) + out[::-1]

    def segments(self) -> list[dict]:
        """Folder, number of records and their summed length of every segment, oldest first."""
        return [entry for _, entry in self._entries() if entry["folder"]]

    def _known(self, batch: str | None) -> bool:
        return batch is not None and any(batch in entry["batches"] for _, entry in self._entries())

    # --- writing ----------------------------------------------------------------------------------------------------

    def add(self, docs: DataFrame, record: str = "record", text: str = "text", entity: str | None = None,
            batch: str | None = None, replace: bool = False) -> bool:
        """Index a batch of records; ``entity`` names a column with the entity of each record.

        A record is in one segment: to change one, ``replace`` hides what older segments say about these records.  A batch
        with a name counts once; False if it was there already.  Records without any word count as documents; those without a
        text have no length.
        """
        if self._known(batch):
            return False
        folder = f"segment-{uuid.uuid4().hex}"
        # The texts are tokenized once: lengths and postings start from the counts of each row.  Rows move once, to their
        # place in the index, and are added up there if a record came in several rows.
        columns = [F.col(record).cast("bigint").alias("record"), *([F.col(entity).alias("entity")] if entity else [])]
        split = docs.select(*columns, tokens(text).alias("t")).withColumn("dl", F.size("t").cast("bigint"))
        counts = cut_lineage(split.select(*[c for c in split.columns if c != "t"], word_counts(F.col("t")).alias("counts")), "text-counts")
        lengths = counts.groupBy("record").agg(F.max("dl").alias("dl"))
        words = counts.select("record", "dl", _each(F.col("counts")).alias("c")).where("c is not null")
        rows = words.select("c.word", F.lit(False).alias("is_entity"), "record", F.col("c.tf").cast("double").alias("score"), "dl")
        if entity:
            mentions = counts.where("entity is not null")
            rows = rows.unionByName(mentions.select(F.col("entity").alias("word"), F.lit(True).alias("is_entity"), "record", F.lit(0.0).alias("score"), "dl"))
        return self._commit(folder, rows, lengths, batch, replace, add_up=True)

    def add_words(self, words: DataFrame, batch: str | None = None, replace: bool = False) -> bool:
        """Index given words ``(word, is_entity, record, score)``, as ``operators.text.read_words`` reads them from a file."""
        if self._known(batch):
            return False
        lengths = words.groupBy("record").agg(F.count(F.when(~F.col("is_entity"), 1)).alias("dl"))
        rows = words.select("word", "is_entity", "record", "score", F.lit(None).cast("bigint").alias("dl"))
        return self._commit(f"segment-{uuid.uuid4().hex}", rows, lengths, batch, replace)

    def _write(self, folder: str, rows: DataFrame, lengths: DataFrame, add_up: bool = False) -> dict:
        seen = Observation()
        lengths.observe(seen, F.count(F.lit(1)).alias("docs"), F.count("dl").alias("texts"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words")).write.parquet(f"{self.path}/{folder}/docs")
        # A frequent word spans many files, so the record is part of the order.
        rows = rows.repartitionByRange("word", "record")
        if add_up:
            # Each (word, record) is in one range, so this needs no further shuffle.  Mentions stay apart by length.
            keys = ["word", "is_entity", "record", F.when(F.col("is_entity"), F.col("dl")).alias("__dl")]
            rows = rows.groupBy(*keys).agg(F.sum("score").alias("score"), F.max("dl").alias("dl")).drop("__dl")
        rows.sortWithinPartitions("word", "record").write.parquet(f"{self.path}/{folder}/postings")
        return {"folder": folder, **{k: seen.get[k] for k in ("docs", "texts", "words")}}

    def _commit(self, folder: str, rows: DataFrame, lengths: DataFrame, batch: str | None, replace: bool, add_up: bool = False) -> bool:
        entry = {"kind": "segment", **self._write(folder, rows, lengths, add_up), "batches": [batch] if batch else [],
                 "hides": f"{folder}/docs" if replace else None}
        return self.commits.append(lambda: None if self._known(batch) else entry) is not None

    def delete(self, records: DataFrame, record: str = "record") -> None:
        """Hide records of the segments that are there now; adding them again later shows them again."""
        folder = f"marks-{uuid.uuid4().hex}"
        records.select(F.col(record).cast("bigint").alias("record"), F.lit(None).cast("bigint").alias("dl")).dropDuplicates(["record"]).write.parquet(f"{self.path}/{folder}")
        self.commits.append(lambda: {"kind": "delete", "folder": None, "docs": 0, "texts": 0, "words": 0, "batches": [], "hides": folder})

    def merge(self) -> bool:
        """Make one segment of all that count now; later entries stay as they are.  False if another merge was faster."""
        entries = self._entries()
        if not entries:
            return False
        upto = entries[-1][0] if entries[-1][1]["kind"] != "merged" else None
        if upto is None:
            return False
        folder = f"segment-{uuid.uuid4().hex}"
        entry = {"kind": "merged", "upto": upto, **self._write(folder, self._visible("postings", _POSTINGS, entries), self._visible("docs", _DOCS, entries)),
                 "batches": sorted({b for _, e in entries for b in e["batches"]}), "hides": None}
        mine = lambda: [e for _, e in self._entries() if e["kind"] == "merged"] == [e for _, e in entries if e["kind"] == "merged"]
        return self.commits.append(lambda: entry if mine() else None) is not None

    def vacuum(self) -> int:
        """Remove folders that the newest merged segment holds; nobody may still read them."""
        live = {e["folder"] for _, e in self._entries()} | {e["hides"] for _, e in self._entries()}
        gone = [f for n in self.commits.numbers() for e in [self.commits.get(n)] for f in (e["folder"], e["hides"]) if f and f not in live and not f.endswith("/docs")]
        return sum(self.commits.remove(f"{self.path}/{f}") for f in gone)

    # --- reading ----------------------------------------------------------------------------------------------------

    def _visible(self, part: str, ddl: str, entries: list[tuple[int, dict]], words: Sequence[str] | None = None) -> DataFrame:
        """Rows of all segments without those that later entries hide."""
        read = lambda folder, kind: self.spark.read.schema(kind).parquet(f"{self.path}/{folder}")
        parts = []
        for i, (_, entry) in enumerate(entries):
            if not entry["folder"]:
                continue
            rows = read(f"{entry['folder']}/{part}", ddl)
            if words is not None:
                rows = rows.where(F.col("word").isin(list(words)) & ~F.col("is_entity"))
            hidden = [read(e["hides"], _DOCS).select("record") for _, e in entries[i + 1:] if e["hides"]]
            if hidden:
                rows = rows.join(reduce(DataFrame.unionByName, hidden), "record", "left_anti").select(*[c.split()[0] for c in ddl.split(", ")])
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], ddl)

    def docs(self) -> DataFrame:
        """(record, dl) of all records."""
        return self._visible("docs", _DOCS, self._entries())

    def postings(self) -> DataFrame:
        """(word, is_entity, record, score): a filter on the word reaches the scan of every segment."""
        return self._visible("postings", _POSTINGS, self._entries()).drop("dl")

    def scored(self, scoring: Scoring, words: Sequence[str]) -> DataFrame:
        """(record, word, tf, score) of some words.  Only their postings are read; lengths stand in the postings."""
        entries = self._entries()
        counts = self._visible("postings", _POSTINGS, entries, words).select("record", "word", F.col("score").cast("bigint").alias("tf"), "score", "dl")
        if scoring.mode == "explicit":
            return counts.select("record", "word", "tf", "score")
        if any(e["hides"] for _, e in entries):
            facts = self.docs().agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avdl"))
        else:
            n, texts, words_all = (sum(e[k] for _, e in entries) for k in ("docs", "texts", "words"))
            facts = self.spark.createDataFrame([(n, words_all / texts if texts else None)], "n_docs bigint, avdl double")
        frequency = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
        # At most one row for each of ``words``; ``facts`` is one row.
        joined = counts.drop("score").join(F.broadcast(frequency), "word")
        return joined.crossJoin(F.broadcast(facts)).select("record", "word", "tf", _score(scoring).alias("score"))
