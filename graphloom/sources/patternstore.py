"""A stored dictionary of predicate patterns, kept up with a quad store's change log.

Each subject has the set of its predicates, its pattern.  ``subjects`` maps subjects to pattern ids, ``patterns`` tells what
an id means, ``counts`` how many subjects came to or left a pattern.  The first segment is made from a whole base; a refresh
looks only at subjects that were changed since, and adds a segment whose subjects hide their older entries.  ``log/`` orders
segments and says up to which entry of the store's log they go.

Counts over all subjects add up ``counts``, a few rows per segment; counts over given subjects read their pattern ids: one
row per subject instead of one per triple.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.operators.predicates import subject_patterns
from graphloom.session import cut_lineage
from graphloom.sources.commitlog import CommitLog
from graphloom.sources.quadstore import QuadStore

_SUBJECTS, _PATTERNS, _COUNTS = "s string, pattern_id string", "pattern_id string, pattern array<string>", "pattern_id string, n bigint"


class PatternStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/log")

    def _segments(self) -> list[dict]:
        out = []
        for number in reversed(self.commits.numbers()):
            out.append(self.commits.get(number))
            if out[-1]["whole"]:
                break
        return out[::-1]

    def _read(self, entry: dict, part: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{entry['folder']}/{part}")

    def _write(self, patterns: DataFrame, changed: DataFrame | None, upto: int) -> bool:
        """A segment of (s, pattern).  ``changed`` are the subjects it speaks for (all, if None): some may have no pattern left."""
        entry = {"folder": f"patterns-{uuid.uuid4().hex}", "upto": upto, "whole": changed is None}
        before = len(self._segments())
        named = cut_lineage(patterns.select("s", F.md5(F.array_join("pattern", "\n")).alias("pattern_id"), "pattern"), "patterns")
        now = named.select("s", "pattern_id")
        moves = now.select("pattern_id", F.lit(1).alias("d"))
        if changed is not None:
            now = changed.join(now, "s", "left")
            old = self.subjects().join(changed, "s", "left_semi").select("pattern_id", F.lit(-1).alias("d"))
            moves = moves.unionByName(old)
        base = f"{self.path}/{entry['folder']}"
        now.repartitionByRange("s").sortWithinPartitions("s").write.parquet(f"{base}/subjects")
        named.select("pattern_id", "pattern").dropDuplicates(["pattern_id"]).write.parquet(f"{base}/patterns")
        moves.groupBy("pattern_id").agg(F.sum("d").alias("n")).where("n <> 0").write.parquet(f"{base}/counts")
        # Another refresh may have been faster: then this one is void.
        return self.commits.append(lambda: entry if len(self._segments()) == before else None) is not None

    def refresh(self, store: QuadStore) -> bool:
        """Take in what was logged since the last refresh; False if there was nothing (or somebody else did it)."""
        base, batches, number = store._read()
        segments = self._segments()
        if not segments:
            return self._write(subject_patterns(store.graph()), None, number)
        seen = segments[-1]["upto"]
        if seen >= number:
            return False
        if base["upto"] > seen:
            # Changes that a base has swallowed meanwhile can no longer be told apart.
            return self._write(subject_patterns(store.graph()), None, number)
        changed = cut_lineage(store._logged([b for b in batches if b[0] > seen]).select("s").dropDuplicates(), "changed")
        return self._write(subject_patterns(store.graph().about(changed)), changed, number)

    def subjects(self) -> DataFrame:
        """(s, pattern_id): what the newest segment that speaks for a subject says."""
        segments = self._segments()
        parts = []
        for i, entry in enumerate(segments):
            rows = self._read(entry, "subjects", _SUBJECTS)
            later = [self._read(e, "subjects", _SUBJECTS).select("s") for e in segments[i + 1:]]
            parts.append(rows.join(reduce(DataFrame.unionByName, later), "s", "left_anti") if later else rows)
        return reduce(DataFrame.unionByName, parts).where("pattern_id is not null")

    def patterns(self) -> DataFrame:
        """(pattern_id, pattern)."""
        return reduce(DataFrame.unionByName, [self._read(e, "patterns", _PATTERNS) for e in self._segments()]).dropDuplicates(["pattern_id"])

    def counts(self, subjects: DataFrame | None = None) -> DataFrame:
        """(pattern_id, n): how many subjects, of all or of ``subjects`` (s), have a pattern."""
        if subjects is None:
            moves = reduce(DataFrame.unionByName, [self._read(e, "counts", _COUNTS) for e in self._segments()])
            return moves.groupBy("pattern_id").agg(F.sum("n").alias("n")).where("n <> 0")
        held = self.subjects().join(subjects.select("s").dropDuplicates(), "s", "left_semi")
        return held.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("n"))

    def available_predicates(self, subjects: DataFrame | None = None) -> DataFrame:
        """(p, n): per predicate the number of distinct entities (of ``subjects``) that have it."""
        rows = self.counts(subjects).join(self.patterns(), "pattern_id")
        return rows.select(F.explode("pattern").alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n"))
