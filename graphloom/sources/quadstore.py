"""A versioned quad set on a shared file system: clustered base copies, a change log, and one linear order of both.

``log/`` holds numbered entries (``CommitLog``); the folders they name are complete before their entry appears, so readers
never see half a change and a writer that dies leaves files that nobody reads.  An entry is a batch of changes or a
base.  A base holds all entries up to a number; the state is the newest base and all batches with larger numbers, in the
order of their numbers, whatever was compacted in between.  Within a batch ``seq`` orders the changes of a quad.

A batch is named by a feed and a number within it and counts once: a feed's numbers ascend, so a base keeps the last number
of each feed, and a repeated batch finds itself there or in the log.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.operators import updates as up
from graphloom.sources.commitlog import CommitLog
from graphloom.sources.store import ORDERS, StoredGraph, write_clustered

CHANGES_DDL = "op string, s string, p string, o string, g string, seq bigint"
_CHANGE = [c.split()[0] for c in CHANGES_DDL.split(", ")]


class QuadStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/log")
        self._draft: dict = {}

    # --- versions ---------------------------------------------------------------------------------------------------

    def _read(self) -> tuple[dict, list[tuple[int, dict]], int]:
        """The newest base, the batches that it does not hold with their numbers, and the newest number."""
        numbers = self.commits.numbers()
        base, batches = None, []
        for number in reversed(numbers):
            if base is not None and number <= base["upto"]:
                break
            entry = self.commits.get(number)
            if entry["kind"] == "batch":
                batches.append((number, entry))
            elif base is None:
                base = entry
        if base is None:
            raise ValueError(f"{self.path} holds no quad store")
        return base, batches[::-1], numbers[-1]

    def version(self) -> int:
        """The newest published version."""
        return self._read()[0]["version"]

    def _base(self, version: int) -> dict:
        for number in reversed(self.commits.numbers()):
            entry = self.commits.get(number)
            if entry["kind"] == "base" and entry["version"] == version:
                return entry
        raise ValueError(f"{self.path} has no version {version}")

    def create(self, quads: DataFrame, orders: tuple[str, ...] = ORDERS) -> "QuadStore":
        """A new store.  ``orders`` are the clustered copies that it keeps: by predicate, subject and object."""
        if self.commits.last() >= 0:
            raise ValueError(f"{self.path} already holds a quad store")
        name = f"base-{uuid.uuid4().hex}"
        copies = write_clustered(quads, f"{self.path}/{name}", orders)
        if not self.commits.put(0, {"kind": "base", "version": 0, "upto": -1, "path": name, "orders": copies, "feeds": {}}):
            raise ValueError(f"{self.path} already holds a quad store")
        return self

    # --- reading ----------------------------------------------------------------------------------------------------

    def _graph(self, base: dict, changes: DataFrame | None = None) -> StoredGraph:
        return StoredGraph(self.spark, f"{self.path}/{base['path']}", base["orders"], changes)

    def graph(self) -> StoredGraph:
        """The current state as a graph: patterns read the copy that suits what they bind."""
        base, batches, _ = self._read()
        return self._graph(base, self._logged(batches) if batches else None)

    def base(self, *predicates: str) -> DataFrame:
        return self.state(self.version(), *predicates)

    def state(self, version: int, *predicates: str) -> DataFrame:
        """The base of a version.  Constant predicates open their own folders only."""
        return self._graph(self._base(version)).quads(list(predicates) or None)

    def _logged(self, batches: list[tuple[int, dict]]) -> DataFrame:
        """The changes of batches with ``at``, the place of their batch."""
        if not batches:
            return self.spark.createDataFrame([], CHANGES_DDL + ", at bigint")
        folder = f"{self.path}/changes"
        rows = self.spark.read.schema(CHANGES_DDL + ", attempt string").option("basePath", folder).parquet(
            *[f"{folder}/attempt={entry['attempt']}" for _, entry in batches])
        # One row for each batch since the last compaction.
        places = self.spark.createDataFrame([(entry["attempt"], number) for number, entry in batches], "attempt string, at bigint")
        return rows.join(F.broadcast(places), "attempt").select(*_CHANGE, "at")

    def changes(self) -> DataFrame:
        return self._logged(self._read()[1])

    def current(self, *predicates: str) -> DataFrame:
        """The state after all logged changes, of some predicates or of all."""
        return self.graph().quads(list(predicates) or None)

    def statistics(self) -> DataFrame:
        return up.delta_statistics(self.base(), self.changes())

    # --- writing ----------------------------------------------------------------------------------------------------

    @staticmethod
    def _last(base: dict, batches: list[tuple[int, dict]]) -> dict[str, int]:
        """The last number of each feed."""
        last = dict(base["feeds"])
        for _, entry in batches:
            if entry["feed"] is not None:
                last[entry["feed"]] = max(entry["n"], last.get(entry["feed"], -1))
        return last

    def log(self, changes: DataFrame, batch: str, n: int = 0) -> bool:
        """Add batch ``n`` of a feed (or a batch of its own name); False if it was there already.

        A feed's numbers ascend: one that is not larger than the last does nothing.
        """
        return self._add(changes, batch, n)

    def _add(self, changes: DataFrame, feed: str | None, n: int) -> bool:
        known = lambda: feed is not None and self._last(*self._read()[:2]).get(feed, -1) >= n
        if known():
            return False
        attempt = uuid.uuid4().hex
        changes.select(*_CHANGE).write.parquet(f"{self.path}/changes/attempt={attempt}")
        entry = {"kind": "batch", "feed": feed, "n": n, "attempt": attempt}
        return self.commits.append(lambda: None if known() else entry) is not None

    def update(self, inserts: DataFrame | None = None, deletes: DataFrame | None = None) -> None:
        """Log one update; a quad in both sets ends up inserted."""
        parts = [
            quads.select(F.lit(op).alias("op"), *up.KEY, F.lit(seq).cast("bigint").alias("seq"))
            for seq, op, quads in ((0, "delete", deletes), (1, "insert", inserts)) if quads is not None]
        if parts:
            self._add(reduce(DataFrame.unionByName, parts), None, 0)

    def compact(self) -> int:
        """Fold the batches logged so far into a new base; the old one stays readable until ``vacuum``.

        Batches logged meanwhile have larger numbers than the base holds and stay in their order.
        """
        base, batches, number = self._read()
        name, version = f"base-{uuid.uuid4().hex}", base["version"] + 1
        folded = self._graph(base, self._logged(batches) if batches else None).quads()
        copies = write_clustered(folded, f"{self.path}/{name}", _by_place(base))
        self._draft = {"kind": "base", "version": version, "upto": number, "path": name, "orders": copies, "feeds": self._last(base, batches)}
        self._publish(version)
        return self.version()

    def _publish(self, version: int) -> None:
        """Commit the base that was written, unless another compaction was faster."""
        self.commits.append(lambda: None if self.version() >= version else self._draft)

    def vacuum(self) -> int:
        """Remove the files of older versions and of the batches that the newest base holds; how many folders went.

        Nobody may still read an older version.
        """
        newest, gone = self._read()[0], []
        for number in self.commits.numbers():
            entry = self.commits.get(number)
            if entry["kind"] == "batch" and number <= newest["upto"]:
                gone.append(f"changes/attempt={entry['attempt']}")
            elif entry["kind"] == "base" and entry["version"] < newest["version"]:
                gone.append(entry["path"])
        return sum(self.commits.remove(f"{self.path}/{name}") for name in gone)

    def clone(self, path: str) -> "QuadStore":
        """Copy the current state under a new path."""
        return QuadStore(self.spark, path).create(self.current(), _by_place(self._read()[0]))


def _by_place(base: dict) -> tuple[str, ...]:
    """The copies of a base, the first one first (entries come back sorted by name)."""
    return tuple(c for c in ORDERS if c in base["orders"])
