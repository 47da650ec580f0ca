"""Near-duplicate documents: universal hash minima, banding, signature and full-set verification, connected components.

Documents with equal shingle sets are one class from the start.  Classes that share a band are candidates, but the pairs of a
band's bucket are never written out.  Every class is compared with the smallest class of each of its buckets, on signatures and
then on full sets.  What that leaves in different components of one bucket is compared block by block, again first on
signatures, which gives families, and within families on full sets; tasks write what joins components, not pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm.common import cell_runs, long_ids, table, utf8
from graphloom.llm.components import connected_components
from graphloom.session import cut_lineage, ship

#: Hash minima per document, about; the chance that a pair just at the threshold shares no band; standard errors that a
#: signature's estimate may fall short; classes that are compared with as many others at once, by signature and by set.
MINIMA, MISS, ERRORS, BLOCK, SET_BLOCK = 196, 1e-4, 5.0, 512, 128
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that still find a pair at the threshold."""
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** (MINIMA // (rows + 1)) <= MISS:
        rows += 1
    return MINIMA // rows, rows


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(data: bytes, width: int) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes; a shorter text is one shingle, no words are none."""
    from xxhash import xxh3_64_intdigest

    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(h))
    # Shorter sequences get other multipliers, so that they never meet a full shingle.
    total = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        total = _scramble(total * _MIX + h[i:len(h) - k + 1 + i])
    return np.unique(total)


def _minima(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 4096):
        values = np.multiply.outer(a, items[at:at + 4096])
        values += b[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, width: int, percent: int, seed: int = 0) -> DataFrame:
    """doc_id, n (shingles), mark (names the set), sig (16 bits of each minimum), keys (one per band)."""
    ship(docs.sparkSession)
    bands, rows = bands_for(percent)
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 1 << 63, bands * rows, np.uint64)
    salt = draw.integers(0, 1 << 63, bands, np.uint64)

    def run(batches):
        for batch in batches:
            n, marks, sigs, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                items = shingles(text, width)
                n.append(len(items))
                if not len(items):
                    marks.append(None), sigs.append(None), keys.append(None)
                    continue
                low = _minima(items, a, b)
                key = salt.copy()
                for column in low.reshape(bands, rows).T:
                    key = _scramble(key * _MIX + column)
                marks.append(np.array([_scramble(items).sum(), _scramble(items ^ _MIX).sum()], np.uint64).tobytes())
                sigs.append((low >> np.uint64(48)).astype("<u2").tobytes())
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), pa.array(sigs, pa.binary()),
                pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "mark", "sig", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, mark binary, sig binary, keys array<long>")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, items: full shingle sets (sorted 64-bit hashes as bytes) of the texts with these ids.

    The texts are dealt by id once, at any size: the ids grow with the table, so they are not for broadcasting.
    """

    def run(batches):
        for batch in batches:
            items = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(items, pa.binary())], ["id", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")
    return chosen.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(run, f"id {kind}, items binary")


def _least(percent: int, size: int) -> float:
    """Equal minima below which two signatures leave no room for the threshold."""
    t = percent / 100
    return (t - ERRORS * math.sqrt(t * (1 - t) / size)) * size


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (u, v) whose full sets reach the threshold, and the sets read for that; both written."""
    least = _least(percent, size)

    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        a, b = (np.frombuffer(b"".join(s), "<u2").reshape(len(s), -1) for s in (x, y))
        return pd.Series((a == b).sum(axis=1) >= least)

    def enough(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    facts = classes.select("id", "n", "sig")
    near = (pairs.join(facts.select(F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("sig").alias("sig_u")), "u")
            .join(facts.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("sig").alias("sig_v")), "v")
            .where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
            .where(F.pandas_udf(alike, "boolean")("sig_u", "sig_v")).select("u", "v"))
    near = cut_lineage(near, "near")
    # Pairs of a class with each of its centres: at most one per band.
    ids = near.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    sets = cut_lineage(_sets(docs, ids, width), "sets")
    met = (near.join(sets.select(F.col("id").alias("u"), F.col("items").alias("items_u")), "u")
           .join(sets.select(F.col("id").alias("v"), F.col("items").alias("items_v")), "v")
           .where(F.pandas_udf(enough, "boolean")("items_u", "items_v")))
    return cut_lineage(met.select("u", "v"), "links"), sets


def _named(rows: DataFrame, components: DataFrame, column: str, name: str) -> DataFrame:
    """Add the component of ``column`` as ``name``; what has no link is its own component."""
    found = components.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    return rows.join(found, F.col(column) == F.col("__n"), "left").withColumn(name, F.coalesce("__c", column)).drop("__n", "__c")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, seed: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id).

    Documents are linked if the Jaccard similarity of their sets of ``width``-word shingles (words lower-cased in A-Z) is
    at least ``percent`` / 100.  Texts without words, null ones included, are linked with nothing, and so are rows without
    an id: those have no component and are kept.  Ids name rows; rows that repeat an id with an equal text are one
    document and are all kept or not.  An empty table gives no rows; other columns are not read.
    """
    docs = long_ids(docs, "doc_id")
    bands, rows = bands_for(percent)
    size = bands * rows
    told = cut_lineage(signatures(docs, width, percent, seed), "signatures")
    groups = cut_lineage(told.where("mark is not null and doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("id")), "classes")
    classes = (told.drop("mark").join(groups.select("id"), F.col("doc_id") == F.col("id"))
               .select("id", "n", "sig", "keys").where("keys is not null"))
    buckets = classes.select("id", F.explode("keys").alias("key"))
    centres = buckets.groupBy("key").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "v")
    shared = cut_lineage(buckets.join(centres, "key").select("key", F.col("id").alias("u"), "v"), "shared")

    stars = shared.where("u <> v").select("u", "v").distinct()
    links, sets = _verified(stars, classes, docs, width, percent, size)
    known = connected_components(links)

    # Then all other pairs of a bucket that are still apart.
    apart = _named(shared.select("key", "u"), known, "u", "c")
    mixed = apart.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    apart = cut_lineage(apart.join(mixed, "key"), "apart")
    family = connected_components(_families(apart, classes, percent, size))
    members = cut_lineage(_named(family.select(F.col("component").alias("key"), F.col("node").alias("u")), known, "u", "c"), "members")
    more = members.select(F.col("u").alias("id")).join(sets.select("id"), "id", "left_anti")
    sets = sets.unionByName(cut_lineage(_sets(docs, more, width), "sets"))
    known = connected_components(links.unionByName(_joined(members, sets, percent)))

    out = told.select("doc_id", F.col("n").alias("n_shingles"), "mark").join(groups, "mark", "left")
    out = _named(out, known, "id", "component_id").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` without near duplicates of a smaller id; columns stay.

    Only ids that go are looked up, so rows without an id stay.  Rows that repeat one id with equal texts all stay.
    """
    gone = near_duplicates(docs, width, percent, seed).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def _cells(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, u, c, ...) dealt to cells that compare a block of the key's minor rows, those outside its largest
    component, with a block of all its rows.  ``side`` 1 is the minor block, ``minor`` tells minor rows on both sides."""
    counts = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "c")).alias("top"))
    rows = (rows.join(sizes, "key").withColumn("minor", F.col("c") != F.col("top.c"))
            .withColumn("across", F.ceil(F.col("all") / block)).withColumn("down", F.ceil((F.col("all") - F.col("top.n")) / block)))
    at = lambda n, s: F.pmod(F.xxhash64("u", F.lit(s)), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # Without minor rows there is nothing to compare.
    rows = rows.where("down > 0")
    one = rows.withColumn("x", at("across", 0)).withColumn("y", F.explode(every("down"))).withColumn("side", F.lit(0))
    two = rows.where("minor").withColumn("y", at("down", 1)).withColumn("x", F.explode(every("across"))).withColumn("side", F.lit(1))
    cells = one.unionByName(two).withColumn("cell", F.xxhash64("key", "x", "y"))
    return cells.drop("key", "all", "top", "across", "down", "x", "y")


def _families(apart: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """Edges (u, v) that connect all classes which share a bucket, lie in different components and are alike by signature."""
    least = _least(percent, size)
    cells = _cells(apart, BLOCK).join(classes.select(F.col("id").alias("u"), "sig"), "u")

    def run(batches):
        for group in cell_runs(batches, ["cell", "u", "c", "side", "sig"]):
            side, comp = np.array(group["side"]), np.array(group["c"])
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            if not len(left) or not len(right):
                continue
            sig = np.frombuffer(b"".join(group["sig"]), "<u2").reshape(len(side), -1)
            links = {}
            # A row stands on both sides of some cells; its two places are one.
            root = {u: u for u in group["u"]}
            others = sig[right]
            for i in left:
                hits = right[((others == sig[i]).sum(axis=1) >= least) & (comp[right] != comp[i])]
                for j in hits:
                    a, b = _root(root, group["u"][i]), _root(root, group["u"][j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        links[max(a, b)] = min(a, b)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(list(links)), pa.array(list(links.values()))], ["u", "v"])

    kind = dict(apart.dtypes)["u"]
    return cells.repartition("cell").sortWithinPartitions("cell", "u").mapInArrow(run, f"u {kind}, v {kind}")


def _root(root: dict, x):
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def _shared_items(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices a few thousand items at a time."""
    names, at = np.unique(np.concatenate(left + right), return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(names), 8192):
        a, b = np.searchsorted(at, [first, first + 8192])
        part = np.zeros((len(left) + len(right), 8192), np.float32)
        part[row[a:b], at[a:b] - first] = 1
        out += part[: len(left)] @ part[len(left):].T
    return out


def _joined(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between classes of one family, enough to join all components that any link joins."""
    cells = _cells(members, SET_BLOCK).join(sets.select(F.col("id").alias("u"), "items"), "u")

    def run(batches):
        for group in cell_runs(batches, ["cell", "u", "c", "side", "items"]):
            side, comp, ids = np.array(group["side"]), group["c"], group["u"]
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            if not len(left) or not len(right):
                continue
            items = [np.frombuffer(x, "<u8") for x in group["items"]]
            both = _shared_items([items[i] for i in left], [items[j] for j in right])
            sizes = np.array([len(x) for x in items])
            # Sums of ones up to a text's length are exact in single precision.
            union = sizes[left][:, None] + sizes[right][None, :] - both
            names = np.array(comp)
            linked = (100 * both.astype(np.int64) >= percent * union.astype(np.int64)) & (names[left][:, None] != names[right][None, :])
            root, links = {c: c for c in comp}, []
            for i, j in zip(*np.nonzero(linked)):
                a, b = _root(root, comp[left[i]]), _root(root, comp[right[j]])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((ids[left[i]], ids[right[j]]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*links)], ["u", "v"])

    kind = dict(members.dtypes)["u"]
    return cut_lineage(cells.repartition("cell").sortWithinPartitions("cell", "u").mapInArrow(run, f"u {kind}, v {kind}"), "joined")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
