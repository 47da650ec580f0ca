"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order.  Inverted lists, one for each pair of pivots, hold
the vectors that have both among their nearest; so whoever meets in a list shares two pivots at least.  List members are
verified by cosine, a block of a list at a time, and a pair that shares more pivots is told by its first list only.
A task writes one row per vector (links counted, and the root of its linked group), never a row per pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm.common import cell_runs, long_ids, table
from graphloom.llm.components import connected_components
from graphloom.session import cut_lineage, ship

#: Pivots at most, vectors they are chosen from at most, and how alike two pivots may be.
PIVOTS, SAMPLE, APART = 256, 8192, 0.8
#: Nearest pivots that describe a vector; vectors of a list that are compared at once.
NEAREST, BLOCK = 6, 512


def _raw(vectors: DataFrame) -> DataFrame:
    """vec_id, label, raw (double components; null if the vector can't be linked)."""

    def run(batches):
        for batch in batches:
            raw = []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding")):
                # Adding zero makes -0.0 and 0.0 one value.
                x = None if label is None or not vector.is_valid or vector.values.null_count else \
                    vector.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                raw.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(raw, pa.binary())],
                                             ["vec_id", "label", "raw"])

    kinds = dict(vectors.dtypes)
    return vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, raw binary")


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """{bytes of a vector: pivots}.  From a seeded sample, each pivot unlike those before it, so that a crowd of near
    copies gets one pivot and not many that its members would order at random."""
    n = classes.count()
    near = F.pmod(F.xxhash64("raw"), F.lit(1 << 20)) <= int(min(1.0, 2 * SAMPLE / max(n, 1)) * (1 << 20))
    found: dict[int, list[bytes]] = {}
    # At most SAMPLE vectors.
    for r in classes.where(near).select("raw", F.xxhash64("raw").alias("h")).orderBy("h", "raw").limit(SAMPLE).collect():
        found.setdefault(len(r["raw"]), []).append(bytes(r["raw"]))
    out = {}
    for size, raw in found.items():
        x, chosen = _unit(raw), []
        closest = np.full(len(x), -1.0)
        for i in range(len(x)):
            if closest[i] < APART:
                chosen.append(i)
                closest = np.maximum(closest, x @ x[i])
                if len(chosen) == PIVOTS:
                    break
        out[size] = x[chosen]
    return out


def _postings(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """One row for each class and pair of its nearest pivots; sizes without pivots of their own share one list."""

    def run(batches):
        for batch in batches:
            raw, near = batch.column("raw").to_pylist(), [None] * batch.num_rows
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            for size in np.unique(sizes):
                at, own = np.flatnonzero(sizes == size), pivots.get(int(size))
                k = min(NEAREST, len(own)) if own is not None else 0
                if k:
                    score = _unit([raw[i] for i in at]) @ own.T
                    order = np.argsort(-score, axis=1, kind="stable")[:, :k]
                else:
                    order = np.zeros((len(at), 1), np.int64)
                for i, row in zip(at, order):
                    near[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "label", "n", "raw")] + [
                pa.array(near, pa.list_(pa.int32())), pa.array(
                    [[a * PIVOTS + b for a, b in combinations(sorted(r), 2)] or [int(r[0])] for r in near], pa.list_(pa.int32()))],
                ["id", "label", "n", "raw", "near", "keys"])

    kinds = dict(classes.dtypes)
    rows = classes.select("id", "label", "n", "raw").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, n long, raw binary, near array<int>, keys array<int>")
    return rows.withColumn("key", F.explode("keys")).drop("keys")


def _compare(rows: dict, least: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Links counted for each row of a cell and the row that leads its linked group."""
    if len(set(rows["side"])) == 1 and rows["both"][0]:
        return None
    x, near, n = _unit(rows["raw"]), np.sort(np.array(rows["near"]), axis=1), np.array(rows["n"])
    side, label, key = np.array(rows["side"]), np.array(rows["label"], object), rows["key"][0]
    linked = x @ x.T >= least
    # In a cell of two blocks, pairs of one block belong to another cell.
    linked &= (side[:, None] != side[None, :]) if rows["both"][0] else True
    linked &= label[:, None] == label[None, :]
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(np.triu(linked))
    if near.shape[1] > 1 and len(a):
        shared = (near[a][:, :, None] == near[b][:, None, :]).any(axis=2)
        first = shared.argmax(axis=1)
        shared[np.arange(len(a)), first] = False
        second = shared.argmax(axis=1)
        told = near[a, first] * PIVOTS + near[a, second] == key
        linked[a[~told], b[~told]] = linked[b[~told], a[~told]] = False
    if not linked.any():
        return None
    lead = np.arange(len(x))
    while True:
        next_lead = np.minimum(lead, np.where(linked, lead[None, :], len(x)).min(axis=1))
        if (next_lead == lead).all():
            return linked @ n, lead
        lead = next_lead


def linked_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for rows ``vec_id, embedding, label``.

    Vectors with equal labels are linked if their cosine, in doubles, is at least ``least``.  Null labels, null, empty or zero
    vectors and null or non-finite components link with nothing, and vectors of different lengths not with each other.
    Equal vectors are one class: they link with each other and share their other links.  Rows without an id are kept,
    without a component.  The index is approximate (pairs that share under two nearest pivots are missed); every
    link it gives is verified.  An empty table gives no rows; other columns are not read.
    """
    ship(vectors.sparkSession)
    vectors = long_ids(vectors, "vec_id")
    rows = cut_lineage(_raw(vectors), "vectors")
    classes = cut_lineage(rows.where("raw is not null and vec_id is not null").groupBy("label", "raw").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    postings = cut_lineage(_postings(classes, choose_pivots(classes)), "postings")

    lists = postings.groupBy("label", "key", F.length("raw").alias("size")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = (postings.withColumn("size", F.length("raw")).join(lists, ["label", "key", "size"])
           .withColumn("blocks", F.ceil(F.col("m") / BLOCK)).withColumn("x", F.pmod(F.xxhash64("id"), F.col("blocks"))))
    # A long list is compared block against block: each row goes to the cells of its block.
    met = met.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = met.select("id", "label", "n", "raw", "near", "key", (F.col("x") != F.col("y")).alias("both"),
                       (F.col("x") > F.col("y")).cast("int").alias("side"),
                       F.xxhash64("label", "key", "size", F.least("x", "y"), F.greatest("x", "y")).alias("cell"))

    def run(batches):
        for group in cell_runs(batches, ["cell", "id", "label", "n", "raw", "near", "key", "both", "side"]):
            found = _compare(group, least)
            if found is not None:
                links, lead = found
                at = np.flatnonzero(links)
                ids = group["id"]
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at]), pa.array(links[at], pa.int64()),
                                                  pa.array([ids[lead[i]] for i in at])], ["id", "links", "lead"])

    kind = dict(classes.dtypes)["id"]
    told = cut_lineage(cells.repartition("cell").sortWithinPartitions("cell", "id").mapInArrow(
        run, f"id {kind}, links long, lead {kind}"), "told")
    known = connected_components(told.select(F.col("id").alias("u"), F.col("lead").alias("v")))
    links = told.groupBy("id").agg(F.sum("links").alias("links"))
    classes = (classes.join(links, "id", "left").join(known.withColumnRenamed("node", "id"), "id", "left")
               .select("label", "raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("c")))
    out = rows.join(classes, ["label", "raw"], "left")
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))
