"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Rows and virtual nodes are hashed onto a ring of 2^48 places.  A row belongs to the first virtual node clockwise.
Every virtual node has a capacity; what exceeds it continues clockwise to the next virtual node that has room.

The walk is not simulated row by row.  A virtual node keeps its first rows, up to its capacity, in ring order; the rest
queue up and are served in order by the free places further on.  So the n-th overflowing row gets free place
``n + max(F_j - E_(j-1))`` over the nodes ``j`` passed, where ``E`` and ``F`` are running totals of overflow and room: a
window over the few virtual nodes.  Rows meet that bounded table twice, in broadcast joins, and are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from graphloom.session import cut_lineage

RING_BITS = 48
CELL_BITS = 12          # the ring in 4,096 cells: an equi-join key for looking up arcs
SUB_SHIFT = 32          # rows of one virtual node are ranked in pieces of 2^32 places

_CELL_SHIFT = RING_BITS - CELL_BITS


def place(*key: Column) -> Column:
    """Where a key stands on the ring."""
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - RING_BITS)


def ring(spark: SparkSession, shards: int, vnodes: int, seed: int = 0) -> DataFrame:
    """The virtual nodes: shard, number within the shard, place, and the place before it (its arc is (lo, hi])."""
    nodes = spark.range(shards * vnodes, numPartitions=1).select(
        (F.col("id") / vnodes).cast("int").alias("shard"), (F.col("id") % vnodes).cast("int").alias("vnode"))
    # Two nodes at one place: the second has an empty arc.
    nodes = nodes.withColumn("hi", place(F.lit(seed), F.lit("shard"), "shard", "vnode"))
    by_place = W.orderBy("hi", "shard", "vnode")
    last = nodes.agg(F.max("hi").alias("last"))     # one row
    return (nodes.withColumn("node", F.row_number().over(by_place) - 1)
            .withColumn("before", F.lag("hi").over(by_place)).crossJoin(F.broadcast(last))
            .select("node", "shard", "vnode", F.coalesce("before", "last").alias("lo"), "hi"))


def _cells(intervals: DataFrame, lo: str, hi: str, shift: Column | int) -> DataFrame:
    """Half-open intervals (lo, hi], each repeated for the cells it touches."""
    at = (lambda c: F.shiftright(c, shift)) if isinstance(shift, int) else (lambda c: F.floor(c / shift).cast("long"))
    return intervals.withColumn("cell", F.explode(F.sequence(at(F.col(lo) + 1), at(F.col(hi)))))


def shard(docs: DataFrame, shards: int = 16, key: tuple[str, ...] = ("doc_id",), vnodes: int = 64, slack: float = 0.05,
          seed: int = 0, tie: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... within the shard) to the rows of ``docs``.

    A shard holds at most (1 + ``slack``) times the mean number of rows; with ``slack`` 0 the row counts of two shards
    differ by one at most.  More slack means fewer rows pushed on, so fewer rows that move when shards are added.

    Rows with equal keys stand at one place; ``tie`` names columns that order them, and rows equal there too are
    interchangeable.  Null keys are a key like any other.  An empty table gives no rows.  All columns of ``docs`` are
    kept; ``shard`` and ``slot`` replace columns of these names.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*columns).alias("row"), place(F.lit(seed), *[F.col(c) for c in key]).alias("pos"),
                       F.struct(*[F.col(c) for c in (*key, *tie)]).alias("order"))
    nodes = cut_lineage(ring(spark, shards, vnodes, seed), "ring")

    # The arc that runs over the end of the ring is two intervals.
    full = (1 << RING_BITS) - 1
    arcs = nodes.select("node", F.col("lo").alias("from"), F.explode(
        F.when(F.col("lo") < F.col("hi"), F.array(F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi"))))
        .when((F.col("node") == 0) & (F.col("lo") >= F.col("hi")), F.array(
            F.struct(F.col("lo").alias("lo"), F.lit(full).alias("hi")),
            F.struct(F.lit(-1).cast("long").alias("lo"), F.col("hi").alias("hi"))))
        .otherwise(F.array().cast("array<struct<lo:bigint,hi:bigint>>"))).alias("arc"))
    arcs = _cells(arcs.select("node", "from", "arc.lo", "arc.hi").where("lo < hi"), "lo", "hi", _CELL_SHIFT)
    # At most 4,096 cells + shards * vnodes rows.
    placed = (rows.withColumn("cell", F.shiftright("pos", _CELL_SHIFT)).join(F.broadcast(arcs), "cell")
              .where("pos > lo and pos <= hi")
              .withColumn("away", F.pmod(F.col("pos") - F.col("from"), F.lit(full + 1)))
              .withColumn("sub", F.shiftright("away", SUB_SHIFT))
              .select("row", "order", "node", "sub", "away"))

    # One count for each piece of an arc: at most 65,536 + shards * vnodes rows, whatever the table.
    pieces = cut_lineage(placed.groupBy("node", "sub").agg(F.count(F.lit(1)).alias("n")), "pieces")
    before = pieces.select("node", "sub", (F.sum("n").over(W.partitionBy("node").orderBy("sub")) - F.col("n")).alias("before"))
    loads = cut_lineage(_loads(nodes, pieces, shards, vnodes, slack), "loads")

    ranked = (placed.join(F.broadcast(before), ["node", "sub"])
              .withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy("node", "sub").orderBy("away", "order")) - 1)
              .join(F.broadcast(loads.select("node", "c", "base", "queued", "pushed", F.col("shard").alias("own"))), "node"))
    stay = F.col("rank") < F.col("c")
    # Free place of an overflowing row, counted along the ring.
    ranked = ranked.withColumn("free", F.when(~stay, F.col("queued") + F.col("rank") - F.col("c") + F.col("pushed")))

    # Room as intervals of free places; looked up by cells of equal width, again a bounded table.
    width = F.greatest(F.lit(1), F.floor(F.col("room_all") / (1 << CELL_BITS)).cast("long"))
    rooms = loads.where("room > 0").select((F.col("room_to") - F.col("room") - 1).alias("r_lo"), (F.col("room_to") - 1).alias("r_hi"),
                                           (F.col("base") + F.col("kept")).alias("r_base"), F.col("shard").alias("r_shard"), "room_all")
    rooms = _cells(rooms.withColumn("w", width), "r_lo", "r_hi", F.col("w")).drop("room_all", "w").withColumnRenamed("cell", "r_cell")
    step = loads.agg(F.max(width).alias("w"))       # one row
    found = (ranked.crossJoin(F.broadcast(step)).withColumn("cell", F.floor(F.col("free") / F.col("w")).cast("long"))
             .join(F.broadcast(rooms), (F.col("cell") == F.col("r_cell")) & (F.col("free") > F.col("r_lo")) & (F.col("free") <= F.col("r_hi")), "left"))
    return found.select(
        "row.*", F.when(stay, F.col("own")).otherwise(F.col("r_shard")).cast("int").alias("shard"),
        F.when(stay, F.col("base") + F.col("rank")).otherwise(F.col("r_base") + F.col("free") - F.col("r_lo") - 1).alias("slot"))


def _loads(nodes: DataFrame, pieces: DataFrame, shards: int, vnodes: int, slack: float) -> DataFrame:
    """For each virtual node: places ``c``, rows ``kept``, and how its overflow and its room stand in the queue."""
    demand = pieces.groupBy("node").agg(F.sum("n").alias("d"))
    total = demand.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("total"))     # one row
    exact = F.floor(F.col("total") / shards) + F.when(F.col("shard") < F.col("total") % shards, 1).otherwise(0)
    cap = (exact if slack == 0 else F.greatest(exact, F.ceil(F.col("total") * (1 + slack) / shards))).cast("long")
    part = lambda j: F.floor(F.col("cap") * j / vnodes).cast("long")
    t = (nodes.join(F.broadcast(demand), "node", "left").crossJoin(F.broadcast(total)).withColumn("cap", cap)
         .withColumn("c", part(F.col("vnode") + 1) - part(F.col("vnode")))
         .withColumn("d", F.coalesce("d", F.lit(0)))
         .withColumn("kept", F.least("c", "d"))
         .withColumn("over", F.col("d") - F.col("kept")).withColumn("room", F.col("c") - F.col("kept")))
    # Begin behind the node where the queue is certainly empty: the lowest point of overflow minus room so far.
    # These windows run over shards * vnodes rows.
    t = t.withColumn("x", F.sum(F.col("over") - F.col("room")).over(W.orderBy("node")))
    start = t.agg(F.min_by("node", F.struct("x", "node")).alias("start"))       # one row
    t = t.crossJoin(F.broadcast(start)).withColumn("turn", F.pmod(F.col("node") - F.col("start") - 1, F.lit(shards * vnodes)))
    line = W.orderBy("turn")
    t = (t.withColumn("over_to", F.sum("over").over(line)).withColumn("room_to", F.sum("room").over(line))
         .withColumn("queued", F.col("over_to") - F.col("over"))
         .withColumn("pushed", F.max(F.col("room_to") - F.col("queued")).over(line))
         .withColumn("served_to", F.col("room_to") - F.col("pushed"))
         .withColumn("served", F.col("served_to") - F.coalesce(F.lag("served_to").over(line), F.lit(0)))
         .withColumn("room_all", F.sum("room").over(W.partitionBy())))
    load = F.col("kept") + F.col("served")
    return t.select("node", "shard", "c", "kept", "room", "room_to", "room_all", "queued", "pushed",
                    (F.sum(load).over(W.partitionBy("shard").orderBy("node")) - load).alias("base"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose row counts differ by one at most (law ``rows``)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    facts = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shard(facts, 16, slack=0.0, tie=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
