"""Transitive paths: the set of node pairs joined by some walk of bounded or unbounded length."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from graphloom.session import Rounds


def reach(edges: DataFrame, low: int = 1, high: int | None = None, seeds: DataFrame | None = None,
          targets: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """Pairs ``(start, end)`` with a walk of length in [low, high]; ``high=None`` is unbounded.

    ``seeds(start)`` or ``targets(end)`` bind a side: the search begins there.  With ``low=0`` every node of ``nodes``
    (all subjects and objects of the graph) also reaches itself; bound values count only if they are nodes.

    A search from a bound side, or with bounds, is semi-naive: each round extends only the pairs that were new.  The whole
    closure doubles the length that is known in each round (see ``_closure``).  Rounds are written out, so plans stay flat
    and a lost executor repeats one round.
    """
    if high is not None and high < low:
        raise ValueError("high must not be below low")
    if low == 0 and nodes is None:
        raise ValueError("zero-length paths need the nodes of the graph")
    if seeds is None and targets is not None:
        flipped = reach(_flip(edges), low, high, targets.select(F.col("end").alias("start")), None, nodes)
        return _flip(flipped)
    spark = edges.sparkSession
    steps = Rounds(spark, "edges").add(edges.select("start", "end").where(
        "start is not null and end is not null").dropDuplicates())[0]
    steps = steps.select(F.col("start").alias("__from"), F.col("end").alias("__to"))
    if high is None and seeds is None and low <= 1:
        found = _closure(spark, steps)
    else:
        found = _walks(spark, steps, max(low, 1), high, seeds) if high != 0 else None
    if low == 0:
        loops = nodes if seeds is None else nodes.join(
            seeds.select(F.col("start").alias("node")).dropDuplicates(), "node", "left_semi")
        loops = loops.select(F.col("node").alias("start"), F.col("node").alias("end"))
        found = loops if found is None else found.unionByName(loops).dropDuplicates()
    if targets is not None:
        found = found.join(targets.select("end").dropDuplicates(), "end", "left_semi").select("start", "end")
    return found


def _flip(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("end").alias("start"), F.col("start").alias("end"))


def _extend(frontier: DataFrame, steps: DataFrame) -> DataFrame:
    return (
        frontier.join(steps, F.col("end") == F.col("__from"))
        .select("start", F.col("__to").alias("end")).dropDuplicates()
    )


def _walks(spark, steps: DataFrame, low: int, high: int | None, seeds) -> DataFrame:
    first = steps.select(F.col("__from").alias("start"), F.col("__to").alias("end"))
    if seeds is not None:
        first = first.join(seeds.select("start").dropDuplicates(), "start", "left_semi")
    rounds = Rounds(spark, "reached")
    frontier, size = (rounds if low == 1 else Rounds(spark, "walks")).add(first)
    # Up to the lower bound each length is kept apart: a pair may come back at a greater length.
    for _ in range(low - 1):
        if size == 0:
            break
        frontier, size = Rounds(spark, "walks").add(_extend(frontier, steps))
    if low > 1:
        frontier, size = rounds.add(frontier)
    length = low
    while size and (high is None or length < high):
        new = _extend(frontier, steps).join(rounds.all(), ["start", "end"], "left_anti")
        frontier, size = rounds.add(new)
        length += 1
    return rounds.all()


def _closure(spark, steps: DataFrame) -> DataFrame:
    """All pairs joined by a walk, in as many rounds as the longest distance has binary digits.

    Pairs are kept with their distance.  Once all pairs up to distance D are known, a pair at a distance up to 2 D is one
    of distance exactly D followed by a known one, so a round joins just the pairs at distance D with all pairs.  A
    component whose nodes reach each other within D has none of these and costs nothing more, be it ever so dense.
    """
    rounds = Rounds(spark, "closure")
    edge = steps.select(F.col("__from").alias("start"), F.col("__to").alias("end"), F.lit(1).cast("bigint").alias("length"))
    new, _ = rounds.add(edge)
    known = 1
    while True:
        edge_of_known = new.where(F.col("length") == known)
        if edge_of_known.isEmpty():
            return rounds.all().select("start", "end")
        onward = rounds.all().select(F.col("start").alias("__from"), F.col("end").alias("__to"), F.col("length").alias("__more"))
        longer = (
            edge_of_known.join(onward, F.col("end") == F.col("__from"))
            .groupBy("start", F.col("__to").alias("end")).agg((F.min("__more") + known).alias("length")))
        new, _ = rounds.add(longer.join(rounds.all().select("start", "end"), ["start", "end"], "left_anti"))
        known *= 2


def distances(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(node, depth)``: breadth-first depth from the seed nodes (column ``node``)."""
    spark = edges.sparkSession
    rounds = Rounds(spark, "depth")
    steps = edges.select(F.col("start").alias("__from"), F.col("end").alias("__to"))
    frontier, size = rounds.add(seeds.select("node").dropDuplicates().withColumn("depth", F.lit(0)))
    depth = 0
    while size and (max_depth is None or depth < max_depth):
        depth += 1
        new = (
            frontier.join(steps, F.col("node") == F.col("__from")).select(F.col("__to").alias("node")).dropDuplicates()
            .join(rounds.all().select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        )
        frontier, size = rounds.add(new)
    return rounds.all()
