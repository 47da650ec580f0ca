"""Path search: every simple path from sources to targets, one result row per edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from graphloom.plans.transitive import distances, reach
from graphloom.session import Rounds, cut_lineage


def path_search(edges: DataFrame, sources: DataFrame | None = None, targets: DataFrame | None = None,
                start: str = "start", end: str = "end", path_column: str = "path", edge_column: str = "edge",
                edge_properties: Sequence[str] = (), pairs: DataFrame | None = None,
                paths_per_target: int | None = None, max_depth: int | None = None) -> DataFrame:
    """All simple paths; columns source, target, path, edge, start, end and the edge properties.

    ``sources`` and ``targets`` are tables with one column of nodes; without targets every path from a source counts,
    without sources every start node is one.  ``pairs(source, target)`` restricts to given combinations instead (the
    non-cartesian form).  ``paths_per_target`` keeps the shortest paths per source and target.  The path id is a hash of
    the path's edges, so it does not depend on partitioning.

    The number of simple paths can grow exponentially; edges that cannot lie on a wanted path are removed first, using
    depths from both ends.  With ``pairs`` or ``paths_per_target`` a path grows only towards targets that its own source
    still wants: a pair that has its paths is finished, and paths that lead to finished pairs only are dropped.
    """
    if max_depth is not None and max_depth < 0:
        raise ValueError("max_depth must not be negative")
    if pairs is not None and (sources is not None or targets is not None):
        raise ValueError("give pairs or sources and targets")
    spark = edges.sparkSession
    # Every round reads the edges, and the pairs are read from both sides: they are computed once.
    base = cut_lineage(_numbered_edges(edges, start, end, edge_properties), "numbered")
    if pairs is not None:
        pairs = cut_lineage(pairs.toDF("source", "target").dropDuplicates(), "pairs")
        wanted_sources = pairs.select(F.col("source").alias("node"))
        wanted_targets = pairs.select(F.col("target").alias("node"))
    else:
        wanted_sources = None if sources is None else sources.toDF("node")
        wanted_targets = None if targets is None else targets.toDF("node").dropDuplicates()
    steps = _useful_edges(base, wanted_sources, wanted_targets, max_depth)
    first = steps if wanted_sources is None else steps.join(
        wanted_sources.select(F.col("node").alias("start")).dropDuplicates(), "start", "left_semi")
    if pairs is None and paths_per_target is None:
        hits = _grow(spark, steps, first, wanted_targets, max_depth)
    else:
        hits = _grow_towards(spark, steps, first, pairs, wanted_targets, paths_per_target, max_depth)
    return hits.select("source", "target", F.col("path_id").alias(path_column), F.posexplode("edges").alias(edge_column, "e")).select(
        "source", "target", path_column, edge_column, F.col("e.start").alias(start), F.col("e.end").alias(end),
        *[F.col(f"e.{p}") for p in edge_properties])


def _numbered_edges(edges: DataFrame, start: str, end: str, properties: Sequence[str]) -> DataFrame:
    """Edges with parallel copies told apart by a number, so that each copy stays an edge of its own."""
    columns = [F.col(start).alias("start"), F.col(end).alias("end"), *properties]
    counted = edges.select(*columns).where("start is not null and end is not null").groupBy(
        "start", "end", *properties).agg(F.count(F.lit(1)).alias("__n"))
    return counted.withColumn("copy", F.explode_outer(F.sequence(F.lit(1), F.col("__n")))).drop("__n")


def _useful_edges(base: DataFrame, sources, targets, max_depth) -> DataFrame:
    """Edges that lie on a walk from a source to a target of allowed length; ``left`` is the way still to go."""
    if max_depth == 0:
        return base.limit(0).withColumn("left", F.lit(0))
    steps = base.where("start <> end")
    if targets is not None:
        reversed_ = steps.select(F.col("end").alias("start"), F.col("start").alias("end")).dropDuplicates()
        to_go = distances(reversed_, targets, None if max_depth is None else max_depth - 1)
        steps = steps.join(to_go.select(F.col("node").alias("end"), F.col("depth").alias("left")), "end")
    else:
        steps = steps.withColumn("left", F.lit(0))
    if sources is not None:
        plain = steps.select("start", "end").dropDuplicates()
        come = distances(plain, sources, None if max_depth is None else max_depth - 1)
        steps = steps.join(come.select(F.col("node").alias("start"), F.col("depth").alias("__come")), "start")
        if max_depth is not None:
            steps = steps.where(F.col("__come") + 1 + F.col("left") <= max_depth)
        steps = steps.drop("__come")
    return Rounds(base.sparkSession, "useful").add(steps)[0]


def _edge(steps: DataFrame):
    return F.struct("start", "end", *sorted(c for c in steps.columns if c not in ("start", "end", "copy", "left")), "copy")


def _paths_of_one(first: DataFrame) -> DataFrame:
    return first.select(
        F.col("start").alias("source"), F.col("end").alias("last"), F.array("start", "end").alias("nodes"),
        F.array(_edge(first)).alias("edges"), "left")


def _longer(frontier: DataFrame, steps: DataFrame, depth: int, max_depth: int | None) -> DataFrame:
    """Paths of ``depth`` + 1 edges from paths of ``depth`` edges."""
    onward = steps.select(F.col("start").alias("__from"), F.col("end").alias("__to"), _edge(steps).alias("__edge"), F.col("left").alias("__left"))
    grown = frontier.join(onward, (F.col("last") == F.col("__from")) & ~F.array_contains("nodes", F.col("__to")))
    if max_depth is not None:
        grown = grown.where(F.col("__left") + depth + 1 <= max_depth)
    return grown.select(
        "source", F.col("__to").alias("last"), F.array_append("nodes", F.col("__to")).alias("nodes"),
        F.array_append("edges", F.col("__edge")).alias("edges"), F.col("__left").alias("left"))


def _as_hits(paths: DataFrame, *more: str) -> DataFrame:
    return paths.select(
        *more, "source", F.col("last").alias("target"), "edges", F.size("edges").alias("length"),
        F.md5(F.array_join(F.transform("edges", lambda e: F.to_json(e)), "|")).alias("path_id"))


def _grow(spark, steps: DataFrame, first: DataFrame, targets, max_depth) -> DataFrame:
    """Level-synchronous growth: paths of length n+1 from paths of length n, written out per level."""
    rounds = Rounds(spark, "paths")
    frontier, size = rounds.add(_paths_of_one(first))
    depth = 1
    while size and (max_depth is None or depth < max_depth):
        frontier, size = rounds.add(_longer(frontier, steps, depth, max_depth))
        depth += 1
    found = rounds.all()
    if targets is not None:
        found = found.join(targets.select(F.col("node").alias("last")), "last", "left_semi")
    return _as_hits(found)


def _grow_towards(spark, steps: DataFrame, first: DataFrame, pairs, targets, per_target: int | None, max_depth) -> DataFrame:
    """Growth towards wanted pairs only, level by level, so paths come shortest first.

    ``wanted`` are the open pairs and how many paths each still lacks; a path stays if some open target of its source
    can be reached from its last node.
    """
    plain = steps.select("start", "end").dropDuplicates()
    if pairs is None:
        # The pairs that have a path at all; each gives a row of the result.
        ends = None if targets is None else targets.select(F.col("node").alias("end"))
        pairs = reach(plain, seeds=first.select("start").dropDuplicates(), targets=ends).toDF("source", "target")
    pairs = pairs.where("source <> target").withColumn("lacks", F.lit(per_target).cast("bigint"))
    wanted, lack = Rounds(spark, "wanted").add(pairs)
    ends = wanted.select(F.col("target").alias("end")).dropDuplicates()
    ways = reach(plain, targets=ends).select(F.col("start").alias("last"), F.col("end").alias("target"))
    ways = cut_lineage(ways.unionByName(ends.select(F.col("end").alias("last"), F.col("end").alias("target"))).dropDuplicates(), "ways")

    def open_ways():
        """(source, last): nodes from which a source's paths may still go on."""
        return cut_lineage(wanted.join(ways, "target").select("source", "last").dropDuplicates(), "leads")

    hits, level, depth, leads = Rounds(spark, "hits"), _paths_of_one(first), 1, open_ways()
    while True:
        frontier, size = Rounds(spark, "paths").add(level.join(leads, ["source", "last"], "left_semi").select(level.columns))
        ended = frontier.join(wanted.select("source", F.col("target").alias("last"), "lacks"), ["source", "last"])
        here = _as_hits(ended, "lacks")
        if per_target is not None:
            best = Window.partitionBy("source", "target").orderBy("path_id")
            here = here.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= F.col("lacks")).drop("__r")
        found, n = hits.add(here.drop("lacks"))
        if per_target is not None and n:
            got = found.groupBy("source", "target").agg(F.count(F.lit(1)).alias("__got"))
            rest = wanted.join(got, ["source", "target"], "left").withColumn("lacks", F.col("lacks") - F.coalesce("__got", F.lit(0)))
            wanted, lack = Rounds(spark, "wanted").add(rest.where("lacks > 0").drop("__got"))
            # Pairs were finished: some paths may lead nowhere now.
            leads = open_ways()
            frontier = frontier.join(leads, ["source", "last"], "left_semi").select(frontier.columns)
        if not size or not lack or max_depth is not None and depth >= max_depth:
            return hits.all()
        level = _longer(frontier, steps, depth, max_depth)
        depth += 1
