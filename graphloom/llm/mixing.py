"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that may count them).  A flow network routes the
words of each pattern to the quotas of its sources; the second, third, ... use of a pattern's words costs more than the
one before, so nothing is repeated while fresh words would do.  Patterns are few, so the network is solved on the driver;
documents are then picked by a seeded order within each pattern, distributed.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from graphloom.llm.common import table, word_count
from graphloom.session import cut_lineage

#: Weights of the sources in order, repeating.
CYCLE = (3, 1, 2)
#: Most patterns the driver takes.
MAX_PATTERNS = 100_000
#: Pieces of a pattern that are ordered on their own.
PIECES = 1024


def water_fill(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Share ``total`` by weight; nobody gets more than ``cap`` times their size, and what is cut off is shared again."""
    level = sorted(range(len(sizes)), key=lambda i: cap * sizes[i] / weights[i])
    out, rest, weight = [0.0] * len(sizes), total, float(sum(weights))
    for i in level:
        # Those filled first have the least room for their weight.
        out[i] = min(cap * sizes[i], rest * weights[i] / weight)
        rest -= out[i]
        weight -= weights[i]
    return out


def _levels(n: int, arcs: list[list[int]], graph: list[list[int]], source: int) -> list[int]:
    level = [-1] * n
    level[source] = 0
    todo = deque([source])
    while todo:
        at = todo.popleft()
        for k in graph[at]:
            to, room = arcs[k]
            if room and level[to] < 0:
                level[to] = level[at] + 1
                todo.append(to)
    return level


def _max_flow(n: int, arcs: list[list[int]], graph: list[list[int]], source: int, sink: int) -> None:
    """Fill shortest paths, one layered network after the other.  ``arcs[k ^ 1]`` is the reverse of ``arcs[k]``."""
    while True:
        level = _levels(n, arcs, graph, source)
        if level[sink] < 0:
            return
        tried, path, at = [0] * n, [], source
        while True:
            if at == sink:
                push = min(arcs[k][1] for k in path)
                for k in path:
                    arcs[k][1] -= push
                    arcs[k ^ 1][1] += push
                path, at = [], source
                continue
            while tried[at] < len(graph[at]):
                k = graph[at][tried[at]]
                if arcs[k][1] and level[arcs[k][0]] == level[at] + 1:
                    break
                tried[at] += 1
            if tried[at] < len(graph[at]):
                path.append(k)
                at = arcs[k][0]
            elif path:
                at = arcs[path.pop() ^ 1][0]
                tried[at] += 1
            else:
                break


def route(capacity: list[int], members: list[list[int]], quotas: list[int], uses: int) -> list[dict[int, int]]:
    """Words of each pattern sent to each source: a maximal flow of least repetition cost.

    ``capacity[p]`` words may be used up to ``uses`` times.  The r-th use costs r - 1 a word and nothing else costs, so
    the cheapest augmenting paths are those of the lowest use: one maximal flow per use, each on the last one's residue.
    """
    p, s = len(capacity), len(quotas)
    n, source, sink = p + s + 2, p + s, p + s + 1
    arcs: list[list[int]] = []
    graph: list[list[int]] = [[] for _ in range(n)]

    def arc(a: int, b: int, room: int) -> int:
        graph[a].append(len(arcs))
        graph[b].append(len(arcs) + 1)
        arcs.extend(([b, room], [a, 0]))
        return len(arcs) - 2

    for j, quota in enumerate(quotas):
        arc(p + j, sink, quota)
    links = [{j: arc(i, p + j, capacity[i] * uses) for j in own} for i, own in enumerate(members)]
    for _ in range(uses):
        for i, words in enumerate(capacity):
            arc(source, i, words)
        _max_flow(n, arcs, graph, source, sink)
    return [{j: arcs[k ^ 1][1] for j, k in own.items() if arcs[k ^ 1][1]} for own in links]


def source_targets(sized: DataFrame, sources: str = "sources", size: str = "size", share: float = 1.5,
                   cap: float = 2.0, weights: dict | None = None) -> list[tuple]:
    """(source, its size, target) by code point, a null source last.  One row per source reaches the driver.

    Sources named in ``weights`` take that weight; all others 3, 1, 2, repeating.
    """
    per = sized.select(F.explode(sources).alias("source"), F.col(size).alias("size")).groupBy("source").agg(
        F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(per) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    per = sorted(per, key=lambda r: (r["source"] is None, r["source"] or ""))
    given = [float((weights or {}).get(r["source"], CYCLE[i % len(CYCLE)])) for i, r in enumerate(per)]
    sizes = [r["size"] for r in per]
    # Overlapping sources share words; each word counts once in the whole.
    whole = sized.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return [(r["source"], r["size"], t) for r, t in zip(per, water_fill(sizes, given, share * whole, cap))]


def mix(docs: DataFrame, targets: list[tuple], key: tuple[str, ...] = ("doc_id",), uses: int = 2, seed: int = 0) -> DataFrame:
    """Add ``taken``, the words the mix takes from each row, to ``docs`` (columns ``sources`` array, ``size`` long).

    A row is taken whole, none or up to ``uses`` times.  Within a pattern every row is taken t // size times, and the rest
    of t goes to the rows that stand first in a seeded order of ``key``, topped up by the one row that comes
    closest to what is then missing.  Rows without sources or words take nothing; an empty table gives no rows; equal
    rows are interchangeable.
    """
    spark = docs.sparkSession
    # A null array is a pattern like the empty one: its rows stay and take nothing.
    name = F.coalesce(F.to_json("sources"), F.lit("[]"))
    found = (docs.where("size > 0 and size(sources) > 0").groupBy(name.alias("__p")).agg(F.sum("size").alias("size"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found = sorted(found, key=lambda r: r["__p"])
    number = {t[0]: i for i, t in enumerate(targets)}
    members = [[number[x] for x in dict.fromkeys(json.loads(r["__p"]))] for r in found]
    flows = route([r["size"] for r in found], members, [round(t[2]) for t in targets], uses)
    plan = spark.createDataFrame(
        [(r["__p"], sum(f.values()) // r["size"], sum(f.values()) % r["size"]) for r, f in zip(found, flows)],
        "__p string, __whole long, __part long")

    columns = docs.columns
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in key])
    lined = docs.withColumn("__p", name).withColumn("__h", h).withColumn("__piece", F.pmod(F.shiftright("__h", 40), F.lit(PIECES)))
    # The seeded order is (piece, hash, key, size); a pattern's pieces are dealt to different tasks.
    sums = lined.groupBy("__p", "__piece").agg(F.sum("size").alias("__n"))
    sums = sums.withColumn("__base", F.sum("__n").over(W.partitionBy("__p").orderBy("__piece")) - F.col("__n")).drop("__n")
    inner = W.partitionBy("__p", "__piece").orderBy("__h", *key, "size")
    lined = lined.withColumn("__to", F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    lined = (lined.join(sums, ["__p", "__piece"]).withColumn("__to", F.col("__base") + F.col("__to"))
             .join(F.broadcast(plan), "__p", "left")       # at most MAX_PATTERNS rows
             .withColumn("__in", (F.col("__to") <= F.col("__part")) & (F.col("size") > 0)))
    # What the rows before the cut leave open, and the row beyond it that fits best.
    gap = lined.groupBy("__p").agg((F.max("__part") - F.coalesce(F.max(F.when(F.col("__in"), F.col("__to"))), F.lit(0))).alias("__gap"))
    off = F.abs(F.col("size") - F.col("__gap"))
    best = (lined.join(F.broadcast(gap), "__p").where(~F.col("__in") & (F.col("size") > 0) & (off < F.col("__gap")))
            .groupBy("__p").agg(F.min(F.struct(off.alias("off"), F.col("__to").alias("to"))).alias("__b")).select("__p", "__b.to"))
    out = lined.join(F.broadcast(best), "__p", "left")
    more = F.col("__in") | F.coalesce((F.col("__to") == F.col("to")) & (F.col("size") > 0), F.lit(False))
    return out.select(*columns, F.coalesce(F.col("size") * (F.col("__whole") + more.cast("long")), F.lit(0)).cast("long").alias("taken"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    copies = F.array_repeat(F.lit(0), (F.col("taken") / F.col("size")).cast("int"))
    return mixed.where("taken > 0").withColumn("__copy", F.explode(copies)).drop("__copy")


def sized(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """Documents with ``size`` in words and their single source as ``sources``."""
    return docs.select(*keep, F.array("source").alias("sources"), word_count(F.col("text")).alias("size"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cut_lineage(sized(table(spark, sf_dir, "documents"), "doc_id", "source"), "sizes")
    targets = source_targets(docs)
    goals = spark.createDataFrame([(s, n, float(t)) for s, n, t in targets], "s string, source_size long, target double")
    return (mix(docs, targets).join(F.broadcast(goals), F.col("source").eqNullSafe(F.col("s")))    # one row per source
            .select("doc_id", "size", "source_size", "target", "taken"))
