"""Joins that stay even: with a lookup table where a few keys hold most of the rows, and where keys repeat on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.session import task_count


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: Column, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, which has one row per ``key``.

    ``weight`` is the number of rows each key has.  Keys with more than 1/``share`` of all rows are at most ``share``
    many, so broadcasting just them is bounded whatever the data size; their rows never move.  All other keys are
    small and are joined by an ordinary shuffle.
    """
    cells = [c for c in lookup.columns if c != key]
    weighted = lookup.withColumn("__w", weight.cast("double"))
    limit = weighted.agg((F.sum("__w") / share).alias("__limit"))
    flagged = weighted.crossJoin(F.broadcast(limit)).withColumn("__hot", F.col("__w") > F.col("__limit"))
    # At most ``share`` rows: see above.
    hot = flagged.where("__hot").select(F.col(key).alias("__k"), F.struct(*cells).alias("__hit"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__k"), "left")
    fast = marked.where("__k is not null").select(*rows.columns, *[F.col(f"__hit.{c}").alias(c) for c in cells])
    cold = marked.where("__k is null").select(*rows.columns)
    return fast.unionByName(cold.join(flagged.where("not __hot").select(key, *cells), key))


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], chunk: int = 1000) -> DataFrame:
    """Inner join on ``on`` where a key may have very many rows on both sides, so that its result is a large product.

    A key with more than ``chunk`` squared pairs is dealt over a grid: each side's rows fall into parts of about ``chunk``
    rows by a hash of the row and meet each part of the other side in a cell of its own.  A row is copied once for about
    ``chunk`` rows of the result.  Cells and keys are dealt to a fixed number of tasks: the inputs are small against the
    result, and adaptive execution would pack them into a few.
    """
    on = list(on)
    counts = [df.groupBy(*on).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "__nl"), (right, "__nr"))]
    pairs = F.col("__nl").cast("double") * F.col("__nr")
    parts = [F.ceil(F.col(n) / chunk).cast("int").alias(p) for n, p in (("__nl", "__pl"), ("__nr", "__pr"))]
    large = counts[0].join(counts[1], on).where(pairs > float(chunk) ** 2).select(*on, *parts)

    dealt = [_dealt(df, large, on, *names) for df, *names in (
        (left, "__pl", "__pr", "__i", "__j"), (right, "__pr", "__pl", "__j", "__i"))]
    rows = dealt[0].join(dealt[1], [*on, "__i", "__j"])
    return rows.select(*on, *[c for df in (left, right) for c in df.columns if c not in on])


def _dealt(df: DataFrame, large: DataFrame, on: Sequence[str], mine: str, other: str, own: str, across: str) -> DataFrame:
    """Rows in their part ``own``, with a copy for each part ``across`` of the other side; ``large`` has the numbers of parts."""
    part = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col(mine)).cast("int"), F.lit(0))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    rows = df.join(large, on, "left").select(*df.columns, part.alias(own), F.explode(copies).alias(across))
    return rows.repartition(task_count(df.sparkSession), *on, "__i", "__j")


#: Cells over which ``packed_join`` deals a key, unless its parts would get too large or too small.
CELLS = 64


def packed_join(left: DataFrame, right: DataFrame, on: Sequence[str], chunk: int = 1000) -> DataFrame:
    """Inner join on ``on`` like ``spread_join``, for results that are nearly all product: few copies move.

    A key gets about ``CELLS`` cells.  Parts have at least about ``chunk`` rows, and at most 4 ``chunk`` of the right and 64
    ``chunk`` of the left side, so a large key has one copied row for about 4 ``chunk`` rows of the result.  Within its cell
    the right side is packed into arrays of at most ``chunk`` rows, which each left row unfolds.
    """
    on, cells = list(on), [c for c in right.columns if c not in on]
    cell = [*on, "__i", "__j"]
    counts = [df.groupBy(*on).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "__nl"), (right, "__nr"))]

    def parts(rows: str, wanted: Column, most: int) -> Column:
        return F.least(F.ceil(F.col(rows) / chunk), F.greatest(wanted, F.ceil(F.col(rows) / most))).cast("int")

    sizes = counts[0].join(counts[1], on).withColumn("__pr", parts("__nr", F.lit(CELLS).cast("bigint"), 4 * chunk))
    sizes = sizes.withColumn("__pl", parts("__nl", F.ceil(F.lit(CELLS) / F.col("__pr")), 64 * chunk))
    large = sizes.where("__pl > 1 or __pr > 1").select(*on, "__pl", "__pr")
    # Equal rows fall into one part, so rows are numbered there and no array grows beyond its size.  Any order will do: the
    # join runs in the same task.
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.lit(0)))
    numbered = _dealt(right, large, on, "__pr", "__pl", "__j", "__i").withColumn("__block", F.floor((place - 1) / chunk))
    packed = F.collect_list(F.struct(*(cells or [F.lit(0).alias("__none")]))).alias("__rows")
    blocks = numbered.groupBy(*cell, "__block").agg(packed).drop("__block")
    # Merged, so that left rows stream; a table of their copies would have to fit into memory.
    met = _dealt(left, large, on, "__pl", "__pr", "__i", "__j").join(blocks.hint("merge"), cell)
    return met.select(*left.columns, F.inline("__rows")).select(*on, *[c for df in (left, right) for c in df.columns if c not in on])
