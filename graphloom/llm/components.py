"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, functions as F

from graphloom.session import shared_folder


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; a component is named by its smallest node.

    Large-star links each node's larger neighbours to its smallest neighbour, small-star does so with the smaller ones;
    the two are repeated until a round changes nothing.  Rounds are written to the shared folder.  Null ends and
    loops drop out, repeated edges count once, and no edges give no rows.
    """
    spark, base = edges.sparkSession, f"{shared_folder(edges.sparkSession)}/components-{uuid.uuid4().hex}"
    turn, last = 0, None

    def write(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen, path = Observation(), f"{base}/{turn}"
        df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), (seen.get["n"], seen.get["x"])

    now, mark = write(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u is not null and v is not null and u <> v").where(F.col("u") > F.col("v")).distinct())
    while mark != last:
        turn, last = turn + 1, mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now, mark = write(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
