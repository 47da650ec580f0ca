"""DESCRIBE: the triples of resources, followed through blank nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from graphloom.operators.scan import as_quads
from graphloom.session import Rounds


def describe(graph, resources: DataFrame) -> DataFrame:
    """Distinct ``(s, p, o)`` of the resources (column ``node``) and, repeatedly, of their blank-node objects."""
    quads = as_quads(graph).select("s", "p", "o")
    spark = quads.sparkSession
    rounds, seen = Rounds(spark, "describe"), Rounds(spark, "described")
    frontier, _ = seen.add(resources.select("node").where("node is not null").dropDuplicates())
    while True:
        triples, size = rounds.add(quads.join(frontier.select(F.col("node").alias("s")), "s", "left_semi").dropDuplicates())
        if size == 0:
            break
        blank = triples.where(F.col("o").startswith("_:")).select(F.col("o").alias("node")).dropDuplicates()
        frontier, size = seen.add(blank.join(seen.all(), "node", "left_anti"))
        if size == 0:
            break
    return rounds.all().select("s", "p", "o")
