"""A training corpus from raw documents: filter, de-duplicate, decontaminate, mix and shard."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm import decontaminate, minhash, mixing, quality, sharding
from graphloom.llm.common import table
from graphloom.session import shared_folder


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): that of the smallest id."""
    return minhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    sized = mixing.sized(docs, *docs.columns)
    return mixing.repeated(mixing.mix(sized, mixing.source_targets(sized))).select(*docs.columns)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, bytes of the text, shard and slot of each row; row counts of two shards differ by one at most."""
    facts = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    return sharding.shard(facts, 16, slack=0.0, tie=("n_bytes",)).select("doc_id", "n_bytes", "shard", "slot")


STAGES = [
    ("quality", filter_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_leaks),
    ("mixing", mix_sources), ("sharding", deal_shards),
]
#: Trained models and min-cost flow are beyond SQL; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs, base = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
