"""Registry of runnable queries: name -> (Spark query, SQL that must give the same rows or None)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from graphloom.sources.mapping import MappedGraph, TableMap

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"{fn.__name__} is registered twice")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MAPS = {
    "region": dict(key=["r_regionkey"], prefix="r_"),
    "nation": dict(key=["n_nationkey"], prefix="n_", refs={"n_regionkey": "region"}),
    "customer": dict(key=["c_custkey"], prefix="c_", refs={"c_nationkey": "nation"}),
    "supplier": dict(key=["s_suppkey"], prefix="s_", refs={"s_nationkey": "nation"}),
    "part": dict(key=["p_partkey"], prefix="p_"),
    "orders": dict(key=["o_orderkey"], prefix="o_", refs={"o_custkey": "customer"}),
    "documents": dict(key=["doc_id"], lang={"text": "lang"}),
    "labels": dict(key=["doc_id"], refs={"doc_id": "documents"}),
    "events": dict(key=["event_id"], refs={"user_id": "user"}),
}


def table_map(spark: SparkSession, sf_dir: str, name: str, **changes) -> TableMap:
    df = table(spark, sf_dir, name)
    return TableMap(name, df, **{**_MAPS[name], **changes})


def graph(spark: SparkSession, sf_dir: str, *names: str) -> MappedGraph:
    return MappedGraph([table_map(spark, sf_dir, n) for n in names])
