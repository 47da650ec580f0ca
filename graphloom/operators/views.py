"""Materialized views: results stored sorted, read back with filters on their leading columns; pinned results."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def _check(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise ValueError("view names consist of letters, digits, - and _")
    return name


def write_view(df: DataFrame, folder: str, name: str) -> None:
    """Store a result sorted by its first three columns.

    Range partitioning on the sort columns (not just the first) lets one very frequent value span many files; Parquet
    statistics then skip everything but the wanted range.
    """
    order = df.columns[:3]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{folder}/{_check(name)}")


def read_view(spark: SparkSession, folder: str, name: str, fixed: Mapping[str, object] | None = None,
              rename: Mapping[str, str] | None = None) -> DataFrame:
    """Scan a view: fixed columns are filters and drop out, the others may be renamed."""
    view = spark.read.parquet(f"{folder}/{_check(name)}")
    unknown = (set(fixed or {}) | set(rename or {})) - set(view.columns)
    if unknown:
        raise ValueError(f"view {name} has no columns {sorted(unknown)}")
    for column, value in (fixed or {}).items():
        view = view.where(F.col(column) == F.lit(value))
    rest = [c for c in view.columns if c not in (fixed or {})]
    return view.select([F.col(c).alias((rename or {}).get(c, c)) for c in rest])


def _view(name: str) -> str:
    return "view_" + _check(name).replace("-", "_")


def load_view(spark: SparkSession, folder: str, name: str) -> None:
    """Make a stored view known to the session under ``view_<name>``."""
    spark.read.parquet(f"{folder}/{_check(name)}").createOrReplaceTempView(_view(name))


def unload_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(_view(name))


def is_loaded(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_view(name))


def delete_view(spark: SparkSession, folder: str, name: str) -> None:
    """Remove a stored view."""
    unload_view(spark, name)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{_check(name)}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame, name: str) -> DataFrame:
    """Keep a result for reuse under a name; Spark recomputes parts that are lost with an executor."""
    kept = df.persist()
    kept.createOrReplaceTempView("pinned_" + _check(name).replace("-", "_"))
    return kept


def pinned(spark: SparkSession, name: str) -> DataFrame:
    return spark.table("pinned_" + _check(name).replace("-", "_"))


def unpin(spark: SparkSession, name: str) -> None:
    table = "pinned_" + _check(name).replace("-", "_")
    spark.table(table).unpersist()
    spark.catalog.dropTempView(table)
