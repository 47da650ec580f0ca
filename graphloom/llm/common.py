"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: what counts as a word.  Python's ``bytes.split()`` cuts at exactly the same characters, and
#: ``bytes.lower()`` lower-cases exactly A-Z, so work on UTF-8 bytes agrees with this pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def utf8(text: Column) -> Column:
    """The text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(text.cast("binary"), F.lit("").cast("binary"))


def long_ids(df: DataFrame, column: str) -> DataFrame:
    """Whole-number ids as 64-bit integers, which is what Python tasks give back."""
    return df.withColumn(column, F.col(column).cast("long")) if dict(df.dtypes)[column] in ("tinyint", "smallint", "int") else df


def partition_sums(rows: DataFrame, part, width: int) -> list:
    """Sum over all rows of what ``part(batch)`` gives, {key: matrix of ``width`` columns}, as rows (key, row, v).

    Each partition adds up its own; then every row of a matrix is summed on its own, so a task holds one row of each
    partition's matrix, and the driver gets one matrix per key.
    """

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for key, value in part(batch).items():
                    total[key] = total[key] + value if key in total else value
        for key, value in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(value), pa.int32()), pa.array(range(len(value)), pa.int32()),
                 pa.array(list(np.asarray(value, float)), pa.list_(pa.float64()))], ["key", "row", "v"])

    def add(group: pa.Table) -> pa.Table:
        values = group.column("v").combine_chunks()
        total = values.flatten().to_numpy().reshape(-1, width).sum(axis=0)
        return pa.table({"key": group.column("key")[:1], "row": group.column("row")[:1],
                         "v": pa.array([total], pa.list_(pa.float64()))})

    kind = "key int, row int, v array<double>"
    return rows.mapInArrow(run, kind).groupBy("key", "row").applyInArrow(add, kind).collect()


def cell_runs(batches, columns: list[str]):
    """Runs of rows with equal ``cell`` (of a table sorted by it) as lists by column, across batch borders.

    For cells of bounded size only: a run is held whole.
    """
    held: dict[str, list] = {c: [] for c in columns}
    for batch in batches:
        for c in columns:
            held[c].extend(batch.column(c).to_pylist())
        cell = np.array(held["cell"], np.int64)
        cuts = np.flatnonzero(np.diff(cell)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts):
            yield {c: v[a:b] for c, v in held.items()}
        if len(cuts):
            held = {c: v[cuts[-1]:] for c, v in held.items()}
    if held["cell"]:
        yield held
