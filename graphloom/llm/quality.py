"""Quality classifier: random Fourier features over document statistics, ridge by summed normal equations, isotonic scores.

The statistics of every text are computed once.  Each partition of the labelled rows adds up its own normal equations, for
two halves apart; their sums are formed by row of the matrix, so no task and not the driver ever holds more than
two fixed-size matrices.  Each half is scored by the other half's model to fit the isotonic map.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from graphloom.llm.common import fold, partition_sums, table, utf8
from graphloom.session import cut_lineage, ship

#: Cosines in the approximation of the kernel, width of the kernel in standard deviations, ridge penalty per row.
COSINES, WIDTH, RIDGE = 256, 3.0, 1e-4
#: Steps of the isotonic map and the range of raw scores they cover.
BINS, LOW, HIGH = 1024, -0.5, 1.5
#: What the raw score keeps of the final one, so that equal steps still rank.
KEEP = 0.02


def _kinds() -> np.ndarray:
    """Groups of byte values, one row each."""
    letters, upper = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    groups = [letters, upper, b"0123456789", b".", b",", b"!?;:", b"'\"()-", b"|", b"#$%&*+=<>@\\^_`{}~[]/", b" ", b"\n",
              b"\t\r\x0b\x0c", bytes(range(128, 256))]
    out = np.zeros((len(groups), 256))
    for row, group in zip(out, groups):
        row[list(group)] = 1
    return out


_KINDS = _kinds()
SIZE = len(_KINDS) + 13


def statistics(data: bytes) -> np.ndarray:
    """Statistics of a whole text as UTF-8; an empty text gives zeros."""
    out = np.zeros(SIZE, np.float32)
    if not data:
        return out
    n, counts = len(data), np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), data.split(b"\n")
    m, share = len(words), counts[counts > 0] / n
    out[: len(_KINDS)] = _KINDS @ counts / n
    out[-13:-10] = np.log1p(n), np.log1p(m), -(share * np.log(share)).sum()
    if m:
        times = Counter(words)
        lengths = np.fromiter(map(len, words), np.int64, m)
        out[-10:-4] = (np.log1p(lengths.mean()), np.log1p(lengths.max()), lengths.std() / lengths.mean(), len(times) / m,
                       max(times.values()) / m, len(set(zip(words, words[1:]))) / m)
    filled = [line for line in lines if line]
    if filled:
        out[-4:] = (np.log1p(len(filled)), 1 - len(set(filled)) / len(filled), np.log1p(n / len(filled)),
                    sum(line[-1:] in b".!?" for line in filled) / len(filled))
    return out


@F.pandas_udf(ArrayType(FloatType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


def document_statistics(text: Column) -> Column:
    return _statistics(utf8(text))


@dataclass
class QualityModel:
    """mean, scale: of the statistics; angles, shifts: the random features; beta: ridge weights; steps: isotonic map."""

    mean: np.ndarray
    scale: np.ndarray
    angles: np.ndarray
    shifts: np.ndarray
    beta: np.ndarray | None = None
    steps: np.ndarray | None = None
    constant: float | None = None

    def expand(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), x, np.cos(x @ self.angles + self.shifts) * np.sqrt(2 / len(self.shifts))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        raw = self.expand(x) @ self.beta
        return (1 - KEEP) * self.steps[_bin(raw)] + KEEP * np.clip(raw, 0, 1)


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)


def isotonic(total: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The non-decreasing steps closest to hits / total by weighted squares; empty bins take the level before them."""
    blocks: list[list[float]] = []
    for w, s in zip(total, hits):
        blocks.append([s, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), s / w if w else 0.0) for s, w, k in blocks])


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE).astype(float)


def train(labelled: DataFrame, seed: int = 0) -> QualityModel:
    """Fit on rows (x: statistics, y: 0 or 1, half: 0 or 1).  All rows count; what reaches the driver has a fixed size.

    Without rows, or with one label only, the model gives the mean label (0.5 without rows) to every text.
    """
    ship(labelled.sparkSession)
    basic = {r["row"]: np.array(r["v"]) for r in partition_sums(labelled, lambda b: {0: (lambda x, y: np.vstack([
        np.append(x.sum(0), len(x)), np.append((x * x).sum(0), y.sum())]))(_table(b), b.column("y").to_numpy())}, SIZE + 1)}
    if not basic:
        return QualityModel(*[np.zeros(SIZE)] * 4, constant=0.5)
    n, hits = basic[0][-1], basic[1][-1]
    mean = basic[0][:-1] / n
    scale = np.sqrt(np.maximum(basic[1][:-1] / n - mean**2, 0))
    draw = np.random.default_rng(seed)
    model = QualityModel(mean, np.where(scale > 1e-6, scale, 1.0), draw.normal(size=(SIZE, COSINES)) / (WIDTH * np.sqrt(SIZE)),
                         draw.uniform(0, 2 * np.pi, COSINES))
    if hits in (0, n):
        model.constant = float(hits / n)
        return model

    def equations(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        z = np.hstack([model.expand(_table(batch)), batch.column("y").to_numpy().astype(float)[:, None]])
        half = batch.column("half").to_numpy()
        return {int(h): z[half == h].T @ z[half == h] for h in np.unique(half)}

    side = 1 + SIZE + COSINES + 1
    gram = np.zeros((2, side, side))
    for r in partition_sums(labelled, equations, side):
        gram[r["key"], r["row"]] = r["v"]

    def solve(g: np.ndarray) -> np.ndarray:
        penalty = np.full(side - 1, RIDGE * max(g[0, 0], 1.0))
        penalty[0] = 1e-9
        return np.linalg.solve(g[:-1, :-1] + np.diag(penalty), g[:-1, -1])

    model.beta = solve(gram.sum(0))
    # A half without rows of its own is scored by the model of all rows.
    other = [solve(gram[1 - h]) if gram[1 - h, 0, 0] else model.beta for h in (0, 1)]

    def binned(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        z, half, y = model.expand(_table(batch)), batch.column("half").to_numpy(), batch.column("y").to_numpy()
        at = _bin(np.where(half == 0, z @ other[0], z @ other[1]))
        return {0: np.vstack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])}

    counts = {r["row"]: np.array(r["v"]) for r in partition_sums(labelled, binned, BINS)}
    model.steps = isotonic(counts[0], counts[1])
    return model


def scorer(model: QualityModel):
    """A function of the statistics column that gives the score, 0 to 1."""

    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy()).astype(float)) if len(x) else [], dtype=float)

    return F.pandas_udf(run, DoubleType())


def labelled_rows(known: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """x, y, half of the labelled rows outside the held-out fold.  Null labels do not count; of several the highest does."""
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    return (known.select("doc_id", "x").where(fold(F.col("doc_id")) != 0).join(marks, "doc_id")
            .select("x", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int").alias("half")))


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with the columns of ``docs``.

    Scores depend on the text alone.  Null texts count as empty; equal rows share their fate; an empty table stays empty.
    """
    ship(docs.sparkSession)
    marked = labels.select("doc_id").distinct()
    known = docs.join(marked, "doc_id", "left_semi").select("doc_id", document_statistics(F.col("text")).alias("x"))
    model = train(cut_lineage(labelled_rows(known, labels, "quality"), "quality"), seed)
    return docs.where(scorer(model)(document_statistics(F.col("text"))) >= threshold)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    known = cut_lineage(table(spark, sf_dir, "documents").select("doc_id", document_statistics(F.col("text")).alias("x")), "statistics")
    model = train(cut_lineage(labelled_rows(known, table(spark, sf_dir, "labels"), "quality"), "quality"))
    scored = known.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), scorer(model)(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
