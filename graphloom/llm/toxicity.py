"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled text are used.  A linear classifier over hashed words and word beginnings (so that
inflected and compounded forms count together) minimises the class-prior-corrected
risk  pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])  with logistic loss l; where the second part, the risk on the
hidden negatives, falls below zero, the step goes the other way until it is an honest risk again.  Several
members are trained as Spark tasks, each on two thirds of a bounded sample; their probabilities are averaged.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from graphloom.llm.common import fold, table, utf8
from graphloom.session import ship

#: Largest numbers of confirmed and of unlabelled texts that are learnt from, and members of the ensemble.
POSITIVES, UNLABELLED, MEMBERS = 4_000, 12_000, 3
#: Lengths of word beginnings, in characters.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Hash buckets of words and beginnings.  A bucket counts if that many texts of a member's sample have it and its shares among confirmed
#: and unlabelled texts differ by that many standard errors and that factor.
BUCKETS, SUPPORT, ERRORS, LIFT = 1 << 18, 4, 3.0, 3.0
STEPS, RATE, DECAY = 300, 0.05, 1e-4
#: Words whose weights a worker remembers.
CACHE_WORDS = 400_000

#: ASCII marks, digits and white space separate words.
_SPLIT = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def terms(data: bytes) -> set[bytes]:
    """The distinct words of a whole text."""
    return set(data.lower().translate(_SPLIT).split())


def buckets(word: bytes) -> list[int]:
    """Buckets of a word and its beginnings."""
    text = word.decode("utf-8", "replace")
    begun = [b"^" + text[:n].encode() for n in BEGINNINGS if n < len(text)]
    return [zlib.crc32(x) % BUCKETS for x in (word, *begun)]


def fit(texts: list[bytes], positive: np.ndarray, prior: float, seed: int) -> np.ndarray:
    """Weights of the buckets, the bias last."""
    known: dict[bytes, list[int]] = {}
    found = []
    for text in texts:
        own: set[int] = set()
        for word in terms(text):
            if word not in known:
                known[word] = buckets(word)
            own.update(known[word])
        found.append(np.fromiter(own, np.int64, len(own)))
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
    n_p, n_u = max(positive.sum(), 1), max((~positive).sum(), 1)
    in_p = np.bincount(at, weights=positive[doc], minlength=BUCKETS)
    in_all = np.bincount(at, minlength=BUCKETS)
    s_p, s_u = (in_p + 0.5) / (n_p + 1), (in_all - in_p + 0.5) / (n_u + 1)
    apart = np.abs(s_p - s_u) / np.sqrt(s_p * (1 - s_p) / n_p + s_u * (1 - s_u) / n_u)
    use = (in_all >= SUPPORT) & (apart >= ERRORS) & (np.maximum(s_p / s_u, s_u / s_p) >= LIFT)
    at, doc = at[use[at]], doc[use[at]]
    names, col = np.unique(at, return_inverse=True)
    w, b, n = np.zeros(len(names)), np.log(prior / (1 - prior)), len(texts)
    p, u = positive / n_p, ~positive / n_u
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, STEPS + 1):
        g = np.bincount(doc, weights=w[col], minlength=n) + b
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        soft = np.logaddexp(0, g)
        negative = u @ soft - prior * (p @ soft)
        down = (u - prior * p) * s
        # d/dg of the whole risk, or the way back while the negatives' risk is below zero.
        slope = down + prior * p * (s - 1) if negative >= 0 else -down
        grad = np.append(np.bincount(col, weights=slope[doc], minlength=len(names)) + DECAY * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    out = np.zeros(BUCKETS + 1, np.float32)
    out[names], out[-1] = w, b
    return out


def sample(docs: DataFrame, labels: DataFrame, seed: int = 0) -> tuple[DataFrame, float]:
    """(positive, member, text as bytes) for training, each text for two members; and the class prior.

    Learns from rows outside the held-out fold.  The prior is the share of toxic among all labels there.
    At most POSITIVES + UNLABELLED ids leave the ordered samples, so they are broadcast; texts are then read once.
    """
    order = F.xxhash64("doc_id", F.lit(seed))

    def some(ids: DataFrame, n: int, limit: int) -> DataFrame:
        near = min(1.0, 4 * limit / max(n, 1))
        return ids.where(F.pmod(order, F.lit(1 << 20)) <= int(near * (1 << 20))).orderBy(order, "doc_id").limit(limit)

    marks = labels.where("toxic is not null").where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    n, hits = marks.agg(F.count("y"), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    ids = docs.select("doc_id").where(fold(F.col("doc_id")) != 0)
    chosen = (some(marks.where("y = 1").select("doc_id"), hits, POSITIVES).withColumn("positive", F.lit(True))
              .unionByName(some(ids, ids.count(), UNLABELLED).withColumn("positive", F.lit(False))))
    left_out = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(MEMBERS))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1)))).where(F.col("member") != left_out))
    return rows.select("positive", "member", utf8(F.col("text")).alias("text")), hits / n if n else 0.0


def train(docs: DataFrame, labels: DataFrame, seed: int = 0) -> np.ndarray:
    """Weights of the members, (BUCKETS + 1) x members.  With no or only toxic labels a bias alone: score 0 or 1."""
    ship(docs.sparkSession)
    rows, prior = sample(docs, labels, seed)
    if not 0 < prior < 1:
        flat = np.zeros((BUCKETS + 1, 1), np.float32)
        flat[-1] = 30 if prior else -30
        return flat

    def member(group: pd.DataFrame) -> pd.DataFrame:
        # A fixed order of rows makes runs agree.
        group = group.sort_values(["positive", "text"])
        weights = fit(list(group.text), group.positive.to_numpy(bool), prior, seed)
        return pd.DataFrame({"member": [int(group.member.iloc[0])], "weights": [weights.tobytes()]})

    found = sorted(rows.groupBy("member").applyInPandas(member, "member int, weights binary").collect())     # MEMBERS rows
    if not found:
        # No text to learn from: the prior alone.
        return np.append(np.zeros(BUCKETS, np.float32), np.float32(np.log(prior / (1 - prior))))[:, None]
    return np.stack([np.frombuffer(r["weights"], np.float32) for r in found], axis=1)


def scorer(weights: np.ndarray):
    """A function of a text column (as bytes) that gives the probability of being toxic."""
    used = np.flatnonzero(np.abs(weights[:-1]).sum(1))
    row = {int(b): i for i, b in enumerate(used)}
    table = weights[used].astype(float)
    bias = weights[-1].astype(float)
    known: dict[bytes, tuple[int, ...]] = {}

    def run(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            own: set[int] = set()
            for word in terms(text):
                rows = known.get(word)
                if rows is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    rows = known[word] = tuple(row[b] for b in buckets(word) if b in row)
                if rows:
                    own.update(rows)
            g = table[list(own)].sum(0) + bias
            out[i] = (1 / (1 + np.exp(-np.clip(g, -30, 30)))).mean()
        return pd.Series(out)

    return F.pandas_udf(run, DoubleType())


def toxicity(docs: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, score (0 to 1) of every row's whole text.

    Null and empty texts have no words and score by the bias alone; equal texts score alike; an empty table gives no
    rows; other columns are not read.  Without a confirmed toxic label every score is 0.
    """
    score = scorer(train(docs, labels, seed))
    return docs.select("doc_id", score(utf8(F.col("text"))).alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
