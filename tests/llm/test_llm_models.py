"""Trained scores: held-out accuracy on planted signals, exact parts against brute force, odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom import session
from graphloom.llm import language_model, quality, toxicity
from graphloom.llm.common import fold

DOCS = "doc_id long, text string, lang string, source string, score string, x string"
LABELS = "doc_id long, quality int, toxic int"


def prose(draw, n):
    return " ".join(draw.choice(["the", "of", "and"]) if draw.random() < 0.4 else f"{draw.choice('bcdfg')}{draw.randrange(400)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(2)
    docs, labels = [], []
    for i in range(700):
        toxic, bad = i % 6 == 0, i % 5 == 1
        words = prose(draw, draw.randrange(20, 200)).split()
        if toxic:
            for _ in range(4):
                words[draw.randrange(len(words))] = draw.choice(["vilest", "vilely", "GRUBBY,", "oaf"])
        text = " | ".join(words) if bad else " ".join(words) + "."
        docs.append((i, text, "en", "s", "clash", "clash"))
        if i % 4 != 3:
            labels.append((i, int(not bad), int(toxic)))
    docs += [(5000, None, None, None, None, None), (5001, "", None, None, None, None), (5002, prose(draw, 60_000), "en", "s", None, None),
             (None, "the of", "en", "s", None, None), (1, docs[1][1], "en", "s", "clash", "clash")]
    labels += [(2, None, None), (8, 1, 0), (8, 1, 0), (9999, 1, 1)]
    return docs, labels


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_toxicity(spark, corpus):
    docs, labels = spark.createDataFrame(corpus[0], DOCS), spark.createDataFrame(corpus[1], LABELS)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(corpus[0]) and all(0 <= r["score"] <= 1 for r in rows)
    own = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 700 and held_out(r["doc_id"])]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in own)
    assert len(own) > 100 and right >= 0.97 * len(own)
    odd = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] in (5000, 5001)}
    assert odd[5000] == odd[5001] < 0.5


def test_toxicity_uses_positive_and_unlabelled_risk():
    draw = random.Random(4)
    texts = [prose(draw, 40).encode() for _ in range(600)]
    toxic = np.array([i % 4 == 0 for i in range(600)])
    texts = [t + b" vile oaf" if y else t for t, y in zip(texts, toxic)]
    # A third of the toxic texts is confirmed; the others hide among the unlabelled.
    known = np.array([i % 12 == 0 for i in range(600)])
    w = toxicity.fit(texts, known, 0.2, 0)
    g = np.array([sum(w[b] for b in {b for t in toxicity.terms(x) for b in toxicity.buckets(t)}) + w[-1] for x in texts])
    assert ((g > 0) == toxic).mean() > 0.97


def test_without_labels(spark, corpus):
    docs, none = spark.createDataFrame(corpus[0][:20], DOCS), spark.createDataFrame([], LABELS)
    assert all(r["score"] < 0.01 for r in toxicity.toxicity(docs, none).collect())
    assert quality.quality_filter(docs, none).count() == 20      # 0.5 reaches the threshold
    empty = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame(corpus[1], LABELS)
    assert toxicity.toxicity(empty, some).count() == 0
    assert quality.quality_filter(empty, some).count() == 0


def test_quality(spark, corpus):
    docs, labels = spark.createDataFrame(corpus[0], DOCS), spark.createDataFrame(corpus[1], LABELS)
    kept = quality.quality_filter(docs, labels)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    own = [i for i in range(700) if held_out(i)]
    assert sum((i in ids) == (i % 5 != 1) for i in own) >= 0.97 * len(own)
    assert ids.get(1, 0) in (0, 2)


def test_isotonic_against_brute_force():
    draw = np.random.default_rng(0)
    total, hits = draw.integers(1, 5, 12).astype(float), None
    hits = np.minimum(total, draw.integers(0, 5, 12))
    got = quality.isotonic(total, hits)
    # max-min formula of isotonic regression
    mean = lambda a, b: hits[a:b + 1].sum() / total[a:b + 1].sum()
    want = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert np.allclose(got, want)


def test_statistics_of_odd_texts():
    for text in (b"", b" \n\t", b"a", "é\n".encode() * 5, b"x" * 100_000):
        assert np.isfinite(quality.statistics(text)).all()


def test_normal_equations_do_not_depend_on_partitions(spark, corpus):
    docs, labels = spark.createDataFrame(corpus[0][:400], DOCS), spark.createDataFrame(corpus[1], LABELS)
    known = docs.select("doc_id", quality.document_statistics(F.col("text")).alias("x"))
    rows = quality.labelled_rows(known, labels, "quality")
    a, b = quality.train(rows.coalesce(1)), quality.train(rows.repartition(7))
    assert np.allclose(a.beta, b.beta, atol=1e-4) and np.allclose(a.steps, b.steps, atol=0.05)


def language_rows(spark, docs, train):
    return {r["doc_id"]: r for r in language_model.language_scores(spark.createDataFrame(docs, DOCS), train).collect()}


def test_language_scores(spark, corpus, monkeypatch):
    monkeypatch.setattr(language_model, "STEPS", 6)
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 50_000)
    docs = [d for d in corpus[0][:300] if d[0] is not None] + corpus[0][-5:-3]
    got = language_rows(spark, docs, fold(F.col("doc_id")) != 1)
    count, texts = Counter(), {}
    for d in docs:
        texts[d[0]] = (d[1] or "").encode().lower().split() + [None]
        if zlib.crc32(str(d[0]).encode()) % 5 != 1:
            count.update(texts[d[0]])
    n, v = sum(count.values()), len(count)
    for i, words in texts.items():
        r = got[i]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(count[w] > 0 for w in words), n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_class_probabilities_sum_to_one():
    w = np.random.default_rng(0).normal(size=(language_model.ROWS, language_model.CLASSES)).astype(np.float32)
    codes = np.arange(0, language_model.CLASSES**3, 97)
    assert np.allclose(np.exp(language_model.log_class(w, codes)).sum(1), 1)


def test_contexts_against_brute_force():
    draw = np.random.default_rng(1)
    sizes = np.array([1, 4, 2, 7])
    kinds = draw.integers(1, language_model.CLASSES, sizes.sum())
    want, at = [], 0
    for n in sizes:
        own = [0, 0, 0, *kinds[at:at + n]]
        want += [(own[i] * language_model.CLASSES + own[i + 1]) * language_model.CLASSES + own[i + 2] for i in range(n)]
        at += n
    assert list(language_model.context(kinds, sizes)) == want


def test_language_scores_without_training_rows_or_documents(spark):
    docs = [(1, "a b", "en", "s", None, None), (2, None, "en", "s", None, None)]
    got = language_rows(spark, docs, F.lit(False))
    assert [(got[i]["n_tokens"], got[i]["n_known"], got[i]["base_score"]) for i in (1, 2)] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert all(math.isfinite(r["score"]) for r in got.values())
    assert language_rows(spark, [], F.lit(True)) == {}


def test_language_scores_know_word_order(spark, monkeypatch):
    monkeypatch.setattr(language_model, "STEPS", 2)
    # One shape, so one class: only word identities tell these texts apart.
    pairs = [("redimo", "walimo"), ("tadimo", "ponimo"), ("kasimo", "lunimo")]
    draw = random.Random(5)
    docs = [(i, " ".join(w for _ in range(20) for w in draw.choice(pairs)), "en", "s", None, None) for i in range(60)]
    docs += [(1000, "redimo walimo tadimo ponimo", "en", "s", None, None), (1001, "redimo ponimo tadimo walimo", "en", "s", None, None)]
    got = language_rows(spark, docs, F.col("doc_id") < 1000)
    assert got[1000]["base_score"] == pytest.approx(got[1001]["base_score"])
    assert got[1000]["score"] > got[1001]["score"] + 1


def test_gates_against_brute_force():
    draw = np.random.default_rng(3)
    # After history "a": half of the tokens are told by its count, none by the class model.
    x = np.full(1000, 1)
    p = np.stack([np.full(1000, 0.01), np.where(draw.random(1000) < 0.5, 0.9, 0.0), np.zeros(1000), np.zeros(1000)], axis=1)
    total = language_model.gate_counts(x, p)
    assert total.sum() == pytest.approx(1000) and total[1, 2:].sum() == 0
    assert total[1, 1] == pytest.approx((p[:, 1] > 0).sum(), rel=0.1)


def random_texts(n, seed=7):
    draw = random.Random(seed)
    texts = [" ".join(f"w{int(draw.paretovariate(0.7)) % 900}" for _ in range(draw.randrange(90))) for _ in range(n)]
    return [(i, text, "en", "s", None, None) for i, text in enumerate([None, "", "w1", "w1 w1", *texts])]


def numbered_blocks(spark, docs, pages):
    rows = spark.createDataFrame(docs, DOCS).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), (F.col("doc_id") % 5 != 1).alias("train"))
    read = language_model.read_blocks(rows, 4).cache()
    words, _ = language_model.numbered(language_model.cut_lineage(language_model.word_counts(read, 3)))
    return read, language_model.number_words(read, words, sum(d[0] % 5 != 1 for d in docs), pages)


@pytest.mark.parametrize("salted", [0.0, 0.02])
def test_history_counts_against_brute_force(spark, salted):
    docs, pages = random_texts(120), 5
    _, blocks = numbered_blocks(spark, docs, pages)
    told = [language_model.history_counts(blocks, kind, pages, salted) for kind in range(len(language_model.KINDS))]
    spread = [x for kind in told for x in [language_model.spread_histories(kind)]]
    spread = [spread[kind][kind] for kind in range(len(told))]
    assert all(len(x[0]) > 0 for x in spread) == (salted > 0)
    answers = [r.asDict() for kind in told for r in kind.where("block is not null").collect()]
    words = {d[0]: (d[1] or "").encode().split() + [None] for d in docs}
    for kind, places in enumerate(language_model.KINDS):
        count, following = Counter(), {}
        for i, own in words.items():
            for k, w in enumerate(own):
                history = tuple(own[k - back] if k >= back else None for back in places)
                if i % 5 != 1:
                    count[history, w] += 1
                    count[history] += 1
                    following.setdefault(history, set()).add(w)
        for row in (r.asDict() for r in blocks.collect()):
            tokens, among = language_model.unpack(row["tokens"]), language_model.unpack(row["words"])
            met = language_model.met_histories(tokens, among, [x for x in answers if x["block"] == row["block"]], spread, pages, salted)[kind]
            own = [(tuple(words[i][k - back] if k >= back else None for back in places), words[i][k]) for i in row["doc_id"] for k in range(len(words[i]))]
            assert list(met["often"][met["before"]]) == [count[h] for h, _ in own]
            assert list(met["various"][met["before"]]) == [len(following.get(h, ())) for h, _ in own]
            assert list(met["both"][met["at"]]) == [count[pair] for pair in own]


def test_words_are_numbered_by_frequency(spark):
    docs = random_texts(60)
    read, _ = numbered_blocks(spark, docs, 3)
    words, _ = language_model.numbered(language_model.cut_lineage(language_model.word_counts(read, 3)))
    got = [(r["number"], r["c"]) for r in words.orderBy("number").collect()]
    count = Counter(w for d in docs if d[0] % 5 != 1 for w in (d[1] or "").split())
    assert [n for n, _ in got] == list(range(language_model.SHAPES, language_model.SHAPES + len(count)))
    assert [c for _, c in got] == sorted(count.values(), reverse=True)


def test_packed_columns_come_back():
    draw = np.random.default_rng(4)
    columns = [np.sort(draw.integers(0, 1 << 63, 100).astype("<u8")), np.zeros(0, "<u4"), draw.integers(0, 255, 7).astype("u1"), np.array([1 << 31], "<u4")]
    got = language_model.unpack(language_model.pack(language_model.gaps(columns[0]), *columns[1:]))
    assert [list(x) for x in [np.cumsum(got[0], dtype=np.uint64), *got[1:]]] == [list(x) for x in columns]
    assert [len(x) for x in language_model.unpack(language_model.pack(np.zeros(0, "<u8")))] == [0]
    for top in (50, 1 << 62):
        x = draw.integers(0, top, 1000)
        assert all((a == b).all() for a, b in zip(language_model.distinct(x), np.unique(x, return_inverse=True)))


def test_language_scores_leave_little_on_disk(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(language_model, "STEPS", 2)
    docs = random_texts(1500)
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    got = language_rows(spark, docs, F.col("doc_id") % 5 != 1)
    tokens = sum(r["n_tokens"] for r in got.values())
    # What stays while the scores are read: numbers of words and counts of histories, not a row for each key or token.
    assert sum(x.stat().st_size for x in tmp_path.rglob("*.parquet")) < 8 * tokens
