"""Near duplicates of texts and vectors, and connected components, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from graphloom.llm import minhash, pivots
from graphloom.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, component_id string, n long"


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)]
    edges += [(1000, 2000 + i) for i in range(50)] + [(5, 5)]
    df = spark.createDataFrame([*edges, (None, 4), (7, None)], "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = union_find({x for e in edges for x in e}, edges)
    assert {n: c for n, c in want.items() if n in got} == got
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_sets(texts, width):
    out = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        out[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if words else set()
    return out


def brute(texts, width, percent):
    sets = shingle_sets(texts, width)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, union_find(sets, links)


@pytest.fixture(scope="module")
def near_texts():
    draw = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(500)]
    bases = [[draw.choice(vocabulary) for _ in range(draw.choice([2, 30, 120, 900]))] for _ in range(25)]
    texts = {}
    for base in bases:
        for _ in range(draw.randrange(1, 12)):
            words = list(base)
            # Few to many edits: similarities on both sides of the threshold.
            for _ in range(draw.randrange(0, max(2, len(words) // 40))):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts[len(texts)] = " ".join(words).upper() if draw.random() < 0.2 else "\n".join(words)
    chain = [draw.choice(vocabulary) for _ in range(200)]
    for _ in range(30):
        # A chain: neighbours are alike, the ends are not.
        at = draw.randrange(200)
        chain[at:at + 2] = [draw.choice(vocabulary), draw.choice(vocabulary)]
        texts[len(texts)] = " ".join(chain)
    texts |= {1000: None, 1001: "", 1002: " \t\n", 1003: "one", 1004: "ONE", 1005: "one two"}
    return texts


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, near_texts, width, percent):
    rows = [(i, t, "en", None, "clash", 0) for i, t in near_texts.items()]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS), width, percent).collect()}
    sets, want = brute(near_texts, width, percent)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_mixed_bucket_blocks(spark, near_texts, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "SET_BLOCK", 2)
    rows = [(i, t, "en", None, "clash", 0) for i, t in near_texts.items()]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS), 3, 85).collect()}
    assert got == brute(near_texts, 3, 85)[1]


def test_drop_near_duplicates_keeps_columns_and_ids_less_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "a", "x", 1), (2, text + " end", "en", "b", "y", 2), (3, None, None, None, None, None),
            (None, text, "en", "a", "x", 1), (4, text, "en", "a", "x", 1), (4, text, "en", "a", "x", 1)]
    kept = minhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "component_id", "n"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None]


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.drop_near_duplicates(empty).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, n_links string, raw string"


def brute_vectors(rows, least=0.98):
    units = {}
    for i, v, label in rows:
        if v and label is not None and None not in v:
            x = np.array(v, np.float32).astype(float)
            if np.isfinite(x).all() and x.any():
                units[i] = (label, x / np.linalg.norm(x))
    links = [(a, b) for a in units for b in units if a != b and units[a][0] == units[b][0]
             and len(units[a][1]) == len(units[b][1]) and float(units[a][1] @ units[b][1]) >= least]
    return Counter(a for a, _ in links), union_find([r[0] for r in rows], links)


@pytest.mark.parametrize("block", [512, 4])
def test_linked_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    draw = np.random.default_rng(1)
    rows = []
    for _ in range(40):
        base = draw.normal(size=16)
        for _ in range(draw.integers(1, 8)):
            v = (base + draw.normal(size=16) * draw.choice([0, 0.05, 0.3])).astype(np.float32)
            rows.append((len(rows), [float(x) for x in v * draw.choice([1, 1, 7])], int(draw.integers(0, 2))))
    crowd = draw.normal(size=16).astype(np.float32)
    rows += [(len(rows) + i, [float(x) for x in crowd + draw.normal(size=16) * 0.02], 1) for i in range(40)]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(n + 20, rows[0][1], None), (n + 21, rows[0][1], rows[0][2])]
    rows += [(n + 22, [-0.0, 1.0], 1), (n + 23, [0.0, 1.0], 1)]
    got = {r["vec_id"]: r for r in pivots.linked_vectors(
        spark.createDataFrame([(*r, "clash", "clash") for r in rows], VECTORS)).collect()}
    links, want = brute_vectors(rows)
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.9 * sum(links.values()) > 0
    assert all(got[i]["n_links"] <= links[i] for i in got)
    assert got[n + 21]["component_id"] == 0 and got[n + 23]["component_id"] == n + 22 and got[n + 7]["component_id"] == n + 6
    if found == sum(links.values()):
        assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_no_vectors(spark):
    assert pivots.linked_vectors(spark.createDataFrame([], VECTORS)).count() == 0
