"""Closures by doubling and path searches that stop, against plain versions."""

import random

import pytest

from conftest import rows
from graphloom.plans import path_search as ps, transitive
from graphloom.plans.path_search import path_search
from graphloom.plans.transitive import reach


def frame(spark, edges):
    return spark.createDataFrame(edges, "start string, end string")


def closure(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    out = set()
    for a in after:
        seen, todo = set(), list(after[a])
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += after.get(b, ())
        out |= {(a, b) for b in seen}
    return sorted(out)


@pytest.mark.parametrize("n, edges", [(30, 34)])
def test_closure_of_random_graphs(spark, n, edges):
    draw = random.Random(edges)
    made = [(f"n{draw.randrange(n)}", f"n{draw.randrange(n)}") for _ in range(edges)]
    assert rows(reach(frame(spark, made + made[:3]))) == closure(made)
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(n)], "node string")
    assert rows(reach(frame(spark, made), 0, nodes=nodes)) == sorted(set(closure(made)) | {(f"n{i}", f"n{i}") for i in range(n)})


@pytest.mark.parametrize("kind", ["cycle", "dense with a tail"])
def test_rounds_grow_with_the_logarithm(spark, kind, monkeypatch):
    n = 60
    chain = [(f"n{i}", f"n{i + 1}") for i in range(n)]
    made = {"chain": chain, "cycle": chain + [(f"n{n}", "n0")],
            "dense with a tail": chain + [(f"d{i}", f"d{j}") for i in range(12) for j in range(12)] + [("d0", "n0")]}[kind]
    kept = []

    class Counted(transitive.Rounds):
        def __init__(self, spark, name):
            super().__init__(spark, name)
            kept.append(self)

    monkeypatch.setattr(transitive, "Rounds", Counted)
    got = reach(frame(spark, made))
    assert got.count() == len(closure(made)) and rows(got) == closure(made)
    # 60 edges have six binary digits; a round more finds nothing.
    assert max(len(r.paths) for r in kept) <= 8


def simple_paths(edges, source, target):
    after = {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
    out, todo = [], [[source]]
    while todo:
        path = todo.pop()
        for b in after.get(path[-1], ()):
            if b not in path:
                todo.append([*path, b])
                if b == target:
                    out.append(tuple(todo[-1]))
    return out


def as_paths(df):
    """Paths of a result as tuples of nodes, by source and target."""
    held = {}
    for r in df.collect():
        held.setdefault((r["source"], r["target"], r["path"]), {})[r["edge"]] = (r["start"], r["end"])
    out = {}
    for (a, b, _), edges in held.items():
        assert sorted(edges) == list(range(len(edges)))
        out.setdefault((a, b), []).append(tuple([edges[0][0], *[edges[i][1] for i in range(len(edges))]]))
    return out


@pytest.mark.parametrize("seed", [1])
def test_the_shortest_paths_of_each_pair(spark, seed):
    draw = random.Random(seed)
    names = [f"n{i}" for i in range(7)]
    made = sorted({(draw.choice(names), draw.choice(names)) for _ in range(16)})
    sources = spark.createDataFrame([(x,) for x in names[:3]], "node string")
    targets = spark.createDataFrame([(x,) for x in names[2:6]], "node string")
    for k, ends, wanted in ((2, targets, names[2:6]), (1, None, names)):
        got = as_paths(path_search(frame(spark, made), sources, ends, paths_per_target=k))
        want = {(a, b): simple_paths(made, a, b) for a in names[:3] for b in wanted if a != b}
        assert {p: sorted(map(len, x)) for p, x in got.items()} == {p: sorted(map(len, x))[:k] for p, x in want.items() if x}
        assert all(set(x) <= set(want[p]) for p, x in got.items())


@pytest.mark.parametrize("seed", [2])
def test_paths_of_given_pairs(spark, seed):
    draw = random.Random(10 + seed)
    names = [f"n{i}" for i in range(7)]
    made = sorted({(draw.choice(names), draw.choice(names)) for _ in range(15)})
    asked = sorted({(draw.choice(names), draw.choice(names)) for _ in range(6)}) + [("n0", "absent")]
    pairs = spark.createDataFrame(asked + asked[:1], "a string, b string")
    for depth in (None, 2):
        got = as_paths(path_search(frame(spark, made), pairs=pairs, max_depth=depth))
        want = {(a, b): [p for p in simple_paths(made, a, b) if depth is None or len(p) <= depth + 1] for a, b in asked if a != b}
        assert {p: sorted(x) for p, x in got.items()} == {p: sorted(x) for p, x in want.items() if x}


def test_finished_pairs_leave_the_search(spark, monkeypatch):
    # Twelve nodes with all edges have some 10^9 simple paths; one for each pair needs a single level.
    names = [f"n{i}" for i in range(12)]
    made = [(a, b) for a in names for b in names if a != b]
    levels = []
    longer = ps._longer
    monkeypatch.setattr(ps, "_longer", lambda *x: levels.append(1) or longer(*x))
    got = path_search(frame(spark, made), paths_per_target=1)
    assert got.count() == len(made) and not levels
