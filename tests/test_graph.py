"""Paths, path search, patterns, CONSTRUCT and DESCRIBE on small graphs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions.terms import QUADS_DDL
from graphloom.operators import predicates as pr, updates as up
from graphloom.operators.construct import construct
from graphloom.operators.scan import from_graphs, pattern
from graphloom.plans import property_paths as pp
from graphloom.plans.bgp import bgp, join_order, star
from graphloom.plans.describe import describe
from graphloom.plans.path_search import path_search
from graphloom.plans.skew import lookup_join, packed_join
from graphloom.plans.transitive import reach


def frame(spark, edges):
    return spark.createDataFrame(edges, "start string, end string")


def walks(edges, low, high):
    """Pairs with a walk length in [low, high]; lengths beyond the number of pairs repeat."""
    nodes = {x for e in edges for x in e}
    reached, level = set(), set((x, x) for x in nodes)
    for length in range(0, (high if high is not None else len(nodes) ** 2) + 1):
        if length >= low:
            reached |= level
        level = {(a, d) for a, b in level for c, d in edges if b == c}
    return sorted(reached)


@pytest.mark.parametrize("seed", [1])
@pytest.mark.parametrize("low, high", [(1, None), (0, None), (2, 3), (3, None), (0, 1)])
def test_reach_random(spark, seed, low, high):
    rng = random.Random(seed)
    edges = sorted({(f"n{rng.randrange(7)}", f"n{rng.randrange(7)}") for _ in range(9)})
    df = frame(spark, edges)
    nodes = df.select(F.explode(F.array("start", "end")).alias("node")).distinct()
    assert rows(reach(df, low, high, nodes=nodes), "start", "end") == walks(edges, low, high)


def test_reach_bound_sides(spark):
    df = frame(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c")])
    one = lambda name, v: spark.createDataFrame([(v,)], f"{name} string")
    assert rows(reach(df, seeds=one("start", "d"))) == [("d", "a"), ("d", "b"), ("d", "c")]
    assert rows(reach(df, targets=one("end", "a")), "start", "end") == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a")]
    nodes = df.select(F.explode(F.array("start", "end")).alias("node")).distinct()
    # A bound value that is no node of the graph does not reach itself.
    assert rows(reach(df, 0, None, seeds=one("start", "zz"), nodes=nodes)) == []
    with pytest.raises(ValueError):
        reach(df, 2, 1)
    with pytest.raises(ValueError):
        reach(df, 0, 1)


LINE = [("0", "1"), ("1", "2"), ("2", "3"), ("3", "4")]


def brute_paths(edges, sources=None, targets=None, depth=99):
    out = []

    def go(path, seen):
        for e in edges:
            if e[0] == path[-1][1] and e[1] not in seen and len(path) < depth:
                go(path + [e], seen | {e[1]})
        if targets is None or path[-1][1] in targets:
            out.append(tuple(path))

    for e in edges:
        if (sources is None or e[0] in sources) and e[0] != e[1] and depth > 0:
            go([e], {e[0], e[1]})
    return sorted(out)


def found_paths(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["path"], []).append((r["edge"], r["start"], r["end"]))
    return sorted(tuple((s, e) for _, s, e in sorted(p)) for p in got.values())


def nodes(spark, *names):
    return spark.createDataFrame([(x,) for x in names], "n string")


def test_path_line(spark):
    got = path_search(frame(spark, LINE), nodes(spark, "0"), nodes(spark, "4"))
    assert rows(got, "edge", "start", "end") == [(i, str(i), str(i + 1)) for i in range(4)]
    assert got.select("path").distinct().count() == 1


@pytest.mark.parametrize("edges", [
    [("0", "1"), ("1", "2"), ("2", "0"), ("2", "3")],
    [("0", "1"), ("1", "3"), ("0", "2"), ("2", "3"), ("3", "4"), ("4", "6"), ("3", "5"), ("5", "6")],
    [("0", "0"), ("0", "1"), ("1", "0"), ("1", "1")],
], ids=["cycle", "diamond", "loops"])
@pytest.mark.parametrize("depth", [None, 0, 2])
def test_paths_brute_force(spark, edges, depth):
    limit = 99 if depth is None else depth
    df = frame(spark, edges)
    assert found_paths(path_search(df, max_depth=depth)) == brute_paths(edges, depth=limit)
    last = edges[-1][1]
    got = path_search(df, nodes(spark, "0"), nodes(spark, last), max_depth=depth)
    assert found_paths(got) == brute_paths(edges, {"0"}, {last}, limit)


def test_paths_parallel_edges_and_properties(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("a", "b", 2), ("b", "c", 3)], "start string, end string, w int")
    got = path_search(edges, nodes(spark, "a"), nodes(spark, "c"), edge_properties=["w"])
    assert got.select("path").distinct().count() == 3
    assert rows(got.where("edge = 0"), "w") == [(1,), (2,), (2,)]


def test_paths_limit_and_pairs(spark):
    edges = [("s", "a"), ("s", "b"), ("a", "t"), ("b", "t"), ("s", "t"), ("x", "y")]
    df = frame(spark, edges)
    best = path_search(df, nodes(spark, "s"), nodes(spark, "t"), paths_per_target=2)
    assert sorted(len(p) for p in found_paths(best)) == [1, 2]
    pairs = spark.createDataFrame([("s", "a"), ("x", "y"), ("x", "t")], "a string, b string")
    assert found_paths(path_search(df, pairs=pairs)) == [(("s", "a"),), (("x", "y"),)]
    with pytest.raises(ValueError):
        path_search(df, max_depth=-1)


def kb(spark):
    data = [("<a>", "<knows>", "<b>"), ("<b>", "<knows>", "<c>"), ("<a>", "<name>", '"A"'), ("<b>", "<name>", '"B"@en'),
            ("<a>", "<knows>", "<a>"), ("<c>", "<likes>", "<a>", "<g1>"), ("<a>", "<knows>", "<b>", "<g1>")]
    return up.quads_of(spark, data)


def test_patterns(spark):
    q = kb(spark)
    assert rows(pattern(q, "?x", "<knows>", "?x")) == [("<a>",)]
    assert rows(pattern(q, "?s", "?p", "?o", g="?g"), "s", "g") == [("<a>", "<g1>"), ("<c>", "<g1>")]
    assert pattern(q, "<a>", "<knows>", "<b>").count() == 2
    assert rows(pattern(q, "?s", "<name>", "?n", as_type="lang")) == [("<a>", None), ("<b>", "en")]
    merged = from_graphs(q, ["<g1>", "<urn:graph:default>"])
    assert pattern(merged, "<a>", "<knows>", "<b>").count() == 1
    friends = bgp(q.where("g like '%default%'"), [("?x", "<knows>", "?y"), ("?y", "<knows>", "?z")])
    assert rows(friends, "x", "y", "z") == [("<a>", "<a>", "<a>"), ("<a>", "<a>", "<b>"), ("<a>", "<b>", "<c>")]
    assert rows(star(q, "?s", {"<name>": ("?n", "string"), "<likes>": ("?l", None)})) == []


def test_join_order_stays_connected():
    order = join_order([("?a", "<p>", "?b"), ("?c", "<q>", "?d"), ("?b", "<r>", "?c")], {"<p>": 10, "<q>": 1, "<r>": 5})
    assert [t[1] for t in order] == ["<q>", "<r>", "<p>"]


def test_property_paths(spark):
    q = kb(spark).where("g like '%default%'")
    knows, name = pp.Step("<knows>"), pp.Step("<name>")
    assert rows(pp.edges(q, knows / name)) == [("<a>", '"A"'), ("<a>", '"B"@en')]
    assert rows(pp.edges(q, ~knows), "start", "end") == [("<a>", "<a>"), ("<b>", "<a>"), ("<c>", "<b>")]
    assert rows(pp.edges(q, knows | name)) == sorted(rows(pp.edges(q, knows)) + rows(pp.edges(q, name)))
    assert rows(pp.edges(q, pp.Negated(("<name>",)))) == rows(pp.edges(q, knows))
    assert rows(pp.edges(q, pp.Negated((), ("<name>",)))) == rows(pp.edges(q, ~knows))
    assert rows(pp.edges(q, knows.plus(), start="<b>")) == [("<b>", "<c>")]
    assert rows(pp.edges(q, knows.star(), end="<c>"), "start", "end") == [("<a>", "<c>"), ("<b>", "<c>"), ("<c>", "<c>")]
    with pytest.raises(ValueError):
        knows.repeat(3, 1)


def test_paths_stay_in_one_graph(spark):
    q = up.quads_of(spark, [("<a>", "<p>", "<b>", "<g1>"), ("<b>", "<p>", "<c>", "<g2>"), ("<c>", "<p>", '"x y"', "<g2>")])
    got = pp.edges(q, pp.Step("<p>").plus(), g="?g")
    assert rows(got, "start", "end", "g") == [("<a>", "<b>", "<g1>"), ("<b>", '"x y"', "<g2>"), ("<b>", "<c>", "<g2>"), ("<c>", '"x y"', "<g2>")]


def test_construct_and_describe(spark):
    df = spark.createDataFrame([("<a>", '"1"'), ("<a>", '"1"'), ('"lit"', None)], "x string, v string")
    assert rows(construct(df, [("?x", "<p>", "?v")])) == [("<a>", "<p>", '"1"')] * 2
    assert rows(construct(df, [("?x", "<p>", "?v")], distinct=True)) == [("<a>", "<p>", '"1"')]
    keyed = df.withColumn("k", F.monotonically_increasing_id())
    made = construct(keyed, [("_:n", "<p>", "?x"), ("_:n", "<q>", "<c>")], row_key=["k"])
    assert made.select("s").distinct().count() == 3 and made.count() == 6
    quads = up.quads_of(spark, [("<a>", "<p>", "_:1"), ("_:1", "<p>", "_:2"), ("_:2", "<p>", "_:1"), ("<z>", "<p>", "_:9")])
    got = describe(quads, spark.createDataFrame([("<a>",)], "node string"))
    assert rows(got) == [("<a>", "<p>", "_:1"), ("_:1", "<p>", "_:2"), ("_:2", "<p>", "_:1")]


def test_predicate_counts(spark):
    q = kb(spark)
    assert rows(pr.available_predicates(q, spark.createDataFrame([("<a>",), ("<b>",)], "s string"))) == [("<knows>", 2), ("<name>", 2)]
    assert rows(pr.available_from_patterns(pr.subject_patterns(q))) == rows(pr.available_predicates(q))
    stats = pr.dataset_statistics(q).first()
    assert (stats.n_triples, stats.n_subjects, stats.n_graphs, stats.n_literal_objects) == (7, 3, 1, 2)


def test_lookup_join_with_hot_key(spark):
    data = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("k"), "id")
    sizes = data.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(data, sizes, "k", F.col("n"), share=10)
    assert joined.count() == 3000 and joined.where("k = 0").first()["n"] == 1000


def test_plans_read_only_what_they_need(spark):
    from catalog.registry import graph

    plan = bgp(graph(spark, "/root/testdata/sf0.001", "orders", "customer"), [
        ("?o", "<orders/custkey>", "?c"), ("?o", "<orders/totalprice>", "?p", "double")]).where("p > 100000")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" not in text and "c_name" not in text and "GreaterThan(o_totalprice" in text


def test_mapped_rows_are_one_scan(spark):
    from catalog.registry import graph

    g = graph(spark, "/root/testdata/sf0.001", "orders", "customer")
    triples = [("?o", "<orders/custkey>", "?c"), ("?o", "<orders/totalprice>", "?p", "double"),
               ("?c", "<customer/nationkey>", "<nation/7>"), ("?c", "<customer/mktsegment>", '"BUILDING"')]
    mapped = bgp(g, triples)
    text = mapped._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2 and "EqualTo(c_nationkey,7)" in text and "EqualTo(c_mktsegment" in text
    assert rows(mapped, "o", "c", "p") == rows(bgp(g.quads(), triples), "o", "c", "p")
    for s, p, o in [("<customer/7>", "<customer/name>", "?n"), ("?c", "<customer/custkey>", f'"7"^^<http://www.w3.org/2001/XMLSchema#integer>'),
                    ("<customer/07>", "<customer/name>", "?n"), ("?c", "<customer/nationkey>", "<region/7>"), ("?c", "<customer/name>", "<x>")]:
        assert rows(pattern(g, s, p, o)) == rows(pattern(g.quads(), s, p, o))


def test_sequence_through_one_hub_uses_many_tasks(spark):
    """Edges of very many subjects to one object, there and back: no task forms the whole product."""
    def point_to(p):
        return spark.range(3000).select(F.concat(F.lit(f"<{p}"), "id", F.lit(">")).alias("s"), F.lit(f"<{p}>").alias("p"), F.lit("<hub>").alias("o"))

    quads = up.with_terms(point_to("a").union(point_to("b")).withColumn("g", F.lit("")))
    got = pp.edges(quads, pp.sequence("<a>", ~pp.Step("<b>")))
    assert got.columns == ["start", "end"]
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert sum(tasks) == 9_000_000 and max(tasks) < 7_000_000


def _copies(df):
    """Rows that all shuffles of an executed plan wrote, by its final plan."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(n)) for n in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_sequence_moves_few_copies_of_its_edges(spark):
    """One hub with many more edges on one side: the edges that are shuffled stay few beside the product."""
    def point_to(p, n):
        return spark.range(n).select(F.concat(F.lit(f"<{p}"), "id", F.lit(">")).alias("s"), F.lit(f"<{p}>").alias("p"), F.lit("<hub>").alias("o"))

    quads = up.with_terms(point_to("a", 9000).union(point_to("b", 90000)).withColumn("g", F.lit("")))
    for ends, left, right in (("ab", 9000, 90000), ("ba", 90000, 9000)):
        got = pp.edges(quads, pp.sequence(f"<{ends[0]}>", ~pp.Step(f"<{ends[1]}>"))).agg(F.count("end").alias("n"))
        assert got.collect()[0]["n"] == left * right
        assert _copies(got) < left * right / 700


def test_packed_join_keeps_every_pair(spark):
    """Parts, arrays and copies: equal rows, unbound values, keys on one side only and sides without further columns."""
    a = [(k, i % 7 or None) for k, n in ((1, 40), (2, 1), (3, 25), (4, 3), (None, 5)) for i in range(n)]
    b = [(k, i % 5 or None) for k, n in ((1, 30), (2, 33), (3, 1), (5, 3), (None, 5)) for i in range(n)]
    left, right = spark.createDataFrame(a, "x int, l int"), spark.createDataFrame(b, "x bigint, r int")
    want = sorted(((k, l, r) for k, l in a for m, r in b if k is not None and k == m), key=repr)
    for chunk in (1, 3, 10, 1000):
        got = packed_join(left, right, ["x"], chunk)
        assert got.columns == ["x", "l", "r"] and rows(got) == want
    keys = packed_join(left, right.select("x"), ["x"], 3)
    assert keys.columns == ["x", "l"] and rows(keys) == sorted(((k, l) for k, l, _ in want), key=repr)
    assert rows(packed_join(left.withColumn("y", F.col("l")), right.withColumn("y", F.col("r")), ["x", "y"], 2)) == sorted(
        ((k, l, l, r) for k, l, r in want if l is not None and l == r), key=repr)
