"""Cases that earlier versions answered wrongly."""

import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions import numeric as n
from graphloom.operators import aggregates as a
from graphloom.operators import joins as j
from graphloom.operators import predicates as pr
from graphloom.operators import updates as up
from graphloom.operators.construct import construct
from graphloom.plans.bgp import star
from graphloom.plans.path_search import path_search
from graphloom.sources import store as store_module
from graphloom.sources.ntriples import parse_lines
from graphloom.sources.quadstore import QuadStore


@pytest.mark.parametrize("as_name", [True, False])
def test_distinct_aggregates(spark, as_name):
    data = spark.createDataFrame([("signs", -1), ("signs", 1), ("signs", 1), ("big", 10**9 + 1), ("big", 10**9 + 2), ("big", 10**9 + 3),
                                  ("over", 2**63 - 1), ("over", 1), ("one", 5), ("one", 5)], "k string, v long")
    v = "v" if as_name else F.col("v") + 0
    got = {r["k"]: r for r in a.group_by(data, ["k"], s=a.total(v, True), m=a.mean(v, True), d=a.stdev(v, True)).collect()}
    assert got["signs"]["d"] == pytest.approx(math.sqrt(2)) and got["signs"]["s"] == 0 and got["signs"]["m"] == 0
    assert got["big"]["d"] == pytest.approx(1.0) and got["big"]["m"] == pytest.approx(10**9 + 2)
    assert got["over"]["s"] is None and got["over"]["m"] == pytest.approx(2.0**62)
    assert (got["one"]["s"], got["one"]["m"], got["one"]["d"]) == (5, 5.0, 0.0)
    none = a.group_by(data.where("false"), [], s=a.total(v, True), m=a.mean(v, True), d=a.stdev(v, True)).first()
    assert (none["s"], none["m"], none["d"]) == (0, 0.0, 0.0)


def test_lowest_integer(spark):
    data = spark.createDataFrame([(-2**63, -1.5), (7, 0.0), (None, float("nan"))], "x long, y double")
    got = data.select(n.negate("x").alias("n"), n.absolute("x").alias("a"), n.negate("y").alias("ny"), n.absolute("y").alias("ay")).collect()
    assert [(r["n"], r["a"]) for r in got] == [(None, None), (-7, 7), (None, None)]
    assert got[0]["ny"] == got[0]["ay"] == 1.5 and math.isnan(got[2]["ay"])


def test_control_character_in_literal(spark):
    lines = spark.createDataFrame([('<a> <p> "x\x01y"@en <g> .',), ('<a> <p> "x\x01y .',), ('<a> <p> <b> .',)], "value string")
    quads, rejects = parse_lines(lines)
    assert sorted(r["o"] for r in quads.collect()) == ['"x\x01y"@en', "<b>"]
    assert rejects.count() == 1


def test_star_with_several_values(spark):
    quads = up.quads_of(spark, [("<a>", "<p>", '"1"'), ("<a>", "<p>", '"2"'), ("<a>", "<q>", "<x>"), ("<b>", "<p>", '"3"')])
    got = star(quads, "?s", {"<p>": ("?v", None), "<q>": ("?w", None)})
    assert rows(got, "s", "v", "w") == [("<a>", '"1"', "<x>"), ("<a>", '"2"', "<x>")]


def test_blank_nodes_of_equal_rows(spark):
    data = spark.createDataFrame([("<a>",), ("<a>",), ("<b>",)], "x string")
    made = construct(data, [("_:n", "<p>", "?x"), ("_:n", "<q>", "?x")])
    assert made.count() == 6 and made.select("s").distinct().count() == 3


def test_neutral_optional(spark):
    left = spark.range(3).select(F.col("id").alias("x"))
    assert j.neutral_optional(left, spark.range(2).select(F.col("id").alias("y"))).count() == 6
    alone = j.neutral_optional(left, spark.createDataFrame([], "y long"))
    assert rows(alone) == [(0, None), (1, None), (2, None)]


def test_counts_of_wanted_predicates_only(spark):
    quads = up.quads_of(spark, [("<a>", "<p>", "<x>"), ("<b>", "<p>", "<x>"), ("<a>", "<q>", "<x>")])
    assert pr.predicate_counts(quads, [("?s", "<p>", "?o"), ("?s", "?any", "?o"), ("?s", "<none>", "?o")]) == {"<p>": 2, "<none>": 0}


def test_within_dist_at_date_line_and_poles(spark):
    from graphloom.operators import spatial as sp

    a = spark.createDataFrame([(1, "POINT(179.999 0)"), (2, "POINT(0 89.99)"), (3, "POINT(10 10)"), (4, "POINT(-179.999 -89.999)")], "a long, a_wkt string")
    b = spark.createDataFrame([(1, "POINT(-179.999 0)"), (2, "POINT(50 89.99)"), (3, "POINT(10.001 10)"), (4, "POINT(90 -89.999)"),
                               (5, "LINESTRING(-179.999 0.001,-179.99 0.5)"), (6, "no geometry")], "b long, b_wkt string")
    got = sp.spatial_join(a, b, "within-dist", "a", "a_wkt", "b", "b_wkt", metres=1000)
    assert rows(got) == [(1, 1), (1, 5), (2, 2), (3, 3), (4, 4)]


def test_many_updates_and_compaction_between_batches(spark, tmp_path):
    from graphloom.sources.quadstore import QuadStore

    store = QuadStore(spark, str(tmp_path / "s")).create(up.quads_of(spark, [("<a>", "<p>", "<b>")]))
    change = lambda op, o, seq=0: spark.createDataFrame([(op, "<a>", "<p>", o, up.DEFAULT_GRAPH, seq)], "op string, s string, p string, o string, g string, seq long")
    quad = lambda o: up.quads_of(spark, [("<a>", "<p>", o)])
    for _ in range(3):
        store.update(inserts=quad("<x>"))
        store.update(deletes=quad("<x>"))
    assert store.changes().agg(F.max("seq")).first()[0] <= 1
    # A feed change after an update wins, whatever its own number.
    store.log(change("insert", "<x>", 0), "f0")
    assert rows(store.current(), "o") == [("<b>",), ("<x>",)]

    held = store._publish
    store._publish = lambda n: (store.log(change("insert", "<y>"), "f1"), held(n))
    assert store.compact() == 1
    store._publish = held
    assert rows(store.current(), "o") == [("<b>",), ("<x>",), ("<y>",)]
    store.update(deletes=quad("<x>"))
    store.log(change("insert", "<x>", 0), "f0")     # repeated after the compaction: the base holds it already
    assert rows(store.current("<p>"), "o") == [("<b>",), ("<y>",)] and store.current("<q>").count() == 0
    plan = store.current("<p>")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*p_bucket", plan)


def test_tags_types_and_ranges_from_columns(spark):
    from graphloom.functions import strings as st
    from graphloom.functions.terms import XSD, parse_term

    data = spark.createDataFrame([('"5"', "EN", XSD + "int", "en"), ('"x"', "", XSD + "int", "*"), ('"1.5"', None, XSD + "float", "fr"),
                                  ('"true"', "de-CH", XSD + "boolean", "de"), ('"q"@en', "fr", None, "e")],
                                 "t string, tag string, dt string, range string")
    t = parse_term("t")
    got = data.select(st.str_lang(t, F.col("tag")).alias("l"), st.str_dt(t, F.col("dt")).alias("d"),
                      st.lang_matches(F.col("tag"), F.col("range")).alias("m")).collect()
    assert [r["l"] and r["l"]["lang"] for r in got] == ["en", None, None, "de-ch", None]
    same = [data.select(st.str_dt(t, d).alias("d")).collect()[i]["d"] for i, d in enumerate([XSD + "int", XSD + "int", XSD + "float", XSD + "boolean"])]
    assert [r["d"] for r in got] == [*same, None]
    assert [r["m"] for r in got] == [True, False, None, True, False]


def test_copies_are_written_in_bounded_tasks(spark, tmp_path, monkeypatch):
    """A task sorts a bounded share of a copy, however many partitions shuffles have; the copies are a set."""
    monkeypatch.setattr(store_module, "TASK_BYTES", 1000)
    quads = spark.range(400).selectExpr("concat('<s', id % 100, '>') s", "'<p>' p", "concat('<o', id % 7, '>') o", "'<g>' g")
    path = str(tmp_path / "copies")
    store_module.write_clustered(quads, path)
    wanted = sorted({(f"<s{n % 100}>", "<p>", f"<o{n % 7}>", "<g>") for n in range(400)})
    for copy in "pso":
        stored = spark.read.parquet(f"{path}/by_{copy}")
        assert rows(stored, "s", "p", "o", "g") == wanted
        assert len(stored.inputFiles()) > 4
    assert rows(store_module.StoredGraph(spark, path, {"p": 512}).quads().select("o_term.lex")) == sorted((o[1:-1],) for _, _, o, _ in wanted)


def test_quads_about_subjects(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "q")).create(up.quads_of(spark, [("<a>", "<p>", '"x"'), ("<a>", "<q>", '"y"'), ("<b>", "<p>", '"x"')]))
    store.update(inserts=up.quads_of(spark, [("<a>", "<r>", '"z"'), ("<c>", "<p>", '"x"')]), deletes=up.quads_of(spark, [("<a>", "<q>", '"y"'), ("<b>", "<p>", '"x"')]))
    asked = spark.createDataFrame([("<a>",), ("<b>",), ("<a>",), (None,)], "s string")
    assert rows(store.graph().about(asked)) == [("<a>", "<p>"), ("<a>", "<r>")]


def test_path_search_computes_edges_and_pairs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(row):
        seen.add(1)
        return row

    made = lambda data, ddl: spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(told), ddl, verifySchema=False)
    edges, pairs = made([(n, n + 1) for n in range(6)], "start int, end int"), made([(0, 3), (2, 6)], "a int, b int")
    found = path_search(edges, pairs=pairs)
    assert rows(found, "source", "target", "edge") == sorted([(0, 3, n) for n in range(3)] + [(2, 6, n) for n in range(4)])
    assert seen.value == 8
