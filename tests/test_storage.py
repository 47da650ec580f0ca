"""Readers, updates, the quad store, the change feed and views."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.operators import updates as up, views
from graphloom.operators.scan import pattern
from graphloom.sources import ntriples as nt, sinks
from graphloom.sources.quadstore import QuadStore
from graphloom.sources.store import read_quads, write_quads
from graphloom.streaming.feed import start_feed

NQ = r'''# comment
<http://e/s1> <http://e/p1> <http://e/o1> <http://e/g1> .
<http://e/s1> <http://e/p2> "hello" <http://e/g2> .
<http://e/s1> <http://e/p3> "22.3"^^<http://www.w3.org/2001/XMLSchema#float> <http://e/g3> .
<http://e/s1> <http://e/p5> _:o5 .

<http://e/s1> <http://e/p5> _:o5 . # again
<http://e/s1><http://e/p6>"a \"quoted\" . dot\n"@en.
<< <a> <b> <c> >> <http://e/p> "x" .
"literal" <http://e/p> <http://e/o> .
<http://e/s> <http://e/p> "open .
<http://e/s> <http://e/p> "a" "b" .
'''


@pytest.fixture(scope="module")
def nq(tmp_path_factory):
    path = tmp_path_factory.mktemp("nq") / "test.nq"
    path.write_text(NQ)
    return str(path)


def test_reader(spark, nq):
    quads, rejects = nt.read_quads_text(spark, nt.Input(nq, default_graph="<d>", blank_prefix="f1_"))
    got = rows(quads, "p", "o", "g")
    assert got == [
        ("<http://e/p1>", "<http://e/o1>", "<http://e/g1>"), ("<http://e/p2>", '"hello"', "<http://e/g2>"),
        ("<http://e/p3>", '"22.3"^^<http://www.w3.org/2001/XMLSchema#double>', "<http://e/g3>"),
        ("<http://e/p5>", "_:f1_o5", "<d>"), ("<http://e/p6>", '"a \\"quoted\\" . dot\\n"@en', "<d>")]
    assert quads.where("p like '%p3>'").first()["o_term"].d == 22.3
    assert quads.where("p like '%p6>'").first()["o_term"].lex == 'a "quoted" . dot\n'
    assert sorted(r.reason for r in rejects.collect()) == [
        "RDF* is not supported", "not a valid literal", "not a valid statement", "not a valid statement"]


def test_load(spark, nq, tmp_path):
    good = tmp_path / "good.nt"
    good.write_text("<a> <b> <c> .\n<a> <b> <c> <other> .\n")
    assert rows(nt.load_document(spark, str(good), "<g>"), "s", "p", "o", "g") == [("<a>", "<b>", "<c>", "<g>")]
    for bad in (nq, str(tmp_path / "missing")):
        with pytest.raises((ValueError, FileNotFoundError)):
            nt.load_document(spark, bad)
        assert nt.load_document(spark, bad, silent=True).count() == 0


def test_round_trip(spark, nq, tmp_path):
    quads, _ = nt.read_quads_text(spark, nq)
    sinks.write_nquads(quads, str(tmp_path / "out"), compression="gzip")
    again, rejects = nt.read_quads_text(spark, str(tmp_path / "out"))
    assert rows(again, *up.KEY) == rows(quads, *up.KEY) and rejects.count() == 0
    write_quads(quads.unionByName(quads), str(tmp_path / "store"))
    stored = read_quads(spark, str(tmp_path / "store"))
    assert rows(stored, *up.KEY) == rows(quads, *up.KEY)
    plan = pattern(stored, "?s", "<http://e/p2>", "?o")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_bucket" in plan or "p_bucket" in plan.split("PartitionFilters")[1][:80]


def base(spark):
    return up.quads_of(spark, [("<a>", "<p>", "<b>"), ("<a>", "<p>", "<c>"), ("<x>", "<p>", "<y>", "<g1>")])


def texts(df):
    return sorted(f"{s}{o}{'' if g == DEFAULT_GRAPH else g}" for s, _, o, g in rows(df, *up.KEY))


def test_apply_update(spark):
    ins = up.quads_of(spark, [("<a>", "<p>", "<b>"), ("<n>", "<p>", "<m>"), ("<n>", "<p>", "<m>")])
    gone = up.quads_of(spark, [("<a>", "<p>", "<b>"), ("<a>", "<p>", "<c>"), ("<absent>", "<p>", "<c>")])
    # Deletes minus inserts: <a><b> is in both sets and stays.
    assert texts(up.apply_update(base(spark), ins, gone)) == ["<a><b>", "<n><m>", "<x><y><g1>"]
    assert texts(up.apply_update(base(spark), None, gone)) == ["<x><y><g1>"]
    assert texts(up.apply_update(base(spark))) == texts(base(spark))


def test_update_where_skips_unbound(spark):
    sol = spark.createDataFrame([("<a>", "<b>"), ("<x>", None)], "s string, o string")
    got = up.update_where(base(spark), sol, insert=[("?o", "<q>", "?s")], delete=[("?s", "<p>", "?o")])
    assert texts(got) == ["<a><c>", "<b><a>", "<x><y><g1>"]


def test_graph_management(spark):
    b = base(spark)
    assert texts(up.copy_graph(b, "<g1>", "<g2>")) == ["<a><b>", "<a><c>", "<x><y><g1>", "<x><y><g2>"]
    assert texts(up.move_graph(b, "<g1>", DEFAULT_GRAPH)) == ["<x><y>"]
    assert texts(up.move_graph(b, "<g1>", "<g1>")) == texts(b) == texts(up.copy_graph(b, "<g1>", "<g1>"))
    assert texts(up.add_graph(b, "<g1>", DEFAULT_GRAPH)) == ["<a><b>", "<a><c>", "<x><y>", "<x><y><g1>"]
    assert texts(up.clear(b, "NAMED")) == ["<a><b>", "<a><c>"] and texts(up.clear(b, "DEFAULT")) == ["<x><y><g1>"]
    assert texts(up.graph_replace(b, "<g1>", up.graph_read(b, DEFAULT_GRAPH))) == ["<a><b>", "<a><b><g1>", "<a><c>", "<a><c><g1>"]


def test_store(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s")).create(base(spark))
    one = up.quads_of(spark, [("<n>", "<p>", "<m>")])
    store.update(inserts=one)
    store.update(deletes=one)
    store.update(inserts=one, deletes=one)
    store.update(inserts=base(spark))
    assert texts(store.current()) == ["<a><b>", "<a><c>", "<n><m>", "<x><y><g1>"]
    assert tuple(store.statistics().first()) == (1, 0)
    assert store.compact() == 1 and store.changes().count() == 0
    assert texts(store.current()) == ["<a><b>", "<a><c>", "<n><m>", "<x><y><g1>"]
    new, gone = up.diff(store.state(0), store.state(1))
    assert texts(new) == ["<n><m>"] and gone.count() == 0
    with pytest.raises(ValueError):
        store.create(base(spark))
    assert texts(store.clone(str(tmp_path / "c")).current()) == texts(store.current())


def test_batches_count_once(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s")).create(base(spark))
    log = spark.createDataFrame([("delete", "<a>", "<p>", "<b>", DEFAULT_GRAPH, 1)], "op string, s string, p string, o string, g string, seq bigint")
    store.log(log, "f0")
    store.log(log, "f0")
    assert store.changes().count() == 1 and texts(store.current()) == ["<a><c>", "<x><y><g1>"]


def test_feed(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s")).create(base(spark))
    schema = "op string, s string, p string, o string, g string, seq bigint"
    batches = [[("insert", "<n>", "<p>", "<m>", DEFAULT_GRAPH, 1)],
               [("delete", "<n>", "<p>", "<m>", DEFAULT_GRAPH, 2), ("insert", "<k>", "<p>", "<m>", DEFAULT_GRAPH, 3)]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        start_feed(stream, store, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert texts(store.current()) == ["<a><b>", "<a><c>", "<k><m>", "<x><y><g1>"]
    assert store.changes().count() == 3


def test_sinks_formats(spark, tmp_path):
    df = spark.createDataFrame([("<i>", '"a, \\"b\\""@en', 1, 2.5, True), (None, "plain", None, None, None)],
                               "x string, t string, n bigint, d double, b boolean")
    sinks.write_csv(df, str(tmp_path / "csv"))
    sinks.write_tsv(df, str(tmp_path / "tsv"))
    csv = sorted(r.value for r in spark.read.text(str(tmp_path / "csv")).collect())
    tsv = sorted(r.value for r in spark.read.text(str(tmp_path / "tsv")).collect())
    assert 'i,"a, ""b""",1,2.5,true' in csv and ",plain,,," in csv
    assert '<i>\t"a, \\"b\\""@en\t1\t2.5\ttrue' in tsv and '\t"plain"\t\t\t' in tsv
    lines = [r.value for r in sinks.bindings(df).collect()]
    assert '"t":{"value":"a, \\"b\\"","type":"literal","xml:lang":"en"}' in lines[0]
    assert lines[1] == '{"t":{"value":"plain","type":"literal"}}'


def test_views(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 2), (1, "c", 3)], "k int, v string, n int")
    folder = str(tmp_path)
    views.write_view(df, folder, "my-view")
    assert rows(views.read_view(spark, folder, "my-view", {"k": 1}, {"v": "w"}), "w", "n") == [("a", 2), ("c", 3)]
    views.load_view(spark, folder, "my-view")
    assert views.is_loaded(spark, "my-view") and spark.table("view_my_view").count() == 3
    assert views.unload_view(spark, "my-view") and not views.is_loaded(spark, "my-view")
    for bad in ("a/b", ""):
        with pytest.raises(ValueError):
            views.write_view(df, folder, bad)
    with pytest.raises(ValueError):
        views.read_view(spark, folder, "my-view", {"zz": 1})
    views.delete_view(spark, folder, "my-view")
    assert not (tmp_path / "my-view").exists()
    views.pin(df, "kept")
    assert views.pinned(spark, "kept").count() == 3
    views.unpin(spark, "kept")


def test_index_adds_up_records_that_come_in_several_rows(spark, tmp_path):
    from graphloom.sources.textstore import TextStore

    store = TextStore(spark, str(tmp_path / "several"))
    docs = spark.createDataFrame([(1, "b a b", "<e>"), (1, "a c", "<e>"), (1, "a c", "<e>"), (2, None, "<f>"), (None, "z", None)], "record bigint, text string, entity string")
    store.add(docs, entity="entity")
    found = {(r["word"], r["is_entity"], r["record"], r["score"]) for r in store.postings().collect()}
    assert found == {("a", False, 1, 3.0), ("b", False, 1, 2.0), ("c", False, 1, 2.0), ("z", False, None, 1.0), ("<e>", True, 1, 0.0), ("<f>", True, 2, 0.0)}
    # Two mentions: the record's texts have two lengths.
    assert store.postings().where("word = '<e>'").count() == 2
