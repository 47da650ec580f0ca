"""Commit log, feeds and compactions that lose nothing, clustered copies, text segments."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.operators import text as tx, updates as up
from graphloom.operators.scan import from_graphs, from_named, graph_except, pattern
from graphloom.sources.commitlog import CommitLog
from graphloom.sources.mapping import MappedGraph, TableMap
from graphloom.sources.quadstore import QuadStore
from graphloom.sources.textstore import TextStore
from graphloom.streaming.feed import start_feed

CHANGE = "op string, s string, p string, o string, g string, seq long"


def changes(spark, *made):
    return spark.createDataFrame([(op, "<a>", "<p>", o, DEFAULT_GRAPH, n) for n, (op, o) in enumerate(made)], CHANGE)


def store_of(spark, path):
    return QuadStore(spark, str(path)).create(up.quads_of(spark, [("<a>", "<p>", "<b>")]), ("p",))


def test_a_number_is_created_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.put(0, {"x": 1}) and not log.put(0, {"x": 2}) and log.get(0) == {"x": 1} and log.numbers() == [0]
    seen = []

    def decide():
        # Another writer takes the number in the first attempt.
        if not seen:
            log.put(1, {"x": "other"})
        seen.append(log.last())
        return {"x": "mine"}

    assert log.append(decide) == 2 and len(seen) == 2
    assert [log.get(n)["x"] for n in log.numbers()] == [1, "other", "mine"]
    assert log.append(lambda: None) is None


def test_two_feeds_and_a_feed_with_a_new_checkpoint(spark, tmp_path):
    stores = [store_of(spark, tmp_path / name) for name in ("with", "without")]
    changes(spark, ("insert", "<from-a>")).write.parquet(str(tmp_path / "a"))
    changes(spark, ("insert", "<from-b>")).write.parquet(str(tmp_path / "b"))
    for n, store in enumerate(stores):
        for feed in ("a", "b", "b"):
            stream = spark.readStream.schema(CHANGE).parquet(str(tmp_path / feed))
            start_feed(stream, store, str(tmp_path / f"checkpoint-{n}-{feed}"), available_now=True).awaitTermination()
            if n == 0 and feed == "a":
                store.compact()
        assert rows(store.current(), "o") == [("<b>",), ("<from-a>",), ("<from-b>",)]
    # A new checkpoint begins with batch 0 again; what it brings counts.
    changes(spark, ("delete", "<from-a>")).write.mode("append").parquet(str(tmp_path / "a"))
    stream = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "a"))
    start_feed(stream, stores[0], str(tmp_path / "fresh"), available_now=True).awaitTermination()
    assert stores[0].changes().where("o = '<from-a>'").count() == 2


def test_order_holds_across_compactions(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    for n in range(2):
        store.log(changes(spark, ("insert", f"<{n}>")), f"b{n}")
    held = store._publish
    store._publish = lambda n: (store.log(changes(spark, ("insert", "<x>")), "b2"), held(n))
    assert store.compact() == 1
    store._publish = held
    store.log(changes(spark, ("delete", "<x>")), "b3")
    assert rows(store.current(), "o") == [("<0>",), ("<1>",), ("<b>",)]
    assert not store.log(changes(spark, ("insert", "<x>")), "b2") and not store.log(changes(spark, ("insert", "<x>")), "b0")
    assert store.compact() == 2 and rows(store.current(), "o") == [("<0>",), ("<1>",), ("<b>",)]
    # Numbers of a feed ascend: an older one is a repetition, a newer one counts.
    assert store.log(changes(spark, ("insert", "<f>")), "feed", 5) and not store.log(changes(spark, ("delete", "<f>")), "feed", 4)
    assert store.log(changes(spark, ("delete", "<f>")), "feed", 6) and rows(store.current(), "o") == [("<0>",), ("<1>",), ("<b>",)]
    assert store.vacuum() == 6 and rows(store.current(), "o") == [("<0>",), ("<1>",), ("<b>",)]


def test_two_compactions_at_once(spark, tmp_path):
    store, other = store_of(spark, tmp_path / "s"), QuadStore(spark, str(tmp_path / "s"))
    store.log(changes(spark, ("insert", "<x>")), "b0")
    held = store._publish
    store._publish = lambda n: (other.log(changes(spark, ("delete", "<x>")), "b1"), other.compact(), held(n))
    assert store.compact() == 1 and rows(store.current(), "o") == [("<b>",)] and store.changes().count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_patterns_read_the_copy_of_what_they_bind(spark, tmp_path):
    data = [(f"<s{i}>", f"<p{i % 3}>", f"<o{i % 7}>", "<g>" if i % 2 else DEFAULT_GRAPH) for i in range(60)]
    quads = up.quads_of(spark, data)
    store = QuadStore(spark, str(tmp_path / "s")).create(quads)
    g = store.graph()
    cases = {("<s7>", "?p", "?o"): "s", ("?s", "?p", "<o3>"): "o", ("?s", "<p1>", "?o"): "p", ("?s", "<p1>", "<o3>"): "o", ("<s7>", "<p1>", "?o"): "s"}
    for triple, copy in cases.items():
        df = pattern(g, *triple)
        assert rows(df) == rows(pattern(quads, *triple)) and df.count() > 0
        constant = next(x for x, c in zip(triple, "spo") if c == copy)
        assert re.search(rf"PartitionFilters: \[[^\]]*{copy}_bucket", plan(df)) and all(f"/by_{copy}/" in f for f in df.inputFiles())
        assert f"EqualTo({copy},{constant})" in plan(df)
    assert rows(pattern(g, "?s", "?p", "?o")) == rows(pattern(quads, "?s", "?p", "?o"))
    for restrict in (lambda x: from_graphs(x, ["<g>"]), lambda x: from_graphs(x, ["<g>", DEFAULT_GRAPH]), lambda x: from_named(x, ["<g>"]), lambda x: graph_except(x, "<g>")):
        assert rows(pattern(restrict(g), "?s", "?p", "<o3>", g=None)) == rows(pattern(restrict(quads), "?s", "?p", "<o3>"))
    # Changes that no base holds yet are seen by every copy, and a compaction keeps the copies in step.
    store.update(inserts=up.quads_of(spark, [("<s7>", "<new>", "<o3>")]), deletes=up.quads_of(spark, [data[7]]))
    for _ in range(2):
        assert rows(pattern(store.graph(), "<s7>", "?p", "?o")) == [("<new>", "<o3>")]
        assert ("<s7>", "<new>") in rows(pattern(store.graph(), "?s", "?p", "<o3>")) and store.current("<new>").count() == 1
        store.compact()
    # A store with fewer copies answers the same.
    lean = QuadStore(spark, str(tmp_path / "lean")).create(quads, ("p",))
    assert rows(pattern(lean.graph(), "<s7>", "?p", "?o")) == rows(pattern(quads, "<s7>", "?p", "?o"))
    with pytest.raises(ValueError):
        QuadStore(spark, str(tmp_path / "bad")).create(quads, ("x",))


def test_constants_reach_mapped_tables(spark, tmp_path):
    spark.createDataFrame([(i, f"n{i % 5}", i % 4) for i in range(40)], "k long, name string, r long").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(i,) for i in range(4)], "r_k long").write.parquet(str(tmp_path / "r"))
    g = MappedGraph([TableMap("t", spark.read.parquet(str(tmp_path / "t")), ["k"], refs={"r": "r"}), TableMap("r", spark.read.parquet(str(tmp_path / "r")), ["r_k"])])
    everything = g.quads()
    for triple in [("<t/7>", "?p", "?o"), ("?s", "?p", "<r/3>"), ("?s", "?p", '"n2"'), ("?s", "?p", "<t>"), ("<t/7>", "?p", "<r/3>"), ("<x/1>", "?p", "?o"), ("<t/007>", "?p", "?o")]:
        assert rows(pattern(g, *triple)) == rows(pattern(everything, *triple))
    one = pattern(g, "<t/7>", "?p", "?o")
    assert "EqualTo(k,7)" in plan(one) and not any("/r/" in f for f in one.inputFiles())
    assert re.search(r"PushedFilters: \[.*EqualTo\(r,3\)", plan(pattern(g, "?s", "?p", "<r/3>")))


# --- text segments ----------------------------------------------------------------------------------------------------

DOCS = [(1, "The cat sat.", "<x>"), (2, "the dog and the cat", "<y>"), (3, "", "<x>"), (4, None, None), (5, "Cats catch", "<y>")]


def test_segments_give_what_one_index_gives(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "record long, text string, entity string")
    store = TextStore(spark, str(tmp_path / "t"))
    assert store.postings().count() == 0
    assert store.add(docs.where("record < 3"), entity="entity", batch="one") and not store.add(docs, entity="entity", batch="one")
    assert store.add(docs.where("record >= 3"), entity="entity", batch="two")
    want = tx.build_postings(docs, entity="entity").where("word is not null")
    columns = ["word", "is_entity", "record", "score"]
    for _ in range(2):
        assert rows(store.postings(), *columns) == rows(want, *columns)
        for scoring in (tx.Scoring("bm25"), tx.Scoring("tfidf"), tx.Scoring("explicit")):
            ours = store.scored(scoring, ["cat", "the", "absent"]).withColumn("score", F.round("score", 9))
            plain = tx.scored_postings(docs, scoring, ["cat", "the", "absent"]).withColumn("score", F.round("score", 9))
            assert rows(ours, "record", "word", "tf", "score") == rows(plain, "record", "word", "tf", "score")
        assert rows(tx.word_search(store.postings(), "CAT*", score="s")) == [(1, "cat", 1.0), (2, "cat", 1.0), (5, "catch", 1.0), (5, "cats", 1.0)]
        assert rows(tx.entity_search(store.postings(), "cat the")) == [(1, "<x>"), (2, "<y>")]
        store.merge()
    assert len(store.segments()) == 1 and not store.merge() and not store.add(docs, batch="two")
    assert re.search(r"PushedFilters: \[.*EqualTo\(word,cat\)", plan(tx.word_search(store.postings(), "cat")))
    assert re.search(r"PushedFilters: \[.*StringStartsWith\(word,ca\)", plan(tx.word_search(store.postings(), "ca*")))


def test_marks_hide_older_segments_only(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "record long, text string, entity string")
    store = TextStore(spark, str(tmp_path / "t"))
    store.add(docs, entity="entity")
    store.delete(spark.createDataFrame([(2,), (2,), (99,)], "record long"))
    assert rows(tx.word_search(store.postings(), "the")) == [(1,)] and rows(store.docs(), "record") == [(1,), (3,), (4,), (5,)]
    left = docs.where("record <> 2")
    check = lambda kept: (
        rows(store.scored(tx.Scoring("bm25"), ["cat"]).select("record", F.round("score", 9))) == rows(tx.scored_postings(kept, tx.Scoring("bm25"), ["cat"]).select("record", F.round("score", 9))))
    assert check(left)
    store.merge()
    assert check(left)
    changed = spark.createDataFrame([(1, "a new text", "<z>"), (2, "cat again", "<z>")], "record long, text string, entity string")
    store.add(changed, entity="entity", replace=True)
    now = docs.where("record not in (1, 2)").unionByName(changed)
    assert rows(tx.word_search(store.postings(), "the")) == [] and rows(tx.entity_search(store.postings(), "cat")) == [(2, "<z>")] and check(now)
    store.merge()
    assert check(now) and store.vacuum() == 4 and check(now)


def test_words_file_segment(spark, tmp_path):
    (tmp_path / "w.tsv").write_text('Cat\t0\t1\t2.5\n<x>\t1\t1\t1.5\n"q\t0\t2\t1\n')
    store = TextStore(spark, str(tmp_path / "t"))
    store.add_words(tx.read_words(spark, str(tmp_path / "w.tsv")))
    store.add(spark.createDataFrame([(3, "cat")], "record long, text string"))
    assert rows(tx.word_search(store.postings(), "cat", score="s")) == [(1, 2.5), (3, 1.0)]
    assert rows(tx.entity_search(store.postings(), "cat", score="s")) == [(1, "<x>", 1.5)]
    assert rows(store.docs()) == [(1, 1), (2, 1), (3, 1)]


def test_patterns_follow_the_store(spark, tmp_path):
    from graphloom.operators import predicates as pr
    from graphloom.sources.patternstore import PatternStore

    quad = lambda s, p, o="<x>": (s, p, o)
    start = [quad("<a>", "<p>"), quad("<a>", "<q>"), quad("<b>", "<p>"), quad("<b>", "<p>", "<y>"), quad("<c>", "<r>")]
    store = QuadStore(spark, str(tmp_path / "s")).create(up.quads_of(spark, start), ("p",))
    patterns = PatternStore(spark, str(tmp_path / "p"))
    some = spark.createDataFrame([("<a>",), ("<c>",), ("<c>",), ("<n>",)], "s string")

    def check():
        now = store.current()
        assert rows(patterns.available_predicates()) == rows(pr.available_predicates(now))
        assert rows(patterns.available_predicates(some)) == rows(pr.available_predicates(now, some))
        assert rows(patterns.subjects(), "s") == rows(now.select("s").distinct())

    assert patterns.refresh(store) and not patterns.refresh(store)
    check()
    # A new subject, a changed one and one that loses all; a delete without effect changes nothing.
    store.update(inserts=up.quads_of(spark, [quad("<n>", "<p>"), quad("<b>", "<r>")]), deletes=up.quads_of(spark, [quad("<c>", "<r>"), quad("<a>", "<absent>")]))
    store.update(deletes=up.quads_of(spark, [quad("<b>", "<p>")]))
    assert patterns.refresh(store)
    check()
    store.update(inserts=up.quads_of(spark, [quad("<c>", "<r>")]))
    assert patterns.refresh(store) and len(patterns._segments()) == 3
    check()
    # A compaction swallows a change before the dictionary has seen it: it is made anew.
    store.update(deletes=up.quads_of(spark, [quad("<n>", "<p>")]))
    store.compact()
    assert patterns.refresh(store) and len(patterns._segments()) == 1
    check()
