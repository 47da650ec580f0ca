"""Text search on the small fixture: document ids 0, 1, 3; records 0 to 3."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.operators import text as tx

WORDS = """<Albert_Einstein>\t1\t0\t1
albert\t0\t0\t1
einstein\t0\t0\t1
theory\t0\t0\t1
alexander\t0\t1\t1
fleming\t0\t1\t1
<Alexander_Fleming>\t1\t1\t1
<Alexander_Fleming>\t1\t2\t1
He\t0\t2\t1
discovered\t0\t2\t1
penicillin\t0\t2\t1
<Penicillin>\t1\t2\t1
penicillin\t0\t3\t1
<Penicillin>\t1\t3\t1
drug\t0\t3\t1
"""
DOCS = [(0, "Albert Einstein is known for his theory of relativity."), (1, "There is also Alexander Fleming."),
        (3, "He discovered penicillin, a drug.")]


@pytest.fixture(scope="module")
def postings(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("words") / "words.tsv"
    path.write_text(WORDS)
    return tx.read_words(spark, str(path))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("docs") / "docs.tsv"
    path.write_text("".join(f"{k}\t{t}\n" for k, t in DOCS))
    return tx.read_docs(spark, str(path))


def test_tokens(spark):
    df = spark.createDataFrame([("Ünï-code, A_1  x²",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.tokens("t")).collect()] == [["ünï", "code", "a", "1", "x"], [], None]


def test_searches(postings):
    assert rows(tx.word_search(postings, "Penicillin")) == [(2,), (3,)]
    assert rows(tx.word_search(postings, "al*")) == [(0, "albert"), (1, "alexander")]
    assert rows(tx.entity_search(postings, "penicillin"), "text", "entity") == [
        (2, "<Alexander_Fleming>"), (2, "<Penicillin>"), (3, "<Penicillin>")]
    assert rows(tx.entity_search(postings, "penicillin", fixed="<Alexander_Fleming>")) == [(2,)]
    assert rows(tx.multi_word_search(postings, "penicillin disc*"), "text") == [(2,)]


def test_next_document(spark, docs):
    records = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (2,)], "record bigint")
    assert rows(tx.next_at_or_after(records, docs)) == [(0, 0), (1, 1), (2, 3), (3, 3)]
    assert rows(tx.text_of_record(records, docs), "record") == [(0,), (1,), (2,), (3,)]
    far = spark.createDataFrame([(-5,), (10,), (2 ** 40,), (2 ** 62,)], "record bigint")
    ids = spark.createDataFrame([(-(2 ** 50),), (2 ** 33,), (2 ** 41 + 7,)], "record bigint")
    assert rows(tx.next_at_or_after(far, ids)) == [(-5, 2 ** 33), (10, 2 ** 33), (2 ** 40, 2 ** 41 + 7)]


def test_scores(postings, docs):
    got = {(r["record"], r["word"]): r["score"] for r in tx.score_postings(postings, docs, tx.Scoring("tfidf")).collect()}
    assert got[(2, "penicillin")] == got[(3, "penicillin")] == pytest.approx(math.log2(3))
    assert got[(2, "<Penicillin>")] == 1.0
    lengths = {0: 9, 1: 5, 3: 5}
    avg = sum(lengths.values()) / 3
    alpha = 1 - 0.75 + 0.75 * 5 / avg
    bm25 = {(r["record"], r["word"]): r["score"] for r in tx.scored_postings(docs, tx.Scoring("bm25")).collect()}
    assert bm25[(3, "drug")] == pytest.approx(2.75 / (1.75 * alpha + 1) * math.log2(3))
    with pytest.raises(ValueError):
        tx.Scoring("bm25", b=2)


def test_config_errors(postings):
    for bad in (dict(text="t"), dict(text="t", word="a", entity="?e"), dict(text="", word="a"), dict(text="t", word="*")):
        with pytest.raises(ValueError):
            tx.SearchConfig(**bad)
    with pytest.raises(ValueError):
        tx.text_search(postings, [tx.SearchConfig("t", entity="?e")])


def test_text_limit(spark):
    data = [("e1", 1, "w1", 5.0), ("e1", 1, "w2", 5.0), ("e1", 2, "w1", 5.0), ("e1", 3, "w1", 9.0), ("e2", 4, "w1", 1.0)]
    df = spark.createDataFrame(data, "e string, t bigint, w string, s double")
    # Record 2 beats record 1 at the same score; all rows of a kept record stay.
    assert rows(tx.text_limit(df, 2, ["e"], "t", ["s"]), "e", "t", "w") == [("e1", 2, "w1"), ("e1", 3, "w1"), ("e2", 4, "w1")]
    assert tx.text_limit(df, 3, ["e"], "t", ["s"]).count() == 5
    plan = tx.text_limit(df, 2, ["e"], "t", ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_word_counts_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "b a b, c B"), (2, "  "), (3, None), (4, "a")], "record bigint, text string")
    got = df.select("record", tx.word_counts(tx.tokens("text")).alias("c"))
    assert {r["record"]: [tuple(x) for x in r["c"]] if r["c"] else None for r in got.collect()} == {
        1: [("a", 1), ("b", 3), ("c", 1)], 2: None, 3: None, 4: [("a", 1)]}
    assert exchanges(got) == 0


def test_texts_of_one_record_add_up_after_one_shuffle(spark):
    df = spark.createDataFrame([(1, "b a b"), (1, "a c"), (None, "a"), (2, None)], "record bigint, text string")
    got = tx.term_counts(df)
    assert rows(got, "record", "word", "tf") == sorted([(1, "a", 2), (1, "b", 2), (1, "c", 1), (None, "a", 1)], key=repr)
    # Dealing out the texts is the only shuffle, however many words they have.
    assert "Exchange hashpartitioning(record" in got._jdf.queryExecution().executedPlan().toString() and exchanges(got) == 1


def test_next_document_of_a_full_block_is_quick(spark):
    """60,000 ids of one block: the time must not grow with the square of them."""
    import time

    start = time.time()
    records = spark.range(60_000).select(F.col("id").alias("record"))
    docs = spark.range(0, 60_000, 7).select(F.col("id").alias("record"))
    got = tx.next_at_or_after(records, docs)
    assert got.where("doc < record or doc - record > 6 or doc % 7 <> 0").isEmpty() and got.count() == 59_998 - 59_998 % 7 + 1
    assert time.time() - start < 8
