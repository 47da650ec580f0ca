"""Phrases, ranked search and line de-duplication against plain versions, with odd rows and clashing columns."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import floor, log

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm import line_dedup, phrases, queries, ranked_search

DOCS = "doc_id long, text string, lang string, h string, rank string, block string, shard string, score string, k string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, lang, *["clash"] * 6) for i, t, lang in rows], DOCS).repartition(partitions)


ODD = [(900, None, "en"), (901, "", None), (None, "a b", "en"), (902, " \t\n", "fr"), (903, "\n\n", "fr"), (904, "é" * 50 + "\n" + "É" * 50, "fr")]


# --- lines ------------------------------------------------------------------------------------------------------------

def plain_lines(rows, chars, least):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= chars:
                holders[key(line)].add(i)
    largest = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= least}
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in largest or largest[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_against_a_plain_version(spark, batches):
    draw = random.Random(batches)
    pool = [f"Line {n} of the pool " + "ÄÖ xyz " * (n % 4) for n in range(12)] + ["short", "", " \x0b"]
    dress = lambda s: draw.choice(["", " ", "\t\x0c", "\r"]) + draw.choice([s, s.replace("L", "l"), s.upper().replace("Ä", "Ä")]) + draw.choice(["", "  ", "\x0b"])
    rows = [(i, "\n".join(dress(draw.choice(pool)) for _ in range(draw.randrange(1, 9))), "en") for i in range(120)]
    # A hot line in a third of all documents, rows with one id and two texts, equal rows, a very long text.
    rows += [(200 + i, "The one line that a third of all documents hold\nown " + str(i), "en") for i in range(60)]
    rows += [(7, "another text\n" + pool[3], "en"), (8, pool[5], "en"), (8, pool[5], "en"), (500, "\n".join(pool * 400), "en"), *ODD]
    df = frame(spark, rows)
    got = line_dedup.dedup_lines(df, 20, 5, batches).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_lines(rows, 20, 5)


def test_no_lines(spark):
    assert line_dedup.dedup_lines(frame(spark, []).limit(0)).count() == 0


def test_runs_stay_few_and_skip_settled_keys(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), min_docs=2, fanout=2)
    batch = lambda keys, doc: spark.createDataFrame([(doc, k, k) for k in keys], "doc_id long, h long, g long")
    for n in range(1, 8):
        runs.add(batch([1, 2, 10 + n], 100 - n).unionByName(batch([1], 50 - n)))
        # Seven batches leave at most one run on each level.
        assert [len(level) for level in runs.levels()] == [int(b) for b in reversed(f"{n:b}")]
    assert sorted(tuple(r) for r in runs.repeated().collect()) == [(1, 1, 99), (2, 2, 99)]
    # The shared keys are settled, at the latest when a merge has added up their documents, and no longer enter a run.
    newest = runs.run(runs.levels()[0][0])
    assert sorted(r["h"] for r in newest.collect()) == [17]
    # A job that starts anew finds the runs of the log.
    runs.forget()
    again = line_dedup.LineRuns(spark, str(tmp_path / "runs"), min_docs=2)
    assert again.repeated().count() == 2
    again.forget()


# --- ranked search ----------------------------------------------------------------------------------------------------

def terms(text):
    return [m.translate({c: c + 32 for c in range(65, 91)}) for m in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_search(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t, _ in docs if terms(t)]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out, asked = [], defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    for item, words in asked.items():
        found = []
        for i, tf in held:
            m = 10 + 90 * tf.total() * n // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in words if t in tf)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 10, 1 << 22])
def test_search_against_a_plain_version(spark, tmp_path, block):
    draw = random.Random(block)
    vocabulary = [f"w{n}" for n in range(30)] + ["Ünï", "ünï", "X9", "x9"]
    text = lambda most: draw.choice([" ", ", ", "\x00", "|"]).join(draw.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=draw.randrange(1, most)))
    docs = [(i, text(40), "en") for i in range(150)] + [(1000 + i, "w1 w2 w33 w1", "en") for i in range(60)]
    docs += [(5, "w1 w2", "en"), (5, "w1 w2", "en"), (None, "w3 w3 rare", "en"), (2000, text(5000), "en"), *ODD]
    items = [(n, text(12)) for n in range(9)] + [(3, "w29 x9"), (20, None), (21, ""), (22, "absent"), (None, "rare w3"), (23, "w1 w2 w33")]
    index = ranked_search.build_index(frame(spark, docs), str(tmp_path / "index"), block)
    for top in (3, 10):
        got = ranked_search.search(index, spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x")), top)
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain_search(docs, items, top)
    if block == 1 << 10:
        assert index.rows.where("term is null").count() > 5


def test_stratum_bounds_leave_out_what_cannot_win():
    # One stratum of short documents with high tf, one of long documents whose bound is below the second score.
    block = ranked_search._Block([1, 2, 3, 4], [10, 10, 900, 900], [0], [[0, 1, 2, 3]], [[9, 8, 1, 1]], 1)
    impacts, seen = block.impact, []

    class Watched:
        def __getitem__(self, at):
            seen.extend(at.tolist())
            return impacts[at]

    block.impact = Watched()
    none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    best = block.best(np.array([0]), np.array([5]), 2, none)
    assert best[2].tolist() == [1, 2] and sorted(seen) == [0, 1]
    assert best[0].tolist() == [5 * (10 ** 9 * 9 // 9080), 5 * (10 ** 9 * 8 // 8080)]


def test_blocks_by_length():
    classes = [ranked_search.length_class(m) for m in range(1, 5000)]
    assert classes == sorted(classes) and len(set(classes)) < 64 * 8
    assert ranked_search.deal_blocks({1: 3, 2: 3, 3: 25, 4: 1}, 10) == {1: (0, 1), 2: (0, 1), 3: (1, 3), 4: (4, 1)}


def test_empty_index(spark, tmp_path):
    index = ranked_search.build_index(frame(spark, ODD[:2]), str(tmp_path / "i"))
    assert ranked_search.search(index, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


# --- phrases ----------------------------------------------------------------------------------------------------------

def plain_phrases(rows, longest, least, percent, top):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                count[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {p[i:i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= percent * f[p[i:i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in hidden:
                score, cut = min((10 ** 6 * a * a // (f[p[:c]] * f[p[c:]]), c) for c in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


# 8 slots make almost all phrases share one: needless counts, the same result.
@pytest.mark.parametrize("longest, shards, slots", [(3, 2, 1 << 12), (4, 3, 8)])
def test_phrases_against_a_plain_version(spark, longest, shards, slots):
    draw = random.Random(longest)
    vocabulary = ["the", "The", "of", "time", "Über", "über", "x\x1cy", "a-b"] + [f"w{n}" for n in range(12)]
    sentence = lambda: draw.choice([" ", "\t", "  "]).join(draw.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=draw.randrange(1, 9)))
    rows = [(i, draw.choice([". ", "\n", "!", "\x0c"]).join(sentence() for _ in range(6)), draw.choice(["en", "en", "de", None])) for i in range(60)]
    rows += [(300 + i, "one hot phrase of five", "en") for i in range(40)] + [(400, "again again again again " * 500, "de"), (3, "the of", "fr"), (3, "the of", "fr"), *ODD]
    got = phrases.collocations(frame(spark, rows), longest, 6, 50, 25, shards, slots)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, longest, 6, 50, 25)


def test_products_beyond_64_bits(spark):
    a = 5_000_000_000
    counts = spark.createDataFrame([("en", 1, "x", a + 1), ("en", 1, "y", a), ("en", 2, "x y", a)], "lang string, k int, phrase string, f long")
    assert [tuple(r) for r in phrases.cohesion(counts).collect()] == [("en", 2, "x y", a, a + 1, a, 10 ** 6 * a * a // ((a + 1) * a))]


def test_no_phrases(spark):
    assert phrases.collocations(frame(spark, ODD[:2]), shards=2, slots=16).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if re.search(r"/shuffle_\d+_[^/]*\.data$", f)}


def test_shuffles_of_finished_steps_leave_the_disk(spark):
    docs = frame(spark, [(i, f"a b c w{i % 7} d e. f g {i}", "en") for i in range(90)])
    before, kept = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = phrases.collocations(docs, 3, 6, 50, 25, 2, 1 << 12)
    # Files are removed in the background.
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    assert got.collect() == got.collect() and got.count() > 0


def test_a_phrase_is_due_as_the_window_says():
    # Due: both halves reached the threshold, one of them within the last steps.
    hashes = phrases._word_hashes("en", [b"a", b"b"])
    one, two = phrases._slots(hashes, 1 << 12)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [b"a b"]})
    for reach, window, expected in [((1, 1), 1, 1), ((1, 2), 2, 1), ((1, 2), 4, 0), ((0, 1), 1, 0)]:
        steps, seen = np.zeros(1 << 12, np.uint16), np.zeros(1 << 12, np.uint8)
        steps[one], seen[two] = reach, [min(1, r) for r in reach]
        sent = type("Sent", (), {"value": (zlib.compress(steps.tobytes()), zlib.compress(seen.tobytes()))})()
        assert sum(b.num_rows for b in phrases._count_step(sent, window, False, 2, 7)(iter([batch]))) == expected


def test_pages_hold_every_hash_once():
    draw = np.random.default_rng(1)
    h = np.unique(draw.integers(0, 2 ** 64, 5000, np.uint64))
    for pages in (1, 7, 600):
        batch = phrases._paged(h, np.ones(len(h), np.int64), pages)
        assert max(batch.column("page").to_pylist()) < pages and len(set(batch.column("page").to_pylist())) == batch.num_rows
        got, f = phrases._added(batch.column("h").to_pylist() * 2, batch.column("f").to_pylist() * 2)
        assert (got == h).all() and (f == 2).all()


def test_pages_and_batches_are_small(monkeypatch):
    words = [b"w%d" % n for n in range(20_000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [b" ".join(words)]})
    sent = type("Sent", (), {"value": (zlib.compress(np.ones(1 << 12, np.uint16).tobytes()), zlib.compress(np.ones(1 << 12, np.uint8).tobytes()))})()
    page, = phrases._count_step(sent, 1, True, 3, 1)(iter([batch]))
    assert len(phrases._added(page.column("h").to_pylist(), page.column("f").to_pylist())[0]) == 59_997
    assert len(page.column("h")[0].as_py()) < 6 * 59_997
    monkeypatch.setattr(phrases, "ROWS", 7_000, raising=False)
    counted = list(phrases._count_words(sent, 3)(iter([batch])))
    assert max(b.num_rows for b in counted) == 7_000 and sum(b.num_rows for b in counted) == 1 + 59_997
    assert sum(sum(b.column("f").to_pylist()) for b in counted[1:]) == 59_997


# --- the queries ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_phrases", "op12_ranked_search", "op13_line_dedup"])
def test_query_against_its_sql(spark, tmp_path, name):
    draw = random.Random(1)
    words = [f"word{n}" for n in range(40)]
    rows = [(i, "\n".join(" ".join(draw.choices(words, k=12)) + "." for _ in range(4)) + "\n" + "the same long line in every one of the documents " * (i % 3), draw.choice(["en", "de", None])) for i in range(80)]
    rows += [r for r in ODD if r[0] is not None]
    frame(spark, rows, 1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, " ".join(draw.choices(words, k=6))) for i in range(5)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    cursor = con.execute(queries.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns) and got.count() > 0
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


def test_words_are_numbered_alike_in_runs_of_a_long_text(monkeypatch):
    text = "Ab  c\td,e\n\n. F ab \xe9\xff".encode() + b"; x y" * 20
    rows = pa.RecordBatch.from_pydict({"lang": ["en", "de", "en", "xx"], "text": [text, b"", text, b" .\t"]})
    want = phrases.pieces_of(text) * 2
    for size in (1 << 20, 16):
        monkeypatch.setattr(phrases, "CHUNK", size)
        found = list(phrases._chunks([rows]))
        assert {lang for lang, _, _ in found} == {"en"} and (len(found) > 1) == (size == 16)
        got = [[words[i] for i in piece if i >= 0] for _, ids, words in found for piece in np.split(ids, np.flatnonzero(ids < 0))]
        assert [piece for piece in got if piece] == want
