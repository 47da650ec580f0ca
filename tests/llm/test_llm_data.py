"""Mixing, sharding, token files, token totals and decontamination."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import decontaminate, mixing, sharding, token_counts, token_files

DOCS = "doc_id long, text string, lang string, source string, size string, shard string, part string"


def doc(i, text, source="a"):
    return i, text, "en", source, "clash", "clash", "clash"


# --- mixing -----------------------------------------------------------------------------------------------------------

def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [3, 1, 2], 45, 2) == pytest.approx([20, 25 / 3, 50 / 3])
    got = mixing.water_fill([1, 100, 50], [3, 1, 2], 226.5, 2)
    assert got[0] == 2 and sum(got) == pytest.approx(226.5) and got[1] <= 200 and got[2] <= 100


def test_route_is_a_cheapest_maximal_flow():
    draw = random.Random(1)
    for _ in range(40):
        p, s = draw.randrange(1, 4), draw.randrange(1, 3)
        capacity = [draw.randrange(1, 4) for _ in range(p)]
        members = [sorted(draw.sample(range(s), draw.randrange(1, s + 1))) for _ in range(p)]
        quotas = [draw.randrange(0, 6) for _ in range(s)]
        best = None
        choices = [[c for c in itertools.product(range(2 * w + 1), repeat=len(m)) if sum(c) <= 2 * w] for w, m in zip(capacity, members)]
        for pick in itertools.product(*choices):
            used = Counter()
            for m, c in zip(members, pick):
                used.update(dict(zip(m, c)))
            if all(used[j] <= q for j, q in enumerate(quotas)):
                total, cost = sum(map(sum, pick)), sum(max(0, sum(c) - w) for w, c in zip(capacity, pick))
                best = max(best, (total, -cost)) if best else (total, -cost)
        flows = mixing.route(capacity, members, quotas, 2)
        sent = [sum(f.values()) for f in flows]
        assert (sum(sent), -sum(max(0, x - w) for x, w in zip(sent, capacity))) == best
        assert all(sum(f.get(j, 0) for f in flows) <= q for j, q in enumerate(quotas))


def test_mix(spark):
    draw = random.Random(3)
    rows = [(i, " ".join("w" * draw.randrange(1, 60))) for i in range(600)]
    docs = [doc(i, t, draw.choice(["b", "a", "a", "a", None, "é"])) for i, t in rows] + [doc(900, None), doc(901, ""), doc(None, "x y"), doc(None, "x y")]
    df = mixing.sized(spark.createDataFrame(docs, DOCS), "doc_id", "source", "shard")
    targets = mixing.source_targets(df)
    assert [t[0] for t in targets] == ["a", "b", "é", None]
    runs = [sorted(mixing.mix(x, targets).select("doc_id", "size", "source", "taken").collect(), key=str) for x in (df, df.repartition(5))]
    assert runs[0] == runs[1]
    for name, size, target in targets:
        own = [r for r in runs[0] if r["source"] == name]
        assert sum(r["size"] for r in own) == size and target <= 2 * size + 1e-9
        assert abs(sum(r["taken"] for r in own) - target) <= max(2, 0.01 * target)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in runs[0])
    assert sum(t[2] for t in targets) == pytest.approx(1.5 * sum(t[1] for t in targets))


def test_overlapping_sources(spark):
    rows = [(i, 10, ["x", "y"] if i < 10 else ["x"] if i < 12 else [] if i == 12 else ["y"]) for i in range(16)]
    df = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, [("x", 120, 60.0), ("y", 130, 60.0)]).collect()}
    # 120 words are wanted and 150 are there: nothing is repeated.
    assert sum(got.values()) == 120 and max(got.values()) == 10 and got[12] == 0


def test_rows_with_null_sources_stay(spark):
    df = spark.createDataFrame([(1, 10, ["x"]), (2, 10, None), (3, 10, [])], "doc_id long, size long, sources array<string>")
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, [("x", 10, 10.0)]).collect()}
    assert got == {1: 10, 2: 0, 3: 0}


def test_mix_nothing(spark):
    df = mixing.sized(spark.createDataFrame([], DOCS), "doc_id", "source")
    assert mixing.source_targets(df) == [] and mixing.mix(df, []).count() == 0
    none = mixing.sized(spark.createDataFrame([doc(1, None), doc(2, "")], DOCS), "doc_id", "source")
    assert [r["taken"] for r in mixing.mix(none, mixing.source_targets(none)).collect()] == [0, 0]
    assert mixing.repeated(mixing.mix(none, mixing.source_targets(none))).count() == 0


# --- sharding ---------------------------------------------------------------------------------------------------------

def walk(ring, keys, capacity):
    """Row by row: own rows first in ring order, then what is left over, first come first served."""
    nodes = sorted(ring, key=lambda r: r["node"])
    full, room = 1 << sharding.RING_BITS, dict(capacity)
    owner, over = {}, []
    for node in nodes:
        mine = sorted((k for k in keys if in_arc(k[0], node["lo"], node["hi"], node["node"])), key=lambda k: ((k[0] - node["lo"]) % full, k[1]))
        for k in mine:
            if room[node["node"]] > 0:
                room[node["node"]] -= 1
                owner[k] = node["shard"]
            else:
                over.append((node["node"], k))
    # Once around, from a node before which nobody is waiting.
    for start in range(len(nodes)):
        queue, left, passed = [], dict(room), {}
        for at in [*range(start, len(nodes)), *range(start)]:
            while queue and left[at]:
                passed[queue.pop(0)] = nodes[at]["shard"]
                left[at] -= 1
            queue += [k for n, k in over if n == at]
        if not queue:
            return owner | passed
    raise AssertionError("no place for all rows")


def in_arc(pos, lo, hi, node):
    return lo < pos <= hi if lo < hi else node == 0 and (pos > lo or pos <= hi)


@pytest.mark.parametrize("slack", [0.0, 0.05, 0.5])
def test_ring_walk(spark, slack):
    keys = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("clash").alias("shard"), F.lit(1).alias("cell"))
    got = {r["doc_id"]: (int(r["shard"]), r["slot"]) for r in sharding.shard(keys, 5, vnodes=8, slack=slack).collect()}
    ring = sharding.ring(spark, 5, 8).collect()
    cap = {s: 100 if slack == 0 else int(-(-500 * (1 + slack) // 5)) for s in range(5)}
    capacity = {r["node"]: cap[r["shard"]] * (r["vnode"] + 1) // 8 - cap[r["shard"]] * r["vnode"] // 8 for r in ring}
    placed = [(r["p"], r["doc_id"]) for r in keys.select("doc_id", sharding.place(F.lit(0), F.col("doc_id")).alias("p")).collect()]
    want = walk(ring, placed, capacity)
    counts = Counter(s for s, _ in got.values())
    assert max(counts.values()) <= max(cap.values())
    assert counts == Counter(want.values())
    assert {k[1]: s for k, s in want.items()} == {i: s for i, (s, _) in got.items()}
    for s in counts:
        assert sorted(slot for x, slot in got.values() if x == s) == list(range(counts[s]))


def test_growing_moves_few_rows(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.shard(keys, n, slack=0.5).collect()} for n in (8, 9))
    assert sum(a[k] != b[k] for k in a) < 0.3 * len(a)


def test_shard_odd_tables(spark):
    rows = [(None,)] * 7 + [(1,)] * 20 + [(2,)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long"), 16, slack=0.0).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 28 and len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    assert sharding.shard(spark.createDataFrame([], "doc_id long"), 16, slack=0.0).count() == 0


# --- token files ------------------------------------------------------------------------------------------------------

ODD = ["Don't a.b. ... ,, x. É. İ. ΟΔΟΣ. 12. a\tb\x1cc d", "<|endoftext|> A. <|ENDOFTEXT|> É, I,", "ß. ſ K, 한국어. é. 'll they're, 's.", "  ",
       "\n\n", "日本語。テスト.", "1,000.5 x1. ¡Ñandú! naïve, ÀÉÎ. word​. á,", "ǅ. ŉ, ﬁ."]


def test_encoder_equals_whole_texts():
    encoder = token_files.WordEncoder(token_files.default_tokenizer())
    for text in ODD * 2:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids, text


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 5)
    test_encoder_equals_whole_texts()


def test_token_files(spark, tmp_path):
    rows = [doc(i * 3 % 101, t) for i, t in enumerate(ODD * 3)] + [doc(500, None), doc(501, ""), doc(None, "null id"), doc(7, "again"), doc(7, "again")]
    path = token_files.default_tokenizer()
    token_files.write_tokens(spark.createDataFrame(rows, DOCS).repartition(4), str(tmp_path / "t"), path, 1, **{"parquet.block.size": "4096"})
    stored = token_files.read_tokens(spark, str(tmp_path / "t"))
    library = token_files.encoder(path).library
    want = Counter((r[0], (*library.encode(r[1] or "", add_special_tokens=False).ids, 1)) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stored.collect()) == want
    got = sorted(token_files.digests(stored).join(token_files.starts(spark, str(tmp_path / "t")), "part").collect(), key=lambda r: (r["part"], r["at"]))
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r["first"] + r["at"] == at
        at += r["n_tokens"]
    by_text = {(i, zlib.crc32(np.array(t, "<u4").tobytes())) for i, t in want}
    assert {(r["doc_id"], r["ids_crc32"]) for r in got} == by_text


def test_layout_of_files(spark, tmp_path):
    import pyarrow.parquet as pq

    token_files.write_tokens(spark.createDataFrame([doc(i, "some words " * 50) for i in range(50)], DOCS).coalesce(1), str(tmp_path / "t"), token_files.default_tokenizer())
    column = pq.ParquetFile(next((tmp_path / "t").glob("part-*"))).metadata.row_group(0)
    names = {column.column(i).path_in_schema: column.column(i) for i in range(column.num_columns)}
    ids = next(c for n, c in names.items() if n.startswith("ids"))
    assert "DELTA_BINARY_PACKED" in ids.encodings and ids.has_offset_index and ids.has_column_index


def test_no_tokens(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([], DOCS), str(tmp_path / "t"), token_files.default_tokenizer())
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0


# --- token totals -----------------------------------------------------------------------------------------------------

def test_token_totals(spark, tmp_path):
    totals = token_counts.TokenTotals(spark, str(tmp_path / "totals"))
    assert totals.totals().count() == 0
    docs = spark.createDataFrame([doc(1, "a b. c", "x"), doc(2, "d", None), doc(3, None, "x"), doc(4, "e f", "x"), doc(4, "e f", "x")], DOCS)
    counts = token_counts.counted(docs)
    assert totals.commit("b1", token_counts.inserts(counts))
    assert not totals.commit("b1", token_counts.inserts(counts))
    assert totals.commit("b2", token_counts.deletes(token_counts.counted(docs.where("doc_id = 4"))))
    before, after = docs.where("doc_id = 1"), docs.where("doc_id = 1").withColumn("text", F.lit("a")).withColumn("source", F.lit("y"))
    assert totals.commit("b3", token_counts.revisions(token_counts.counted(before), token_counts.counted(after)))
    assert totals.commit("b4", token_counts.inserts(counts.where("false")))
    again = token_counts.TokenTotals(spark, str(tmp_path / "totals"))
    assert sorted(again.committed()) == ["b1", "b2", "b3", "b4"] and not again.commit("b2", token_counts.inserts(counts))
    got = {(r["source"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in again.totals().collect()}
    assert got == {("x", "words-1"): (1, 0), ("x", "words-2"): (1, 0), ("y", "words-1"): (1, 1), ("y", "words-2"): (1, 1),
                   (None, "words-1"): (1, 1), (None, "words-2"): (1, 1)}


def test_failed_batch_leaves_nothing(spark, tmp_path):
    totals = token_counts.TokenTotals(spark, str(tmp_path / "totals"))
    bad = token_counts.inserts(token_counts.counted(spark.createDataFrame([doc(1, "a")], DOCS))).withColumn("tokens", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        totals.commit("b1", bad)
    assert totals.committed() == {} and totals.totals().count() == 0
    with pytest.raises(ValueError):
        totals.commit("../x", bad)


# --- decontamination --------------------------------------------------------------------------------------------------

def words(draw, n):
    return [draw.choice(["the", "of", "and", "is"]) if draw.random() < 0.4 else f"v{draw.randrange(3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def leaks():
    draw = random.Random(9)
    items = [(i, " ".join(words(draw, n)) + ".") for i, n in enumerate([12, 30, 30, 45, 64, 65, 150, 400, 2, 30])]
    docs, want = [], set()
    for i in range(150):
        body = words(draw, draw.choice([5, 80, 300, 3000]))
        if i % 3 == 0:
            item, text = draw.choice(items[:8])
            at = draw.randrange(len(body))
            body[at:at] = text.upper().replace("V", "v").split() if i % 2 else text.split()
            want.add((i, item))
        docs.append(doc(i, " ".join(body)))
    docs += [doc(900, None), doc(901, ""), doc(None, items[1][1])]
    want.add((None, 1))
    return [*items, (10, None), (11, ""), (12, " .. ")], docs, want


def test_contaminated(spark, leaks):
    items, docs, want = leaks
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, DOCS)
    found = decontaminate.contaminated(df, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(r["question_overlap"] >= 0.5 for r in found)
    clean = decontaminate.clean(df, benchmark)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {d[0] for d in docs} - {d for d, _ in want}


def test_several_indexes_give_the_same(spark, leaks, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 1500)
    items, docs, want = leaks
    found = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_scores_do_not_depend_on_the_split(spark, leaks, monkeypatch):
    draw = random.Random(9)
    items = leaks[0] + [(100 + i, " ".join(words(draw, 90))) for i in range(40)]
    # Parts of items of every length, so that many scores are near the threshold.
    docs = [doc(i, " ".join([*words(draw, 60), *text.split()[:5 + 2 * i % 80], *words(draw, 60)])) for i, (_, text) in enumerate(items) if text]
    found = []
    for size in (1 << 20, 1500):
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", size)
        rows = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
        found.append({(r["doc_id"], r["item_id"]): r["score"] for r in rows.collect()})
    assert len(found[0]) > 10 and found[0] == pytest.approx(found[1])


def test_search_against_all_scores(leaks):
    draw = random.Random(1)
    index = decontaminate.ItemIndex([(i, " ".join(words(draw, 40)).encode()) for i in range(120)])
    for _ in range(60):
        terms = sorted({index.number[w] for w in words(draw, 120) for w in [w.encode()] if w in index.number})
        scores = Counter()
        for t in terms:
            for d, x in zip(index.docs[t], index.impacts[t]):
                scores[d] += x
        for least in (0.02, 0.1, 0.3):
            got = dict(index.search(list(terms), least))
            assert set(got) >= {d for d, x in scores.items() if x >= least + 1e-9}
            assert all(x == pytest.approx(scores[d]) for d, x in got.items())


def test_decontaminate_nothing(spark, leaks):
    items = spark.createDataFrame([], "item_id long, text string")
    df = spark.createDataFrame(leaks[1][:5], DOCS)
    assert decontaminate.contaminated(df, items).count() == 0 and decontaminate.clean(df, items).count() == 5
    empty = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame(leaks[0], "item_id long, text string")
    assert decontaminate.contaminated(empty, some).count() == 0 and decontaminate.clean(empty, some).count() == 0
