"""Benchmark decontamination: a BM25 index of test items, queried by every passage with block-max WAND.

Impacts are divided by the item's own score, so a score says what part of the item's BM25 mass a passage covers and one
threshold fits all items.  A passage is two neighbouring pieces of a document; the largest impacts of the words in each
piece, over all items and then over ranges of items, bound its score from above and most passages end there.  The
others walk the inverted lists.  Items that
reach the threshold are verified by the word sequences that their question and their answer share with the text there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm.common import long_ids, table, utf8
from graphloom.session import cut_lineage, ship

#: BM25 parameters; words of a piece (a passage has two, so items are indexed in parts of one piece); postings in a block of a list; parts of
#: items in a range.
K1, B, PIECE, BLOCK, RANGE = 1.2, 0.75, 64, 16, 2
#: Part of an item's score that a passage must cover; part of the word sequences that must be found; their length.
COVER, OVERLAP, GRAM = 0.5, 0.5, 3
#: Text of the items in one index, in bytes; more items make more indexes, each small enough to send to all tasks.
SHARD_BYTES = 256 << 10

#: ASCII letters, digits and all other characters beyond ASCII make words.
_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().translate(_SPLIT).split()


def _grams(words: list[bytes]) -> set[tuple]:
    n = min(GRAM, len(words))
    return set(zip(*[words[i:] for i in range(n)])) if n else set()


def question_and_answer(data: bytes) -> tuple[list[bytes], list[bytes]]:
    """The answer is the last line, else the last sentence, else the last third of the words; the question is the rest."""
    whole = words_of(data)
    for mark in (b"\n", b".", b"?"):
        head, _, tail = data.rstrip(b" \t\r\n.?!").rpartition(mark)
        question, answer = words_of(head), words_of(tail)
        if len(question) >= GRAM and len(answer) >= GRAM:
            return question, answer
    cut = len(whole) - len(whole) // 3
    return whole[:cut], whole[cut:]


def parts_of(words: list[bytes]) -> list[Counter]:
    """Word counts of an item's parts.  The last part is as long as the others; it overlaps with the one before."""
    starts = range(0, max(1, len(words) - PIECE + 1), PIECE)
    return [Counter(words[s:s + PIECE]) for s in sorted({*starts, max(0, len(words) - PIECE)})]


class ItemIndex:
    """Inverted lists of the parts of test items, with block maxima.

    ``facts`` are the number of parts, their mean length and the document frequency of each word here, over all items;
    without them ``items`` are all items.
    """

    def __init__(self, items: list[tuple], facts: tuple[int, float, dict[bytes, int]] | None = None):
        self.items, parts = [], []
        for item_id, data in items:
            words = words_of(data or b"")
            if not words:
                continue
            question, answer = question_and_answer(data)
            self.items.append((item_id, _grams(question), _grams(answer), len(words)))
            parts += [(len(self.items) - 1, c) for c in parts_of(words)]
        self.owner = [p for p, _ in parts]
        df = Counter(w for _, c in parts for w in c)
        count, mean, often = facts or (len(parts), sum(c.total() for _, c in parts) / max(1, len(parts)), df)
        idf = {w: log(1 + (count - often[w] + 0.5) / (often[w] + 0.5)) for w in df}
        self.number = {w: i for i, w in enumerate(df)}
        lists: list[list[tuple[int, float]]] = [[] for _ in df]
        for i, (_, counts) in enumerate(parts):
            size = counts.total()
            impact = {w: idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean)) for w, tf in counts.items()}
            whole = sum(impact.values())
            for w, x in impact.items():
                lists[self.number[w]].append((i, x / whole))
        self.docs = [[d for d, _ in p] for p in lists]
        self.impacts = [[x for _, x in p] for p in lists]
        # Blocks of a list: last part in it and largest impact.
        cut = range(0, max(map(len, lists), default=0), BLOCK)
        self.lasts = [[p[min(a + BLOCK, len(p)) - 1][0] for a in cut if a < len(p)] for p in lists]
        self.tops = [[max(x for _, x in p[a:a + BLOCK]) for a in cut if a < len(p)] for p in lists]
        self.most = np.array([max(x) for x in self.impacts] + [0.0])
        # The same for ranges of parts, aligned over all lists.
        self.ranges = np.zeros((len(lists) + 1, -(-len(parts) // RANGE) or 1), np.float32)
        for t, own in enumerate(lists):
            for part, x in own:
                self.ranges[t, part // RANGE] = max(self.ranges[t, part // RANGE], x)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All (part, score) with a score of at least ``least``: block-max WAND, without the top-k heap."""
        at = {t: 0 for t in terms}
        found = []
        live = [t for t in terms]
        while live:
            live.sort(key=lambda t: self.docs[t][at[t]])
            bound, pivot = 0.0, None
            for k, t in enumerate(live):
                bound += self.most[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot is None:
                return found
            doc = self.docs[live[pivot]][at[live[pivot]]]
            while pivot + 1 < len(live) and self.docs[live[pivot + 1]][at[live[pivot + 1]]] == doc:
                pivot += 1
            # What the blocks around the pivot can give at most, and where the first of them ends.
            bound, end = 0.0, None
            for t in live[:pivot + 1]:
                block = bisect_left(self.lasts[t], doc)
                if block < len(self.lasts[t]):
                    bound += self.tops[t][block]
                    end = self.lasts[t][block] if end is None else min(end, self.lasts[t][block])
            if bound >= least:
                if self.docs[live[0]][at[live[0]]] == doc:
                    score = sum(self.impacts[t][at[t]] for t in live[:pivot + 1])
                    if score >= least:
                        found.append((doc, score))
                    goal = doc + 1
                else:
                    goal = doc
            else:
                goal = doc + 1 if end is None else max(doc, end) + 1
                if pivot + 1 < len(live):
                    goal = max(doc + 1, min(goal, self.docs[live[pivot + 1]][at[live[pivot + 1]]]))
            for t in live[:pivot + 1]:
                at[t] = bisect_left(self.docs[t], goal, at[t])
            live = [t for t in live if at[t] < len(self.docs[t])]
        return found

    def matches(self, data: bytes, cover: float = COVER, overlap: float = OVERLAP) -> list[tuple]:
        """(item_id, score, question overlap, answer overlap, first word of the passage) of a whole text, best per item."""
        words = words_of(data)
        if not words or not self.items:
            return []
        none, number = len(self.number), self.number.get
        ids = np.array([number(w, none) for w in words])
        where = np.flatnonzero(ids < none)
        if not len(where):
            return []
        pieces = -(-len(words) // PIECE)
        pairs = np.unique(where // PIECE * none + ids[where])
        piece, term = pairs // none, pairs % none
        bound = np.bincount(piece, weights=self.most[term], minlength=pieces + 1)
        best: dict[int, tuple] = {}
        begin = np.searchsorted(piece, np.arange(pieces + 2))
        for p in np.flatnonzero(bound[:-1] + bound[1:] >= cover):
            terms = np.unique(term[begin[p]:begin[p + 2]])
            # A little room, for these maxima are single-precision.
            if self.ranges[terms].sum(axis=0).max() < cover - 1e-4:
                continue
            for part, score in self.search(terms.tolist(), cover):
                item = self.owner[part]
                item_id, question, answer, length = self.items[item]
                if item in best and best[item][1] >= score:
                    continue
                near = _grams(words[max(0, p * PIECE - length):(p + 2) * PIECE + length])
                q, a = len(question & near) / max(1, len(question)), len(answer & near) / max(1, len(answer))
                whole = len((question | answer) & near) / max(1, len(question | answer))
                if q >= overlap or whole >= overlap:
                    best[item] = (item_id, score, q, a, int(p) * PIECE)
        return list(best.values())


def item_indexes(items: DataFrame) -> list[ItemIndex]:
    """Indexes of ``item_id, text``.  Items are hashed to as many indexes as their text asks for; each is built on the
    driver from its own share, about SHARD_BYTES at most, with the statistics of all items, so that scores do not hang on
    the split."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = -(-total // SHARD_BYTES) or 1
    rows = items.select("item_id", utf8(F.col("text")).alias("text"), F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).alias("share"))

    def share(s: int) -> list[tuple]:
        return [(r[0], bytes(r[1])) for r in rows.where(F.col("share") == s).orderBy("item_id", "text").collect()]

    if shards == 1:
        return [ItemIndex(share(0))]

    def count(batches):
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for own, text in zip(batch.column("share").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for part in parts_of(words) if words else []:
                    # The row without a word has the number of parts and their words.
                    for word, size in [(None, part.total()), *((w, 0) for w in part)]:
                        cell = found.setdefault((own, word), [0, 0])
                        cell[0] += 1
                        cell[1] += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.binary()),
                 pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                ["share", "word", "n", "size"])

    met = cut_lineage(rows.select("share", "text").mapInArrow(count, "share long, word binary, n long, size long")
                      .groupBy("share", "word").agg(F.sum("n").alias("n"), F.sum("size").alias("size")), "item-words")
    parts, size = met.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    df = met.where("word is not null").groupBy("word").agg(F.sum("n").alias("df"))
    # Each share again with the frequencies that its words have over all items.
    often = cut_lineage(met.where("word is not null").select("share", "word").join(df, "word"), "item-frequencies")

    def facts(s: int) -> tuple:
        return parts, size / max(1, parts), {bytes(r["word"]): r["df"] for r in often.where(F.col("share") == s).collect()}

    return [ItemIndex(share(s), facts(s)) for s in range(shards)]


def contaminated(docs: DataFrame, items: DataFrame, cover: float = COVER, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, at_word: every verified pair of document and test item.

    Null and empty texts and items match nothing; items without words are left out; repeated rows are told as often as
    they occur; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    docs, items = long_ids(docs, "doc_id"), long_ids(items, "item_id")
    kind, item_kind = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    rows = docs.select("doc_id", utf8(F.col("text")).alias("text"))

    def pairs(index: ItemIndex):
        def run(batches):
            for batch in batches:
                found = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                         for m in index.matches(t, cover, overlap)]
                if not found:
                    continue
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
        return run

    kinds = [None, None, pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "at_word"]
    schema = f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double, at_word long"
    out = None
    for index in item_indexes(items):
        one = rows.mapInArrow(pairs(index), schema)
        out = one if out is None else out.unionByName(one)
    return out


def clean(docs: DataFrame, items: DataFrame, cover: float = COVER, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` whose text holds no test item; their columns stay."""
    ship(docs.sparkSession)

    def hit(index: ItemIndex):
        return F.pandas_udf(lambda texts: pd.Series([bool(index.matches(t, cover, overlap)) for t in texts], dtype=bool), "boolean")

    for index in item_indexes(items):
        docs = docs.where(~hit(index)(utf8(F.col("text"))))
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
