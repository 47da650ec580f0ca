"""Ranked lexical search on a length-stratified index.

The score of a document depends on its length only by a whole number m, so documents of equal m form a stratum.  Within a
stratum a term's postings are ordered by how often the term occurs (tf), most first: all postings of equal tf have the same
impact, which is computed once, and the first one bounds what the term can give there.  A query adds these bounds up for
each stratum, visits strata from the largest bound down, and stops where the bound falls below its k-th score.

The index is written in blocks: neighbouring strata up to BLOCK bytes, or parts of a large stratum, so no task ever holds
more than a block (and never less than a whole document), however many documents share a length.  Index rows are
(block, term, df, doc, tf); one row per block without a term lists its documents and their m.  A search reads the
rows of its terms only, keeps the k best per query and task, and ranks those.  Queries go in blocks of about
QUERY_BYTES; only they and their term weights are sent to all tasks.

Nulls, ties and odd rows: documents without terms (null or empty texts too) are not counted and never found; rows without
an id are found, after all others of equal score; equal rows are ranked one after the other; rows with the same item_id
are one query with all their terms, rows without one too; a query without terms gives no rows.  Empty tables give an empty
result.  Whole texts of any length are indexed.  Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from functools import reduce
from math import ceil, floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from graphloom.llm.common import cell_runs, table, utf8
from graphloom.session import cut_lineage, ship, shared_folder, task_count

#: Results of a query; weight of a block (bytes of text, and DOC for each document); bytes of query texts handled at a time.
TOP, BLOCK, DOC, QUERY_BYTES = 10, 4 << 20, 1 << 10, 4 << 20

#: Bytes of a term: ASCII letters and digits and everything beyond ASCII.
_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_LENGTHS = "n bigint, docs bigint, bytes bigint"
_FORWARD = "block int, m bigint, doc_id bigint, terms binary, tf binary"
_INDEX = "block int, term string, df int, doc array<int>, tf array<int>, doc_ids array<bigint>, m array<bigint>"


def terms_of(data: bytes) -> list[bytes]:
    return data.lower().translate(_SPLIT).split()


def length_class(m: int) -> int:
    """Some 64 classes of lengths for each power of two, in order of m: few, whatever the lengths."""
    shift = max(0, m.bit_length() - 6)
    return (shift << 6) + (m >> shift)


def normaliser(n: int, documents: int, terms: int) -> int:
    return 10 + 90 * n * documents // terms


def deal_blocks(weights: dict[int, int], most: int = BLOCK) -> dict[int, tuple[int, int]]:
    """Length class -> first block and number of blocks.  Light neighbours share a block, heavy classes get several."""
    out, block, held = {}, 0, 0
    for c in sorted(weights):
        if held and held + weights[c] > most:
            block, held = block + 1, 0
        parts = max(1, ceil(weights[c] / most))
        out[c] = (block, parts)
        held += weights[c]
        if parts > 1:
            block, held = block + parts, 0
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(F.col("text")).alias("text"))


def _count_lengths(batches):
    docs, size = Counter(), Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            n = len(terms_of(text))
            docs[n] += 1
            size[n] += len(text)
    keys = list(docs)
    yield pa.RecordBatch.from_pydict({"n": keys, "docs": [docs[n] for n in keys], "bytes": [size[n] for n in keys]},
                                     pa.schema([("n", pa.int64()), ("docs", pa.int64()), ("bytes", pa.int64())]))


def _forward(documents: int, terms: int, blocks: dict[int, tuple[int, int]]):
    """Each document's block, m, distinct terms and their tf."""

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                m = normaliser(len(words), documents, terms)
                first, parts = blocks[length_class(m)]
                part = (((doc_id or 0) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 32 ^ crc32(text)) % parts
                tf = Counter(words)
                out.append((first + part, m, doc_id, b" ".join(tf), np.fromiter(tf.values(), np.int32, len(tf)).tobytes()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "m", "doc_id", "terms", "tf"])

    return run


def _invert(group: pa.Table) -> pa.Table:
    """The index rows of a block."""
    block, ids = group.column("block")[0].as_py(), group.column("doc_id").combine_chunks()
    m = group.column("m").to_numpy()
    order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), m))
    m = m[order]
    texts, counts = group.column("terms").to_pylist(), group.column("tf").to_pylist()
    number: dict[bytes, int] = {}
    term, sizes = [], []
    for i in order:
        words = texts[i].split(b" ")
        sizes.append(len(words))
        term += [number.setdefault(w, len(number)) for w in words]
    term = np.array(term, np.int64)
    tf = np.frombuffer(b"".join(counts[i] for i in order), np.int32)
    doc = np.repeat(np.arange(len(m), dtype=np.int32), sizes)
    names = sorted(number)
    rank = np.empty(len(names), np.int64)
    rank[[number[w] for w in names]] = np.arange(len(names))
    term = rank[term]
    stratum = np.repeat(np.cumsum(np.diff(m, prepend=m[0]) > 0), sizes)
    # Documents ascend, so the stable sort leaves them in order among equal tf.
    place = np.lexsort((-tf, stratum, term))
    df = np.bincount(term, minlength=len(names))
    ends = np.concatenate([[0], np.cumsum(df)]).astype(np.int32)
    rows = pa.table({
        "block": pa.array(np.full(len(names), block, np.int32)), "term": pa.array(names, pa.binary()).cast(pa.string()),
        "df": pa.array(df.astype(np.int32)), "doc": pa.ListArray.from_arrays(ends, doc[place]),
        "tf": pa.ListArray.from_arrays(ends, tf[place]),
        "doc_ids": pa.nulls(len(names), pa.list_(pa.int64())), "m": pa.nulls(len(names), pa.list_(pa.int64()))})
    head = pa.table({
        "block": pa.array([block], pa.int32()), "term": pa.nulls(1, pa.string()), "df": pa.nulls(1, pa.int32()),
        "doc": pa.nulls(1, pa.list_(pa.int32())), "tf": pa.nulls(1, pa.list_(pa.int32())),
        "doc_ids": pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())), "m": pa.array([m], pa.list_(pa.int64()))})
    return pa.concat_tables([head, rows])


class SearchIndex:
    """A written index: ``documents`` and ``terms`` are N and L, ``rows`` the index rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        facts = spark.read.parquet(f"{folder}/facts").first()
        self.documents, self.terms = facts["documents"], facts["terms"]
        self.rows = spark.read.schema(_INDEX).parquet(f"{folder}/postings")

    def document_counts(self, terms: list[str]) -> dict[str, int]:
        """df of the given terms (those of one block of queries)."""
        wanted = self.spark.createDataFrame([(t,) for t in terms], "term string")
        found = self.rows.select("term", "df").join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df"))
        return {r["term"]: r["df"] for r in found.collect()}


def build_index(docs: DataFrame, folder: str, most: int = BLOCK) -> SearchIndex:
    """Index all rows of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs)
    lengths = cut_lineage(texts.select("text").mapInArrow(_count_lengths, _LENGTHS).where("n > 0").groupBy("n").agg(
        F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes")), "lengths")
    facts = lengths.agg(F.sum("docs").alias("documents"), F.sum(F.col("n") * F.col("docs")).cast("bigint").alias("terms")).na.fill(0)
    facts.write.parquet(f"{folder}/facts")
    documents, terms = facts.first()

    def by_class(batches):
        for batch in batches:
            classes = [length_class(normaliser(n, documents, terms)) for n in batch.column("n").to_pylist()]
            weight = batch.column("bytes").to_numpy() + DOC * batch.column("docs").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(weight, pa.int64())], ["class", "weight"])

    # At most 64 classes for each power of two reach the driver.
    found = lengths.mapInArrow(by_class, "class bigint, weight bigint").groupBy("class").agg(F.sum("weight").alias("weight")).collect()
    blocks = deal_blocks({r["class"]: r["weight"] for r in found}, most)
    forward = texts.mapInArrow(_forward(documents, terms, blocks), _FORWARD)
    forward.groupBy("block").applyInArrow(_invert, _INDEX).write.parquet(f"{folder}/postings")
    return SearchIndex(spark, folder)


class _Block:
    """One block's postings of the searched terms, cut into segments (term, stratum)."""

    def __init__(self, doc_ids: list, m: list, terms: list[int], docs: list, tfs: list, total: int):
        self.null = np.array([i is None for i in doc_ids], bool)
        self.ids = np.array([0 if i is None else i for i in doc_ids], np.int64)
        m = np.array(m, np.int64)
        strata = np.cumsum(np.diff(m, prepend=m[0]) > 0)
        self.strata = int(strata[-1]) + 1
        sizes = np.array([len(d) for d in docs], np.int64)
        self.doc = np.concatenate([np.asarray(d, np.int64) for d in docs] or [np.zeros(0, np.int64)])
        tf = np.concatenate([np.asarray(t, np.int64) for t in tfs] or [np.zeros(0, np.int64)])
        term, stratum = np.repeat(np.array(terms, np.int64), sizes), strata[self.doc]
        new = (np.diff(term, prepend=-1) != 0) | (np.diff(stratum, prepend=-1) != 0)
        runs = np.flatnonzero(new | (np.diff(tf, prepend=-1) != 0))
        # One impact for each tf of a segment; tf falls within a segment, so its first impact is its largest.
        once = 1_000_000_000 * tf[runs] // (1000 * tf[runs] + 8 * m[self.doc[runs]])
        self.impact = np.repeat(once, np.diff(runs, append=len(tf)))
        self.start = np.flatnonzero(new)
        self.length = np.diff(self.start, append=len(tf))
        self.stratum, self.most = stratum[self.start], self.impact[self.start]
        # Segments of term t: from[t] to from[t + 1]; terms ascend.
        self.first = np.searchsorted(term[self.start], np.arange(total + 1))

    def best(self, terms: np.ndarray, weights: np.ndarray, top: int, held: tuple) -> tuple:
        """The best of this block and of ``held`` (scores, null ids, ids, best first)."""
        spans = [np.arange(self.first[t], self.first[t + 1]) for t in terms]
        segments = np.concatenate(spans)
        if not len(segments):
            return held
        weight = np.repeat(weights, [len(s) for s in spans])
        stratum = self.stratum[segments]
        bound = np.zeros(self.strata, np.int64)
        np.add.at(bound, stratum, weight * self.most[segments])
        order = np.argsort(-bound, kind="stable")
        place = np.empty(self.strata, np.int64)
        place[order] = np.arange(self.strata)
        place, done, step = place[stratum], 0, 1
        while done < self.strata:
            least = max(1, held[0][-1] if len(held[0]) == top else 1)
            # The next strata by bound; those below the k-th score end the visit (equal scores may win by their id).
            upto = min(done + step, int(np.searchsorted(-bound[order], -least, side="right")))
            if upto <= done:
                break
            pick = np.flatnonzero((place >= done) & (place < upto))
            length = self.length[segments[pick]]
            at = np.repeat(self.start[segments[pick]] - np.cumsum(length) + length, length) + np.arange(length.sum())
            docs, where = np.unique(self.doc[at], return_inverse=True)
            score = np.zeros(len(docs), np.int64)
            np.add.at(score, where, np.repeat(weight[pick], length) * self.impact[at])
            good = np.flatnonzero(score >= least)
            if len(good) > 4 * top:
                # Only the best can stay; what ties with the last of them is kept for the choice by id.
                good = good[score[good] >= np.partition(score[good], len(good) - top)[len(good) - top]]
            merged = [np.concatenate(x) for x in zip(held, (score[good], self.null[docs[good]], self.ids[docs[good]]))]
            keep = np.lexsort((merged[2], merged[1], -merged[0]))[:top]
            held = tuple(x[keep] for x in merged)
            done, step = upto, 2 * step
        return held


def _search(items: list[tuple], weights: dict[str, int], top: int, kind: pa.DataType):
    """Rows (item_id, doc_id, score): the best of a task for each item."""
    number = {t: i for i, t in enumerate(sorted(weights, key=lambda t: t.encode()))}

    def run(batches):
        queries = []
        for item_id, words in items:
            held = sorted(number[w] for w in words if w in number)
            by = {number[w]: weights[w] for w in words if w in number}
            queries.append((item_id, np.array(held, np.int64), np.array([by[t] for t in held], np.int64)))
        empty = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        found = [empty] * len(queries)
        for rows in cell_runs(batches, ["cell", "term", "doc", "tf", "doc_ids", "m"]):
            terms = [number[t] for t in rows["term"][1:]]
            block = _Block(rows["doc_ids"][0], rows["m"][0], terms, rows["doc"][1:], rows["tf"][1:], len(number))
            for i, (_, own, weight) in enumerate(queries):
                if len(own):
                    found[i] = block.best(own, weight, top, found[i])
        for (item_id, _, _), (score, null, ids) in zip(queries, found):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * len(score), kind), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])

    return run


def _query_blocks(items: DataFrame):
    """Lists of (item_id, terms), each of about QUERY_BYTES of text."""
    texts = items.select("item_id", utf8(F.col("text")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / QUERY_BYTES))
    for block in range(blocks):
        held: dict = {}
        for row in texts.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            held.setdefault(row["item_id"], set()).update(t.decode() for t in terms_of(bytes(row["text"])))
        yield list(held.items())


def search(index: SearchIndex, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item (item_id, text)."""
    spark, kind = index.spark, items.schema["item_id"].dataType
    ship(spark)
    schema = f"item_id {kind.simpleString()}, doc_id bigint, score bigint"
    parts = []
    for queries in _query_blocks(items):
        df = index.document_counts(sorted({t for _, words in queries for t in words}))
        weights = {t: w for t, n in df.items() if (w := floor(1000 * log((2 * index.documents + 2) / (2 * n + 1)))) > 0}
        wanted = spark.createDataFrame([(t,) for t in weights], "term string")
        # A block's rows: its documents, then its postings of the searched terms.
        heads = index.rows.where(F.col("term").isNull())
        rows = heads.unionByName(index.rows.join(F.broadcast(wanted), "term", "left_semi"))
        cells = rows.select(F.col("block").alias("cell"), "term", "doc", "tf", "doc_ids", "m").repartition(task_count(spark), "cell")
        parts.append(cells.sortWithinPartitions("cell", "term").mapInArrow(_search(queries, weights, top, to_arrow_type(kind)), schema))
    best = reduce(DataFrame.unionByName, parts)
    by = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    index = build_index(table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/search-index-{uuid.uuid4().hex}")
    return search(index, table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf) AS n FROM p GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n) AS terms FROM d),
s AS (SELECT doc_id, CAST(100 - 90 + (90 * n * docs) // terms AS BIGINT) AS m FROM d, c),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN s USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""
