"""Language-model scores: a class-factored maximum-entropy model mixed with n-grams and skips of word identities.

P(word | before) = sum of g_k(before) P_k(word | before).  P_0 = P(class | three classes before) P(word | class); each other
P_k is the share of the word after one hashed history of words (KINDS), from a table of counts that grows with the training
tokens.  The gates g_k depend on how often and how variously each history was met, and are trained by EM on training tokens
whose own occurrence is taken out of all counts.  The first factor of P_0 is a maximum-entropy model: weights of
hashed n-gram and skip features of the classes before, trained by full gradients that tasks sum over their
share of the corpus.  The second is the word's discounted count.  A word's class comes from its shape (a short word
itself, otherwise its last bytes), and shapes are grouped by the company they keep.  Words never met in training share
what their class's discount leaves over, so the probabilities of all words and of one unknown word per class sum to one.

All counts cover all training texts.  Texts are dealt to blocks of bounded size and split into words once.  From then on a block
is its words' numbers, most frequent word first, which Parquet and shuffles hold as compressed bytes of equal weight.  What a block must
know of the whole corpus it asks of pages: a page adds up what all blocks send of its keys and answers each block in the order
in which that sent them, so keys travel once and no row is written for a key or a token.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from graphloom.llm.common import fold, partition_sums, table, utf8
from graphloom.session import cut_lineage, ship, shuffles_dropped

#: Hashed word shapes, classes of them (number 0 is the end of a text), rows of the weight table.
SHAPES, CLASSES, ROWS = 512, 32, 1 << 14
#: Gradient steps, their size, and pull towards zero; tasks that share the training contexts.
STEPS, RATE, PULL, TASKS = 30, 0.3, 1e-6, 8
#: Bytes of text scored at once, for each kind of key that is then held; words a task collects before it hands them on.
BLOCK_BYTES, HELD = 8 << 20, 1_000_000
#: Tokens for each page of keys; training tokens after one history from which its words are dealt over several pages.
PAGE, HEAVY = 1 << 20, 1 << 19
#: Histories of words, as places before the token: n-grams of two and three words, and a skip.
KINDS = ((1,), (1, 2), (2,))
#: Steps of EM in a block, tokens it works on at a time; bounds of how often a history was met; states of one history and of all.
EM_STEPS, EM_TOKENS, MET = 10, 1 << 15, (3, 10, 100)
STATES = 1 + 2 * (len(MET) + 1)
GATES = STATES ** len(KINDS)


def shape(word: bytes) -> int:
    return 1 + zlib.crc32(word if len(word) <= 3 else b"-" + word[-3:]) % (SHAPES - 1)


class Reader:
    """Turns texts into word numbers, numbering words as they come."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.shapes = np.zeros(0, np.int16)
        self.codes = np.zeros(0, np.uint64)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts with -1 behind each, lengths with that end)."""
        get, parts, sizes = self.number.__getitem__, [], []
        for text in texts:
            words = text.lower().split()
            ids = np.empty(len(words) + 1, np.int32)
            ids[:-1] = np.fromiter(map(get, words), np.int32, len(words))
            ids[-1] = -1
            parts.append(ids)
            sizes.append(len(ids))
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.array(sizes, np.int64)

    def shaped(self, ids: np.ndarray) -> np.ndarray:
        """The shapes of word numbers; an end has shape 0."""
        if len(self.number) > len(self.shapes):
            new = list(self.number)[len(self.shapes):]
            # Words of equal length, up to 4, and last bytes have one shape.
            size = np.fromiter(map(len, new), np.int64, len(new))
            text, end = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(new), np.uint8), np.cumsum(size + 3)
            last = np.minimum(size, 4)
            for back in (3, 2, 1):
                last = last << 8 | text[end - back]
            _, first, of = np.unique(last, return_index=True, return_inverse=True)
            self.shapes = np.concatenate([self.shapes, np.array([shape(new[i]) for i in first], np.int16)[of]])
        return np.append(self.shapes, np.int16(0))[ids]

    def coded(self, ids: np.ndarray) -> np.ndarray:
        """64-bit hashes of word numbers; an end has 1."""
        if len(self.number) > len(self.codes):
            # Here, as the driver needs no pandas.
            from pandas.util import hash_array

            new = np.array([*list(self.number)[len(self.codes):], None], object)[:-1]
            self.codes = np.concatenate([self.codes, hash_array(new, categorize=False)])
        return np.append(self.codes, np.uint64(1))[ids]


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as one compressed cell, as narrow as they fit; bytes of equal weight lie together."""
    columns = [c.astype(f"<u{next(w for w in (1, 2, 4, 8) if not len(c) or int(c.max()) < 1 << 8 * w)}") for c in columns]
    head = np.array([len(columns), *(x for c in columns for x in (c.itemsize, len(c)))], "<u4")
    body = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns)
    return head.tobytes() + (pa.compress(body, "zstd", asbytes=True) if body else b"")


def unpack(cell: bytes) -> list[np.ndarray]:
    """The columns of a packed cell, unsigned."""
    n = int(np.frombuffer(cell, "<u4", 1)[0])
    head = np.frombuffer(cell, "<u4", 2 * n, 4).reshape(-1, 2).tolist()
    size = sum(width * rows for width, rows in head)
    body, at, out = pa.decompress(cell[4 + 8 * n:], size, "zstd", asbytes=True) if size else b"", 0, []
    for width, rows in head:
        planes = np.frombuffer(body, np.uint8, width * rows, at).reshape(width, rows)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
        at += width * rows
    return out


def gaps(x: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers; their running sum gives the numbers back."""
    return np.diff(x, prepend=x.dtype.type(0))


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending values of whole numbers from 0 on, and the place of each number among them."""
    bits = len(x).bit_length()
    top = int(x.max()) if len(x) else 0
    if not len(x) or top.bit_length() + bits > 63:
        return np.unique(x, return_inverse=True)
    if top < 4 * len(x):
        met = np.bincount(x.astype(np.int64)) > 0
        return np.flatnonzero(met).astype(x.dtype), (np.cumsum(met) - 1)[x]
    # Numbers with their places behind them are sorted faster than places are by numbers.
    both = np.sort((x.astype(np.int64) << bits) | np.arange(len(x)))
    at, value = both & ((1 << bits) - 1), both >> bits
    new = np.append(True, value[1:] != value[:-1])
    of = np.empty(len(x), np.int64)
    of[at] = np.cumsum(new) - 1
    return value[new].astype(x.dtype), of


def context(kinds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The three classes before each token as one number; before a text there are ends, class 0."""
    at = np.arange(len(kinds)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    code = np.zeros(len(kinds), np.int64)
    for back in (3, 2, 1):
        before = np.zeros(len(kinds), np.int64)
        before[back:] = kinds[:-back] if len(kinds) > back else kinds[:0]
        before[at < back] = 0
        code = code * CLASSES + before
    return code


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def entries(tokens: list[np.ndarray], words: list[np.ndarray], places: tuple, pages: int, salted: float) -> dict[str, np.ndarray]:
    """The distinct pairs of a history (``places`` before a token; ends before a text) and its token's word in a block.

    before, at: each token's history and pair; word: each pair's word by number; history: each pair's history.  Pairs whose history
    consists of known words are sent by page: place: their places among all pairs; run: where in place another page or history
    begins, and their number; key, page, of, wide: of each run the history by number, its page and place, and whether it is spread over
    pages by its words.  A history of n training occurrences at most is spread over 1 + ``salted`` * n pages.
    """
    ids, sizes, numbers = tokens[0].astype(np.int64), tokens[1].astype(np.int64), np.cumsum(words[0], dtype=np.uint32)
    at, bits, before = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes), len(numbers).bit_length(), 0
    for back in places:
        member = np.zeros(len(ids), np.int64)
        member[back:] = ids[:-back] if len(ids) > back else ids[:0]
        member[at < back] = 0
        before = before << bits | member
    met, before = distinct(before)
    pair, at = distinct(before << bits | ids)
    history, word = pair >> bits, numbers[pair & ((1 << bits) - 1)]
    key, most = np.zeros(len(met), np.uint64), np.full(len(met), np.inf)
    for k in reversed(range(len(places))):
        member = met >> bits * k & ((1 << bits) - 1)
        key = (key << np.uint64(32)) | numbers[member].astype(np.uint64)
        most = np.minimum(most, words[1][member])
    salts, seed = 1 + (most * salted).astype(np.uint64), key * np.uint64(0x9E3779B97F4A7C15)
    kind = np.uint16 if pages <= 1 << 16 else np.uint32
    if (wide := salts > 1).any():
        page = (_mixed(seed[history] + _mixed(word.astype(np.uint64)) % salts[history]) % np.uint64(pages)).astype(kind)
        place = np.flatnonzero(most[history] > 0)
        place = place[np.argsort(page[place], kind="stable")]
        of, page = history[place], page[place]
        run = np.flatnonzero(np.append(True, (np.diff(of) != 0) | (np.diff(page) != 0))[:len(place)])
        of, page = of[run], page[run]
    else:
        page, size = (_mixed(seed) % np.uint64(pages)).astype(kind), np.bincount(history, minlength=len(met))
        of = np.flatnonzero(most > 0)
        of = of[np.argsort(page[of], kind="stable")]
        page, first, size = page[of], (np.cumsum(size) - size)[of], size[of]
        run = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(first - run, size)
    return {"before": before, "at": at, "word": word, "history": history, "place": place, "run": np.append(run, len(place)), "key": key[of],
            "page": page.astype(np.int64), "of": of, "wide": wide[of]}


def features(codes: np.ndarray) -> np.ndarray:
    """Rows of the weight table for contexts: bias, n-grams of 1 to 3 classes, and skips over the nearest ones."""
    c1, c2, c3 = codes % CLASSES, codes // CLASSES % CLASSES, codes // CLASSES**2
    # One tag for each kind of feature.
    kinds = [(0, codes * 0), (1, c1), (2, c1 * CLASSES + c2), (3, codes), (4, c2), (5, c3), (6, c1 * CLASSES + c3)]
    x = np.stack([(np.uint64(tag) << np.uint64(40)) + value.astype(np.uint64) for tag, value in kinds], axis=1)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % ROWS


def log_class(weights: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Natural log of P(class | context), one row for each context."""
    z = weights[features(codes)].sum(axis=1, dtype=float)
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _learnt(row: dict, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.array(row["train"], bool), sizes)


def read_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block of texts: its ids, folds, tokens as places among its words (0 for an end), hashes and shapes of those words."""

    def read(group: pa.Table) -> pa.Table:
        reader = Reader()
        ids, sizes = reader.read(group.column("text").to_pylist())
        every = np.arange(len(reader.number))
        codes, shapes = reader.coded(every), reader.shaped(every)
        order = np.argsort(codes)
        place = np.empty(len(order) + 1, np.uint32)
        place[order], place[-1] = np.arange(1, len(order) + 1), 0
        return pa.table({
            "block": group.column("block")[:1], "doc_id": pa.array([group.column("doc_id").to_pylist()], pa.list_(group.schema.field("doc_id").type)),
            "train": pa.array([group.column("train").to_pylist()], pa.list_(pa.bool_())), "n_tokens": pa.array([len(ids)], pa.int64()),
            "tokens": pa.array([pack(place[ids], sizes.astype("<u4"))], pa.binary()),
            "codes": pa.array([pack(gaps(codes[order]))], pa.binary()), "shapes": pa.array([pack(shapes[order].astype("<u2"))], pa.binary())})

    kind = dict(rows.dtypes)["doc_id"]
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(read, f"block long, doc_id array<{kind}>, train array<boolean>, n_tokens long, tokens binary, codes binary, shapes binary")


def _shapes_learnt(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Shapes of a block's training tokens, and lengths of its training texts."""
    ids, sizes = unpack(row["tokens"])
    shapes = np.append(np.uint16(0), unpack(row["shapes"])[0]).astype(np.int64)
    return shapes[ids[_learnt(row, sizes)]], sizes[np.array(row["train"], bool)].astype(np.int64)


def group_shapes(blocks: DataFrame) -> np.ndarray:
    """The class of each shape: weighted k-means of which shapes come before and after it, over all training texts."""

    def neighbours(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        met = np.zeros(SHAPES**2, np.int64)
        for row in batch.to_pylist():
            s, _ = _shapes_learnt(row)
            met += np.bincount(s[:-1] * SHAPES + s[1:], minlength=SHAPES**2)
        return {0: met.reshape(SHAPES, SHAPES)}

    met = np.zeros((SHAPES, SHAPES))
    for r in partition_sums(blocks.select("train", "tokens", "shapes"), neighbours, SHAPES):
        met[r["row"]] = r["v"]
    often = met.sum(0) + met.sum(1)
    # Square roots of shares: distances between shapes do not hang on a few frequent neighbours.
    x = np.hstack([np.sqrt(m / np.maximum(m.sum(1, keepdims=True), 1)) for m in (met, met.T)])[1:]
    w = often[1:]
    kinds = np.zeros(SHAPES, np.int64)
    k = min(CLASSES - 1, int((w > 0).sum()))
    if not k:
        kinds[1:] = 1
        return kinds
    far, chosen = w.copy(), []
    for _ in range(k):
        chosen.append(int(far.argmax()))
        gap = ((x[:, None, :] - x[chosen][None, :, :][:, -1:, :]) ** 2).sum(2).min(1)
        far = np.minimum(far, w * gap) if len(chosen) > 1 else w * gap
    centres = x[chosen]
    for _ in range(20):
        own = ((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)).argmin(1)
        for j in range(k):
            mine = own == j
            if (w * mine).sum():
                centres[j] = (x * (w * mine)[:, None]).sum(0) / (w * mine).sum()
    kinds[1:] = own + 1
    return kinds


def fit_classes(blocks: DataFrame, kinds: np.ndarray) -> np.ndarray:
    """Weights of the maximum-entropy model, ROWS x CLASSES.

    All training texts are counted once by (context, class), a table bounded by the number of contexts; every step sums
    the gradient over its parts in TASKS tasks and moves the weights on the driver.
    """

    def count(batches):
        total = np.zeros(CLASSES**4, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                s, sizes = _shapes_learnt(row)
                own = kinds[s]
                total += np.bincount(context(own, sizes) * CLASSES + own, minlength=CLASSES**4)
        found = total.reshape(CLASSES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array([pack(n) for n in found], pa.binary())], ["far", "counts"])

    def total_of(group: pa.Table) -> pa.Table:
        n = sum(unpack(x)[0].astype(np.int64) for x in group.column("counts").to_pylist())
        cell = np.flatnonzero(n)
        return pa.table({"cell": pa.array(cell + group.column("far")[0].as_py() * CLASSES**3), "n": pa.array(n[cell])})

    # A row of fixed size for each task and farthest class.
    cells = blocks.select("train", "tokens", "shapes").mapInArrow(count, "far int, counts binary").groupBy("far").applyInArrow(total_of, "cell long, n long")
    cells = cells.withColumn("task", F.pmod(F.xxhash64(F.expr(f"cell div {CLASSES}")), F.lit(TASKS)))

    def bundle(group: pa.Table) -> pa.Table:
        cell, n = group.column("cell").to_numpy(), group.column("n").to_numpy()
        order = np.argsort(cell)
        return pa.table({"n": [int(n.sum())], "cells": pa.array([pack(gaps(cell[order]), n[order])], pa.binary())})

    cells = cut_lineage(cells.repartition(TASKS, "task").groupBy("task").applyInArrow(bundle, "n long, cells binary"), "contexts")
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    weights = np.zeros((ROWS, CLASSES))
    if not total:
        return weights.astype(np.float32)

    def gradient(now: np.ndarray):
        def run(batches):
            for batch in batches:
                for packed in batch.column("cells").to_pylist():
                    gap, n = unpack(packed)
                    cell = np.cumsum(gap.astype(np.int64))
                    codes, at = np.unique(cell // CLASSES, return_inverse=True)
                    hits = np.zeros((len(codes), CLASSES))
                    hits[at, cell % CLASSES] = n
                    logs = log_class(now, codes)
                    miss = np.exp(logs) * hits.sum(1, keepdims=True) - hits
                    out = np.zeros((ROWS, CLASSES))
                    for column in features(codes).T:
                        order = np.argsort(column, kind="stable")
                        rows, first = np.unique(column[order], return_index=True)
                        out[rows] += np.add.reduceat(miss[order], first, axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array([float(-(hits * logs).sum())]), pa.array([(out / total).astype("<f4").tobytes()], pa.binary())], ["loss", "g"])
        return run

    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        # TASKS rows of fixed size.
        parts = cells.select("cells").mapInArrow(gradient(weights.astype(np.float32)), "loss double, g binary").collect()
        g = sum(np.frombuffer(r["g"], "<f4").reshape(ROWS, CLASSES).astype(float) for r in parts) + PULL * weights
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        weights -= RATE * (1 - step / (STEPS + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    discard(cells)
    return weights.astype(np.float32)


def pages_of(codes: np.ndarray, pages: int) -> np.ndarray:
    """The page of a word's hash; pages are ranges of hashes."""
    return ((codes >> np.uint64(32)) * np.uint64(pages)) >> np.uint64(32)


def word_counts(blocks: DataFrame, pages: int) -> DataFrame:
    """key, shape, c: counts of all words of the training texts by their hashes, the end of texts not among them."""

    def added(held: list) -> tuple[np.ndarray, ...]:
        codes, shapes, n = (np.concatenate(x) for x in zip(*held))
        key, first, at = np.unique(codes, return_index=True, return_inverse=True)
        n = np.bincount(at, weights=n).astype(np.int64)
        return key[n > 0], shapes[first][n > 0], n[n > 0]

    def told(held: list) -> pa.RecordBatch:
        columns = added(held)
        page, first = np.unique(pages_of(columns[0], pages), return_index=True)
        cells = [pack(gaps(x), *rest) for x, *rest in zip(*(np.split(x, first[1:]) for x in columns))] if len(page) else []
        return pa.RecordBatch.from_arrays([pa.array(page.astype(np.int64)), pa.array(cells, pa.binary())], ["page", "cell"])

    def count(batches):
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = unpack(row["tokens"])
                codes = np.cumsum(unpack(row["codes"])[0], dtype=np.uint64)
                held.append((codes, unpack(row["shapes"])[0], np.bincount(ids[_learnt(row, sizes)], minlength=len(codes) + 1)[1:]))
                if sum(len(x[0]) for x in held) > HELD:
                    yield told(held)
                    held = []
        if held:
            yield told(held)

    def total(group: pa.Table) -> pa.Table:
        key, shapes, n = added([(np.cumsum(x, dtype=np.uint64), *rest) for x, *rest in map(unpack, group.column("cell").to_pylist())])
        return pa.table({"key": pa.array(key.view(np.int64)), "shape": pa.array(shapes.astype(np.int16)), "c": pa.array(n)})

    return blocks.select("train", "tokens", "codes", "shapes").mapInArrow(count, "page long, cell binary").groupBy("page").applyInArrow(total, "key long, shape short, c long")


def numbered(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, c, number of every word from SHAPES on, the most frequent first; the rows it is read from)."""
    ordered = words.repartitionByRange(F.desc("c"), "key").sortWithinPartitions(F.desc("c"), "key")
    placed = cut_lineage(ordered.select("key", "c", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "placed")
    # A row for each task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + SHAPES).alias("start"))
    return placed.join(F.broadcast(starts), "part").select("key", "c", (F.col("start") + F.col("place")).alias("number")), placed


def number_words(blocks: DataFrame, words: DataFrame, n_docs: int, pages: int) -> DataFrame:
    """The blocks with words as numbers: shapes for unknown words, 0 for an end, which ``n_docs`` training texts have.

    tokens: places among the block's numbers, lengths of texts; words: differences of those numbers, counts, shapes.
    """

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.cumsum(unpack(row["codes"])[0], dtype=np.uint64)
                page, first = np.unique(pages_of(codes, pages), return_index=True)
                cells = [pack(gaps(x)) for x in np.split(codes, first[1:])] if len(codes) else []
                yield pa.RecordBatch.from_arrays([pa.array(page.astype(np.int64)), pa.array([row["block"]] * len(cells), pa.int64()), pa.array(cells, pa.binary())], ["page", "block", "cell"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        key = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        key, c, number = key[order], known.column("c").to_numpy()[order], known.column("number").to_numpy()[order]
        cells = []
        for cell in asked.column("cell").to_pylist():
            codes = np.cumsum(unpack(cell)[0], dtype=np.uint64)
            at = np.minimum(np.searchsorted(key, codes), max(len(key) - 1, 0))
            hit = key[at] == codes if len(key) else np.zeros(len(codes), bool)
            cells.append(pack(*(np.where(hit, x[at], 0).astype(kind) if len(key) else np.zeros(len(codes), kind) for x, kind in ((number, "<u4"), (c, "<u8")))))
        return pa.table({"block": asked.column("block"), "page": asked.column("page"), "cell": pa.array(cells, pa.binary())})

    def renumber(block: pa.Table, told: pa.Table) -> pa.Table:
        row, cells = block.to_pylist()[0], [x["cell"] for x in sorted(told.to_pylist(), key=lambda x: x["page"])]
        ids, sizes = unpack(row["tokens"])
        shapes = np.append(np.uint16(0), unpack(row["shapes"])[0])
        number, c = (np.concatenate(x) for x in zip([np.zeros(1, "<u4"), np.array([n_docs], "<u8")], *map(unpack, cells)))
        number = np.where(number > 0, number, shapes).astype("<u4")
        numbers, first, at = np.unique(number, return_index=True, return_inverse=True)
        return block.select(["block", "doc_id", "train"]).append_column("tokens", pa.array([pack(at.astype("<u4")[ids], sizes)], pa.binary())).append_column(
            "words", pa.array([pack(gaps(numbers), c[first], shapes[first])], pa.binary()))

    known = words.withColumn("page", F.shiftright(F.shiftrightunsigned("key", 32) * pages, 32))
    asked = blocks.select("block", "codes").mapInArrow(ask, "page long, block long, cell binary")
    with shuffles_dropped(blocks.sparkSession):
        told = cut_lineage(asked.groupBy("page").cogroup(known.groupBy("page")).applyInArrow(answer, "block long, page long, cell binary"), "numbers")
        held = blocks.select("block", "doc_id", "train", "tokens", "shapes")
        out = cut_lineage(held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
            renumber, f"block long, doc_id {dict(blocks.dtypes)['doc_id']}, train array<boolean>, tokens binary, words binary"), "blocks")
    discard(told)
    return out


def history_counts(blocks: DataFrame, kind: int, pages: int, salted: float) -> DataFrame:
    """block, kind, page, cell: for the pairs of a block, as ``entries`` orders them, how often training texts hold each, and for
    their histories how often they occur and with how many words.  Spread histories come without block, a part from each page."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens, words = unpack(row["tokens"]), unpack(row["words"])
                e = entries(tokens, words, KINDS[kind], pages, salted)
                met = np.bincount(e["at"][_learnt(row, tokens[1])], minlength=len(e["word"]))[e["place"]].astype("<u4")
                word, size, run = e["word"][e["place"]], np.diff(e["run"]).astype("<u4"), e["run"]
                of, start = np.unique(e["page"], return_index=True)
                cells = []
                for c, d in zip(start, np.append(start[1:], len(e["page"]))):
                    a, b = run[c], run[d]
                    cells.append(pack(gaps(e["key"][c:d]), size[c:d], e["wide"][c:d].astype("u1"), word[a:b], met[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array([row["block"]] * len(cells), pa.int64()), pa.array(cells, pa.binary())], ["page", "block", "cell"])

    def answer(asked: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in asked.column("cell").to_pylist()]
        ends, run_ends = (np.cumsum([0, *(len(p[i]) for p in parts)]) for i in (3, 0))
        size, spread, word, met = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
        known, of = distinct(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]))
        del parts
        bits = int(word.max()).bit_length()
        pair, at = distinct(np.repeat(of, size) << bits | word)
        total = np.bincount(at, weights=met).astype(np.int64)
        pair >>= bits
        often, words = np.bincount(pair, weights=total, minlength=len(known)).astype("<u8"), np.bincount(pair[total > 0], minlength=len(known)).astype("<u8")
        total = total.astype("<u8")
        cells = [pack(total[at[a:b]], often[of[c:d]], words[of[c:d]]) for a, b, c, d in zip(ends, ends[1:], run_ends, run_ends[1:])]
        wide = np.unique(of[spread > 0])
        page = asked.column("page").to_pylist() + [None] * bool(len(wide))
        return pa.table({
            "block": pa.array(asked.column("block").to_pylist() + [None] * bool(len(wide)), pa.int64()), "kind": pa.array([kind] * len(page), pa.int32()),
            "page": pa.array(page, pa.int64()), "cell": pa.array(cells + [pack(known[wide], often[wide], words[wide])] * bool(len(wide)), pa.binary())})

    asked = blocks.select("block", "train", "tokens", "words").mapInArrow(ask, "page long, block long, cell binary")
    with shuffles_dropped(blocks.sparkSession):
        return cut_lineage(asked.groupBy("page").applyInArrow(answer, "block long, kind int, page long, cell binary"), "histories")


def spread_histories(told: DataFrame) -> list[tuple]:
    """For each kind, ascending histories that are spread over pages, how often they occur and with how many words."""
    found = [[(np.zeros(0, "<u8"),) * 3] for _ in KINDS]
    # A history here has HEAVY tokens at least, so there are few.
    for r in told.where("block is null").select("kind", "cell").collect():
        found[r["kind"]].append(unpack(r["cell"]))
    out = []
    for parts in found:
        key, often, words = (np.concatenate(x) for x in zip(*parts))
        key, at = np.unique(key, return_inverse=True)
        out.append((key, np.bincount(at, often, len(key)), np.bincount(at, words, len(key))))
    return out


def met_histories(tokens: list, words: list, told: list[dict], spread: list[tuple], pages: int, salted: float) -> list[dict[str, np.ndarray]]:
    """For each kind: before, at and history of ``entries``, how often each history occurs, with how many words, how often each pair does."""
    out = []
    for kind, places in enumerate(KINDS):
        e = entries(tokens, words, places, pages, salted)
        cells = [unpack(x["cell"]) for x in sorted((x for x in told if x["kind"] == kind), key=lambda x: x["page"])]
        both, often, various = (np.concatenate([np.zeros(0, "<u8"), *x]).astype(float) for x in (zip(*cells) if cells else [()] * 3))
        if e["wide"].any():
            found = np.searchsorted(spread[kind][0], e["key"][e["wide"]])
            often[e["wide"]], various[e["wide"]] = (x[found] for x in spread[kind][1:])
        full = {name: np.zeros(n) for name, n in (("often", int(e["history"][-1]) + 1), ("various", int(e["history"][-1]) + 1), ("both", len(e["word"])))}
        full["often"][e["of"]], full["various"][e["of"]], full["both"][e["place"]] = often, various, both
        out.append({name: e[name] for name in ("before", "at", "history")} | full)
    return out


def discard(*written: DataFrame) -> None:
    """Remove written rows that no later step reads."""
    for df in written:
        spark = df.sparkSession
        for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def state(met: np.ndarray, words: np.ndarray) -> np.ndarray:
    """State of a history met so often with so many words; 0 if it was never met."""
    return np.where(met > 0, 1 + 2 * np.digitize(met, MET) + (2 * words > met), 0)


def open_gates() -> np.ndarray:
    """GATES x models: which have anything to say in a joint state; the class model always does."""
    x = np.arange(GATES)
    return np.stack([x >= 0] + [x // STATES**k % STATES > 0 for k in range(len(KINDS))], axis=1)


def gate_counts(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """GATES x models: tokens that each model is held to have made, by EM over joint states ``x`` and probabilities ``p``."""
    usable = open_gates()
    g, total = usable / usable.sum(1, keepdims=True), np.zeros((GATES, p.shape[1]))
    if not len(x):
        return total
    # States do not depend on each other: a few are worked on at a time, with the tokens of a state side by side.
    order = np.argsort(x.astype(np.uint16), kind="stable")
    ends = np.cumsum(np.bincount(x, minlength=GATES))
    met = np.flatnonzero(np.diff(ends, prepend=0))
    share = ends[met] // EM_TOKENS
    p = [np.ascontiguousarray(w[order]) for w in p.T]
    for few in np.split(met, np.flatnonzero(np.diff(share)) + 1):
        a, b = ends[few[0]] - (n := np.diff(ends, prepend=0)[few])[0], ends[few[-1]]
        first, part, gates = np.cumsum(n) - n, [w[a:b] for w in p], g[few]
        for _ in range(EM_STEPS):
            made = sum(w * np.repeat(gate, n) for w, gate in zip(part, gates.T))
            np.divide(1, made, out=made)
            total[few] = gates * np.stack([np.add.reduceat(w * made, first) for w in part], axis=1)
            gates = np.where(usable[few], total[few] + 0.5, 0)
            gates /= gates.sum(1, keepdims=True)
    return total


def language_scores(docs: DataFrame, train) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``train`` is a column that tells which rows are learnt from.  Null texts are empty and consist of their end; equal texts
    score alike; without training rows no word is known; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", utf8(F.col("text")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    n_docs, n_bytes = rows.agg(F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = -(-n_bytes * (1 + len(KINDS)) // BLOCK_BYTES) or 1
    with shuffles_dropped(docs.sparkSession):
        read = cut_lineage(read_blocks(rows, blocks), "read")
        kinds = group_shapes(read)
        weights = fit_classes(read, kinds)
        n_all = read.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
        pages = 1 + n_all // PAGE
        counts = cut_lineage(word_counts(read, pages), "words")

        # At most SHAPES rows.
        facts = counts.groupBy("shape").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).collect()
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in facts:
        tokens[kinds[r["shape"]]] += r["n"]
        types[kinds[r["shape"]]] += r["v"]
    n1, n2 = sum(r["n1"] for r in facts), sum(r["n2"] for r in facts)
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    n, v = int(tokens.sum()) + n_docs, int(types.sum()) + (n_docs > 0)
    if v + SHAPES >= 1 << 32:
        raise ValueError("words are numbered with 32 bits")
    with np.errstate(divide="ignore", invalid="ignore"):
        unknown = np.where(tokens > 0, np.log(discount * types / tokens), 0.0)
    base = float(np.log10(n + 0.5 * (v + 1)))

    salted = n_all / max(n, 1) / HEAVY
    with shuffles_dropped(docs.sparkSession):
        words, placed = numbered(counts)
    held = number_words(read, words, n_docs, pages)
    discard(read, counts, placed)
    told = reduce(DataFrame.unionByName, [history_counts(held, kind, pages, salted) for kind in range(len(KINDS))])
    spread = spread_histories(told)

    of_context: list[np.ndarray] = []

    def judged(block: pa.Table, answers: pa.Table):
        """A block's row, sizes, counts of its tokens, and a function that gives joint states and probabilities of tokens by each model."""
        row = block.to_pylist()[0]
        of, among = unpack(row["tokens"]), unpack(row["words"])
        ids, sizes = of[0], of[1].astype(np.int64)
        c, own = among[1][ids].astype(float), kinds[among[2]][ids]
        if not of_context:
            # Once in a task: there are CLASSES**3 contexts.
            of_context.append(np.concatenate([log_class(weights, x) for x in np.split(np.arange(CLASSES**3), CLASSES)]))
        of_class = of_context[0][context(own, sizes), own]
        met = met_histories(of, among, answers.select(["kind", "page", "cell"]).to_pylist(), spread, pages, salted)

        def models(off: int, where) -> tuple[np.ndarray, np.ndarray]:
            """Joint states and probabilities; ``off`` 1 takes the token's own occurrence out of the counts."""
            mine, kind = c[where] - off, own[where]
            with np.errstate(divide="ignore", invalid="ignore"):
                word = np.where(mine > 0, np.log(np.maximum(mine - discount, 1e-9) / np.maximum(tokens[kind], 1)), unknown[kind])
            # The end is the only member of its class.
            word[kind == 0] = 0.0
            x, p = np.zeros(len(mine), np.int64), [np.exp(of_class[where] + word)]
            for k, m in enumerate(met):
                often, pairs, before = m["often"] - off, m["both"] - off, m["before"][where]
                x += (STATES**k * state(often, m["various"]))[before]
                if off:
                    # The only token of a pair: without it, the history has a word less.
                    alone = (pairs == 0)[m["at"][where]]
                    x[alone] += (STATES**k * (state(often, m["various"] - 1) - state(often, m["various"])))[before[alone]]
                often = often[m["history"]]
                p.append(np.where(often > 0, np.maximum(pairs, 0) / np.maximum(often, 1), 0.0)[m["at"][where]])
            return x, np.stack(p, axis=1)

        return row, sizes, c, models

    def train_gates(block: pa.Table, answers: pa.Table) -> pa.Table:
        row, sizes, _, models = judged(block, answers)
        learnt = _learnt(row, sizes)
        gates = gate_counts(*models(1, learnt)) if learnt.any() else np.zeros((GATES, len(KINDS) + 1))
        return pa.table({"gates": pa.array([gates.tobytes()], pa.binary())})

    def summed(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        return {0: sum(np.frombuffer(b, float).reshape(GATES, -1) for b in batch.column("gates").to_pylist())}

    met = held.groupBy("block").cogroup(told.where("block is not null").groupBy("block"))
    usable = open_gates()
    g = np.where(usable, 0.5, 0)
    with shuffles_dropped(docs.sparkSession):
        # Written, so that no task needs two Python workers at once.
        gates = cut_lineage(met.applyInArrow(train_gates, "gates binary"), "gates")
        for r in partition_sums(gates, summed, len(KINDS) + 1):
            g[r["row"]] += r["v"]
        discard(gates)
    g /= g.sum(1, keepdims=True)

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        row, sizes, c, models = judged(block, answers)
        x, p = models(0, slice(None))
        first = np.cumsum(sizes) - sizes
        return pa.table({
            "doc_id": block.column("doc_id").combine_chunks().flatten(), "held_out": pa.array(~np.array(row["train"], bool)), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), "train_tokens": pa.array(np.full(len(sizes), n, np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(c + 0.5) - base, first)),
            "score": pa.array(np.add.reduceat(np.log10((g[x] * p).sum(1)), first))})

    kind = dict(docs.dtypes)["doc_id"]
    return met.applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"), fold(F.col("doc_id")) != 1)
