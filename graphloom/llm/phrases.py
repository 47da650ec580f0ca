"""Phrase collocations by dynamic counting: lengths interleave in cyclic scans of shards.

Documents are dealt into SHARDS.  Step i scans shard i mod SHARDS and counts single words in the first cycle, and a longer
phrase from the step after both phrases it is made of (all its words but the last, all but the first) have reached the threshold,
for one full cycle.  So pairs start while words are still being counted, and triples while pairs are.

Counting works on hashes of 44 bits (language and words) and, in the lowest bits, the length.  A hash's page, its highest bits, is
a row that holds sorted hashes (their compressed differences) and counts as bytes: few rows are moved, and a page is merged as arrays by one task.  There
is a page for every PAGE bytes of text.  The tables of a step and the hashes that reached the threshold are bucketed by
page, so adding up the last SHARDS tables moves nothing.  These hold every shard once, so the sum of a phrase over them is a
lower bound of its count, and exact when its cycle ends.

Tasks ask a table of bit masks, one bit per step in which some phrase of a slot reached the threshold, and a second table of
single bits, whether a phrase is due: their size is bounded (SLOTS), and two phrases in one slot of both cost a needless
count, never a missed one.

The hashes only choose what a last scan counts by its words, so results do not depend on them: whatever truly reaches the
threshold is counted there, whole and exactly.

Nulls, ties and odd rows: a null or empty text has no words; a null language is ``und``; equal rows all count, and so do rows
without an id; texts of any length are scanned whole, in chunks that end between pieces; ties are ranked by count and then by phrase in UTF-8 byte order.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from graphloom.llm.common import table, utf8
from graphloom.session import cut_lineage, ship, shared_folder, shuffles_dropped, task_count

#: Longest phrase; count that makes a candidate; longer phrases hide what they hold from this percentage of its count on.
LONGEST, THRESHOLD, HIDE = 3, 10, 50
#: Rows of a language in the result.
TOP = 2000
#: Shards of a cycle; bytes of text counted at a time in a task; slots of the mask tables (2 bytes and 1 byte each).
SHARDS, CHUNK, SLOTS = 2, 12 << 20, 1 << 24
#: Bytes of text for which there is a page of hashes; most pages; slots of the mask tables that travel in one row.
PAGE, MOST_PAGES, _SLICE = 16 << 20, 1 << 20, 1 << 16
#: Phrases that a task hands on at once.
ROWS = 1 << 16
#: Bits of a hash that are kept besides the length.
_KEPT = ~np.uint64((1 << 20) - 1)

#: Ends of pieces and blanks as bytes.
_PIECES = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256))
_COUNTS = "page int, h binary, f binary"
_REACHED = "page int, reached binary, new binary"


def pieces_of(text: bytes) -> list[list[bytes]]:
    """Words of each piece that has any."""
    return [words for words in map(bytes.split, text.lower().translate(_PIECES).split(b"\n")) if words]


def _mix(a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Hash of a phrase and one more word; the lowest four bits hold the length."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) & _KEPT) | np.uint64(length)


def _parts(text: bytes):
    """A text with line ends for the ends of pieces and blanks between words; a very long one in runs that end between pieces."""
    text, at = text.lower().translate(_PIECES), 0
    while len(text) - at > CHUNK:
        end = text.rfind(b"\n", at, at + CHUNK)
        end = end if end >= 0 else text.find(b"\n", at + CHUNK)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:] if at else text


def _numbered(parts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers of some texts, -1 between pieces, and the words."""
    text = b"\n".join(parts).replace(b"\n", b" \n ")
    words = pc.split_pattern(pa.array([text], pa.large_binary()), " ").flatten().dictionary_encode()
    ids, names = words.indices.to_numpy(), words.dictionary.to_pylist()
    # Neither blanks in a row nor the ends of pieces are words.
    number = np.cumsum([name not in (b"", b"\n") for name in names], dtype=np.int32) - np.int32(1)
    real = [name for name in names if name not in (b"", b"\n")]
    ends = np.array([name == b"\n" for name in names], bool)
    ids = ids[np.array([name != b"" for name in names], bool)[ids]]
    ids = np.where(ends[ids], np.int32(-1), number[ids])
    del words
    # Else Arrow keeps the memory of the largest chunk so far.
    pa.default_memory_pool().release_unused()
    return ids, real


def _chunks(batches):
    """Word numbers (-1 between pieces) of one language, about CHUNK bytes of text at a time, and the words: (lang, ids, words)."""
    held: dict[str, tuple[list[bytes], int]] = {}

    def told(lang: str, parts: list[bytes]):
        ids, words = _numbered(parts)
        if words:
            yield lang, ids, words

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            parts, size = held.pop(lang, None) or ([], 0)
            for part in _parts(text):
                parts.append(part)
                size += len(part) + 1
                if size > CHUNK:
                    yield from told(lang, parts)
                    parts, size = [], 0
            held[lang] = (parts, size)
            if sum(x[1] for x in held.values()) > CHUNK:
                most = max(held, key=lambda x: held[x][1])
                yield from told(most, held.pop(most)[0])
    for lang, (parts, _) in held.items():
        yield from told(lang, parts)


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    head = lang.encode() + b"\0"
    out = np.array([xxhash.xxh3_64_intdigest(head + w) for w in words] or [0], np.uint64)
    return (out & _KEPT) | np.uint64(1)


def _phrases(ids: np.ndarray, words: np.ndarray, longest: int, due) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, hashes of the phrases that are counted and the places where they start.

    ``due(hash of all but the last, hash of all but the first)`` tells where a longer phrase is; it gets None for single words.
    """
    inside = ids >= 0
    hashes = np.where(inside, words[ids], np.uint64(0))
    at = np.flatnonzero(inside)
    out = [(hashes[at], at)] if due(None, None) is not None else []
    last = hashes
    for k in range(2, longest + 1):
        # last: hash of the k - 1 words from here, for whole ones.
        whole = inside[k - 1:] & inside[:len(ids) - k + 1]
        for j in range(1, k - 1):
            whole &= inside[j:len(ids) - k + 1 + j]
        at = np.flatnonzero(whole)
        at = at[due(last[at], last[at + 1])]
        longer = np.zeros(len(ids), np.uint64)
        longer[at] = _mix(last[at], hashes[at + k - 1], k)
        out.append((longer[at], at))
        if k < longest:
            all_at = np.flatnonzero(whole)
            longer[all_at] = _mix(last[all_at], hashes[all_at + k - 1], k)
            last = longer
    return out


def _packed(h: np.ndarray) -> bytes:
    """Sorted hashes as compressed differences: all lowest bytes, then all second ones, and so on."""
    steps = np.ascontiguousarray(np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(h).to_bytes(8, "little") + pa.compress(steps, "zstd", asbytes=True) if len(h) else b""


def _unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    size = int.from_bytes(data[:8], "little")
    steps = np.frombuffer(pa.decompress(data[8:], 8 * size, "zstd"), np.uint8).reshape(8, size)
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.uint64).ravel(), dtype=np.uint64)


def _paged(h: np.ndarray, f: np.ndarray, pages: int) -> pa.RecordBatch:
    """Sorted hashes and their counts as a row for each page that has any."""
    page = (h >> np.uint64(44)).astype(np.int64) * pages >> 20
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(page)) + 1, [len(h)]]) if len(h) else np.zeros(1, np.int64)
    rows = [(int(page[x]), _packed(h[x:y]), f[x:y].astype(np.int64).tobytes()) for x, y in zip(cuts[:-1], cuts[1:])]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["page", "h", "f"])


def _added(hashes: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and their summed counts."""
    h = np.concatenate([np.zeros(0, np.uint64), *map(_unpacked, hashes)])
    order = np.argsort(h, kind="stable")
    h, f = h[order], np.frombuffer(b"".join(counts), np.int64)[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(f, first) if len(h) else f


def _merge(group: pa.Table) -> pa.Table:
    """The rows of a page as one."""
    h, f = _added(group.column("h").to_pylist(), group.column("f").to_pylist())
    return pa.table({"page": group.column("page")[:1], "h": pa.array([_packed(h)], pa.binary()), "f": pa.array([f.tobytes()], pa.binary())})


def _reach(threshold: int, tables: int):
    """Hashes of a page that the last tables bring to the threshold: those known before, and the new ones."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                held = [i for i in range(tables) if row[f"h{i}"] is not None]
                h, f = _added([row[f"h{i}"] for i in held], [row[f"f{i}"] for i in held])
                before = _unpacked(row["reached"])
                new = np.setdiff1d(h[f >= threshold], before, assume_unique=True)
                rows.append((row["page"], _packed(np.union1d(before, new)), _packed(new)))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["page", "reached", "new"])

    return run


def _slots(h: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Two slots of a hash, from different bits of it."""
    low = np.uint64(slots - 1)
    return (h >> np.uint64(20)) & low, ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) & low


class _Masks:
    """The mask tables on the driver: bit i of a slot is set if one of its phrases reached the threshold in step i."""

    def __init__(self, spark: SparkSession, slots: int):
        self.spark, self.steps, self.seen, self.held = spark, np.zeros(slots, np.uint16), np.zeros(slots, np.uint8), None

    def add(self, reached: DataFrame, step: int, longest: int) -> bool:
        """Set the bits of ``reached`` (new); whether it holds phrases of fewer words than ``longest``."""
        slots = len(self.steps)
        size = min(_SLICE, slots)

        def sliced(batches):
            bits, shorter = np.zeros((2, slots), bool), False
            for batch in batches:
                for new in batch.column("new").to_pylist():
                    h = _unpacked(new)
                    shorter = shorter or bool(((h & np.uint64(15)) < longest).any())
                    for table, slot in zip(bits, _slots(h, slots)):
                        table[slot] = True
            for which in range(2):
                for k in np.unique(np.flatnonzero(bits[which]) // size).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([which], pa.int32()), pa.array([k], pa.int32()), pa.array([np.packbits(bits[which][k * size:(k + 1) * size]).tobytes()], pa.binary()),
                         pa.array([shorter])], ["which", "slice", "bits", "shorter"])

        def either(group: pa.Table) -> pa.Table:
            whole = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group.column("bits").to_pylist()])
            return pa.table({"which": group.column("which")[:1], "slice": group.column("slice")[:1], "bits": pa.array([whole.tobytes()], pa.binary()),
                             "shorter": pa.array([any(group.column("shorter").to_pylist())])})

        kind = "which int, slice int, bits binary, shorter boolean"
        # At most one row for each slice of the tables.
        found = reached.select("new").mapInArrow(sliced, kind).groupBy("which", "slice").applyInArrow(either, kind).collect()
        for row in found:
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:size]
            at = slice(row["slice"] * size, (row["slice"] + 1) * size)
            if row["which"]:
                self.seen[at] |= bits
            else:
                self.steps[at] |= bits.astype(np.uint16) << np.uint16(step)
        return any(row["shorter"] for row in found)

    def sent(self):
        """The tables as a broadcast of bounded size, packed, for most slots are empty in a small corpus; the one before is dropped."""
        if self.held is not None:
            self.held.destroy()
        self.held = self.spark.sparkContext.broadcast((zlib.compress(self.steps.tobytes(), 1), zlib.compress(self.seen.tobytes(), 1)))
        return self.held


def _asked(masks):
    """A function that gives the bit masks of hashes; 0 for those that never reached the threshold."""
    steps, seen = np.frombuffer(zlib.decompress(masks.value[0]), np.uint16), np.frombuffer(zlib.decompress(masks.value[1]), np.uint8)

    def ask(h: np.ndarray) -> np.ndarray:
        one, two = _slots(h, len(steps))
        return steps[one] * seen[two]

    return ask


def _count_step(masks, window: int, singles: bool, longest: int, pages: int):
    """Counts of the phrases that are due in a step: both halves have reached the threshold, one of them within the window."""

    def run(batches):
        ask = _asked(masks)

        def due(first, second):
            if first is None:
                return True if singles else None
            a, b = ask(first), ask(second)
            return (a != 0) & (b != 0) & ((a | b) & np.uint16(window) != 0)

        for lang, ids, words in _chunks(batches):
            found = [h for h, _ in _phrases(ids, _word_hashes(lang, words), longest, due)]
            yield _paged(*np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True), pages)

    return run


def _count_words(masks, longest: int):
    """(lang, k, phrase, f) of the phrases whose slots have reached the threshold, by their words; and each language's words (k = 0)."""

    def run(batches):
        ask = _asked(masks)
        for lang, ids, words in _chunks(batches):
            names = pa.array(words, pa.binary()).cast(pa.string())
            n = int((ids >= 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([n], pa.int64())], ["lang", "k", "phrase", "f"])
            found = _phrases(ids, _word_hashes(lang, words), longest, lambda a, b: True if a is None else (ask(a) != 0) & (ask(b) != 0))
            for k, (h, at) in enumerate(found, 1):
                at = at[ask(h) != 0]
                # Two phrases of one hash are told apart by their words.
                key = np.zeros(len(at), np.int64)
                for j in range(k):
                    key = np.unique(key * len(words) + ids[at + j], return_inverse=True)[1]
                _, first, f = np.unique(key, return_index=True, return_counts=True)
                parts = [names.take(pa.array(ids[at[first] + j])) for j in range(k)]
                phrase = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
                rows = pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang), len(f)), pa.array(np.full(len(f), k, np.int32)), phrase, pa.array(f.astype(np.int64))],
                    ["lang", "k", "phrase", "f"])
                # In small batches, for the executor holds each batch beside its heap.
                for a in range(0, len(f), ROWS):
                    yield rows.slice(a, ROWS)

    return run


def _bucketed(rows: DataFrame, name: str, folder: str) -> DataFrame:
    """A table in the shared folder, bucketed by page: joining such tables moves nothing.  ``rows`` come dealt by page."""
    spark = rows.sparkSession
    rows.write.bucketBy(task_count(spark), "page").option("path", f"{folder}/{name}").format("parquet").saveAsTable(name)
    return spark.table(name)


def dynamic_counts(texts: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(lang, k, phrase, f): exact counts of all phrases up to ``longest`` words that occur ``threshold`` times in their
    language, and with k = 0 all words of each language.  ``texts``: lang, text (UTF-8 bytes), shard.
    """
    spark = texts.sparkSession
    if shards * longest > 16:
        raise ValueError("at most 16 steps fit the mask table")
    ship(spark)
    run, seen = uuid.uuid4().hex, Observation()
    folder = f"{shared_folder(spark)}/phrases-{run}"
    texts.observe(seen, F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).write.option("compression", "zstd").partitionBy("shard").parquet(f"{folder}/texts")
    texts = spark.read.schema(texts.schema).parquet(f"{folder}/texts")
    pages = max(1, min(MOST_PAGES, -(-seen.get["bytes"] // PAGE)))
    masks, names = _Masks(spark, slots), []

    def table(rows: DataFrame, kind: str) -> DataFrame:
        names.append(f"phrases_{run}_{kind}")
        return _bucketed(rows, names[-1], folder)

    def drop(keep: list[str]) -> None:
        """Remove tables that no later step reads."""
        for name in [n for n in names if n.removeprefix(f"phrases_{run}_") not in keep]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            names.remove(name)

    none = F.lit(b"")
    reached = table(spark.range(pages).select(F.col("id").cast("int").alias("page"), none.alias("reached"), none.alias("new")).repartition(task_count(spark), "page"), "start")
    steps, step, last = [], 0, -1
    while step < shards or step <= last + shards:
        window = sum(1 << r for r in range(max(0, step - shards), step))
        shard = texts.where(F.col("shard") == step % shards).select("lang", "text")
        counts = shard.mapInArrow(_count_step(masks.sent(), window, step < shards, longest, pages), _COUNTS).groupBy("page").applyInArrow(_merge, _COUNTS)
        steps = [*steps, table(counts, f"counts_{step}")][-shards:]
        joined = reached.select("page", "reached")
        for i, counted in enumerate(steps):
            joined = joined.join(counted.select("page", F.col("h").alias(f"h{i}"), F.col("f").alias(f"f{i}")), "page", "left")
        reached = table(joined.mapInArrow(_reach(threshold, len(steps)), _REACHED), f"reached_{step}")
        # The longest phrases activate nothing.
        if masks.add(reached, step, longest):
            last = step
        drop([f"reached_{step}", *[f"counts_{k}" for k in range(step - shards + 2, step + 1)]])
        step += 1
    drop([])
    counted = texts.select("lang", "text").mapInArrow(_count_words(masks.sent(), longest), "lang string, k int, phrase string, f bigint")
    out = cut_lineage(counted.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where((F.col("k") == 0) | (F.col("f") >= threshold)), "phrase-counts")
    return out


def _decimal(name: str):
    return F.col(name).cast("decimal(14,0)")


def cohesion(counts: DataFrame) -> DataFrame:
    """lang, k, phrase, a, l, r, score of phrases of two and more words: the weakest cut, the first among equals."""
    words = counts.where(F.col("k") > 1).select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = words.select("lang", "k", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "k", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    parts = counts.where(F.col("k") > 0)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    product = (_decimal("a") * _decimal("a")) * F.lit(1_000_000).cast("decimal(7,0)")
    scored = cuts.withColumn("__product", product).withColumn("__parts", _decimal("l") * _decimal("r")).withColumn("score", F.expr("__product div __parts"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "k", "a", "l", "r")).alias("b"))
    return best.select("lang", F.col("b.k").alias("k"), "phrase", F.col("b.a").alias("a"), F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def without_hidden(candidates: DataFrame, percent: int = HIDE) -> DataFrame:
    """Candidates that no longer candidate holds in at least ``percent`` of their occurrences."""
    longer = candidates.where(F.col("k") > 2).select("lang", "k", "a", F.split("phrase", " ").alias("w"))
    spans = longer.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select(
        "lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inner = spans.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("__by"))
    most = inner.groupBy("lang", "phrase").agg(F.max("__by").alias("__by"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    hidden = F.col("__by").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
    return joined.where(F.col("__by").isNull() | ~hidden).drop("__by")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language with their rank.

    Rows are sorted as a whole over all tasks and numbered from how many rows of the language earlier tasks hold, so a large
    language is not one task's work.
    """
    order = ["lang", F.col("score").desc(), F.col("a").desc(), "phrase"]
    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    task = F.shiftright("__at", 33)
    starts = placed.groupBy("lang", task.alias("__task")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy("lang").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.withColumn("__before", before).where(F.col("__before") < top).drop("__rows")
    numbered = placed.withColumn("__task", task).join(starts, ["lang", "__task"])
    return numbered.withColumn("rank", F.col("__at") - F.col("__first") + F.col("__before") + 1).where(F.col("rank") <= top).drop("__task", "__at", "__first", "__before")


def collocations(docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, percent: int = HIDE, top: int = TOP, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of ``docs`` (text, lang)."""
    text = utf8(F.col("text"))
    shard = F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"), shard.alias("shard"))
    # Every step ends in files, so the disk holds the shuffle of one step at a time.
    with shuffles_dropped(docs.sparkSession):
        counts = dynamic_counts(texts, longest, threshold, shards, slots)
        best = ranked(without_hidden(cohesion(counts), percent), top)
    n = counts.where(F.col("k") == 0).select("lang", F.col("f").alias("n"))
    best = best.join(n, "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 most cohesive phrases of two and three words in each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
t AS (SELECT lang, piece, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM pieces),
u AS (
    SELECT lang, x, lead(x) OVER piece_order AS y, lead(x, 2) OVER piece_order AS z FROM t WINDOW piece_order AS (PARTITION BY piece ORDER BY i)),
g AS (
    SELECT lang, 1 AS k, x AS phrase, count(*) AS f FROM u GROUP BY ALL
    UNION ALL SELECT lang, 2, x || ' ' || y, count(*) FROM u WHERE y IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z, count(*) FROM u WHERE z IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
cut AS (
    SELECT *, 1 AS i, w[1] AS p, array_to_string(w[2:], ' ') AS q FROM c
    UNION ALL SELECT *, 2, array_to_string(w[:2], ' '), w[3] FROM c WHERE k = 3),
s AS (
    SELECT cut.lang, cut.phrase, cut.k, a, i, x.f AS l, y.f AS r,
           CAST((1000000 * a::HUGEINT * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = p JOIN g y ON y.lang = cut.lang AND y.phrase = q),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_pairs AS (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS b FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
hidden AS (SELECT DISTINCT lang, phrase FROM c JOIN inner_pairs USING (lang, phrase) WHERE 100 * b >= 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, score
FROM best JOIN n USING (lang) ANTI JOIN hidden USING (lang, phrase) QUALIFY rank <= 2000
"""
