"""Token-ID files: Parquet with list columns, delta or dictionary encoding, small row groups and page indexes.

Documents are range-partitioned and sorted by id, encoded in Arrow batches and written by Spark's Parquet writer.  Each
row carries its place in its file's stream, so readers seek to single documents, or read lengths without ids.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from graphloom.llm.common import table
from graphloom.session import shared_folder, ship

#: Words in each of the two generations that a worker remembers.
CACHE_WORDS = 600_000
#: Parquet settings: version 2 pages delta-encode what is not dictionary-encoded; page indexes are always written.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(32 << 20), "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#ids.list.element": "false", "compression": "zstd",
}
_LOADED: dict[str, WordEncoder] = {}
#: Characters beyond the plain Latin ones, whose lower case and normal form are one letter each.
_UNUSUAL = re.compile("[\u0130\u0250-\U0010ffff]|<\\|")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write for bytes: printable ones stand for themselves, others follow 255."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_LETTERS = _byte_letters()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts, with the library asked once for each distinct word.

    Exact for tokenizers that drop white space and never join across it: the ids of a text are those of its pieces
    between spaces and line feeds.  For plain Latin texts, case is dropped first (the tokenizer drops it too), words of
    letters go to the library's model as they are, and a full stop or comma behind a letter is a piece of its own.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _ask(self, words: list[str]) -> None:
        known, model, rest = self.known, self.library.model, []
        for word in words:
            if word.isascii() and word.isalpha() or word.isalpha() and not _UNUSUAL.search(word):
                tokens = model.tokenize(word.lower().encode().decode("latin-1").translate(_LETTERS))
                known[word] = array("I", [t.id for t in tokens]).tobytes()
            else:
                rest.append(word)
        for word, found in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            known[word] = array("I", found.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words."""
        known, old, split, ask = self.known, self.old, {}, []
        for word in words:
            ids = old.get(word)
            if ids is not None:
                known[word] = ids
                continue
            apart = word[-1:] in (".", ",") and word[-2:-1].isalpha() and not _UNUSUAL.match(word, len(word) - 2)
            split[word] = core, mark = (word[:-1], word[-1]) if apart else (word, "")
            ask += [part for part in (core, mark) if part not in known]
        if ask:
            self._ask(list(dict.fromkeys(ask)))
        for word, (core, mark) in split.items():
            known[word] = known[core] + known[mark]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not _UNUSUAL.search(text):
            text = text.lower()
        words = text.replace("\n", " ").split(" ")
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                self.old, self.known = known, {"": b""}
                known, new = self.known, [w for w in set(words) if w]
            self._learn(new)
        return b"".join(map(known.__getitem__, words))


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, part, row (place in the part), at (ids of the part before it), n_tokens, ids; rows in order of the id."""
    ship(docs.sparkSession)
    lined = (docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
             .sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id()))

    def run(batches):
        encode, end = encoder(tokenizer).encode, np.uint32(end_id).tobytes()
        row = at = 0
        for batch in batches:
            blobs = [encode(t or "") + end for t in batch.column("text").to_pylist()]
            size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(blobs), "<i4"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"), pa.array(np.arange(row, row + len(blobs))),
                pa.array(at + offsets[:-1].astype(np.int64)), pa.array(size),
                pa.ListArray.from_arrays(pa.array(offsets), ids)], ["doc_id", "part", "row", "at", "n_tokens", "ids"])
            row, at = row + len(blobs), at + int(offsets[-1])

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("part", IntegerType()),
                         *[StructField(c, LongType()) for c in ("row", "at", "n_tokens")], StructField("ids", ArrayType(IntegerType()))])
    return lined.mapInArrow(run, schema)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, **layout: str) -> None:
    """Encode ``doc_id, text`` and write token files below ``folder``.

    A null text is an empty one and gives the end id alone.  Null ids come first; rows of one id are ordered by text.
    An empty table writes files without rows.  Other columns are not read.
    """
    encoded(docs, tokenizer, end_id).write.options(**{**LAYOUT, **layout}).parquet(folder)


def read_tokens(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The files' rows.  Ask for the columns that are needed; filters on doc_id use row-group and page statistics."""
    df = spark.read.parquet(folder)
    return df.select(*columns) if columns else df


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """part, first: the ids in all parts before.  Reads lengths only; one row for each written part."""
    totals = read_tokens(spark, folder, "part", "n_tokens").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("first"))


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, part, at, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            values, to = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(to[:-1], to[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"), batch.column("at"), pa.array(np.diff(to).astype(np.int64)),
                pa.array(crc, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    schema = StructType([tokens.schema[c] for c in ("doc_id", "part", "at", "n_tokens")] + [StructField("ids_crc32", LongType())])
    return tokens.select("doc_id", "part", "at", "n_tokens", "ids").mapInArrow(run, schema)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), folder, default_tokenizer())
    # One row for each part, and parts follow the data: the planner picks the join by size.
    return (digests(read_tokens(spark, folder)).join(starts(spark, folder), "part")
            .select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
