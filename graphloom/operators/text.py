"""Text search: postings, scores, word, prefix and entity search.

Postings are a DataFrame ``(word, is_entity, record, score)``.  Filters on ``word`` reach the Parquet scan when the
postings are stored by ``write_postings``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from graphloom.functions.terms import _c, let
from graphloom.operators.scan import as_quads
from graphloom.plans.skew import lookup_join
from graphloom.session import Rounds, cut_lineage, task_count

WORDS_DDL = "word string, is_entity int, record bigint, score double"
DOCS_DDL = "record bigint, text string"
HAS_WORD = "<urn:text:has-word>"


def tokens(text) -> Column:
    """Lower-case words: maximal runs of Unicode letters and digits."""
    return F.filter(F.split(F.lower(_c(text)), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Postings from a tab-separated words file: word, entity flag, record, score."""
    rows = spark.read.csv(path, sep="\t", schema=WORDS_DDL, quote="", escape="")
    word = F.when(F.col("is_entity") == 1, F.col("word")).otherwise(F.lower("word"))
    return rows.select(word.alias("word"), (F.col("is_entity") == 1).alias("is_entity"), "record", "score")


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """Texts from a tab-separated documents file: record, text."""
    cells = F.split("value", "\t", 2)
    return spark.read.text(path).select(cells[0].cast("bigint").alias("record"), cells[1].alias("text"))


def term_counts(docs: DataFrame, record: str = "record", text: str = "text") -> DataFrame:
    """``(record, word, tf)``; the texts move once, by record, and no word gathers its records in one task."""
    rows = _by_record(docs, record, text).select("record", _each(word_counts(tokens("text"))).alias("c")).where("c is not null")
    return rows.groupBy("record", F.col("c.word").alias("word")).agg(F.sum("c.tf").alias("tf"))


def word_counts(words: Column) -> Column:
    """``array<struct<word, tf>>`` of an array of words: each word once, counted in its own row without a shuffle."""
    def of_sorted(w: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        return let(starts, lambda s: F.zip_with(s, F.concat(F.slice(s, 2, F.size(s)), F.array(F.size(w))), lambda i, k: F.struct(
            F.get(w, i).alias("word"), (k - i).cast("bigint").alias("tf"))))

    return let(F.sort_array(words), lambda w: F.when(F.size(w) > 0, of_sorted(w)))


def _by_record(docs: DataFrame, record: str, text: str) -> DataFrame:
    """Texts dealt by record: counts of a record, also of one with several texts, then need no further shuffle."""
    return docs.select(F.col(record).alias("record"), F.col(text).alias("text")).repartition(task_count(docs.sparkSession), "record")


def _each(words: Column) -> Column:
    # For plain ``explode`` Spark infers a filter on the array and so computes the tokens twice.
    return F.explode_outer(words)


def build_postings(docs: DataFrame, record: str = "record", text: str = "text", entity: str | None = None) -> DataFrame:
    """Postings from texts: one row per record and word, score = number of occurrences.

    ``entity`` names a column with the entity of each record (for literals: the literal itself).
    """
    words = term_counts(docs, record, text).select(
        "word", F.lit(False).alias("is_entity"), "record", F.col("tf").cast("double").alias("score"))
    if entity is None:
        return words
    mentions = docs.select(F.col(entity).alias("word"), F.lit(True).alias("is_entity"),
                           F.col(record).cast("bigint").alias("record"), F.lit(0.0).alias("score"))
    return words.unionByName(mentions)


def literal_records(graph, predicates: Sequence[str] | None = None) -> DataFrame:
    """Every distinct literal as a text record ``(record, text, entity)``.

    The record id is a 64-bit hash of the literal, so it needs no global numbering.
    """
    quads = as_quads(graph, predicates).where(F.col("o_term.kind") == "lit")
    rows = quads.select(F.col("o").alias("entity"), F.col("o_term.lex").alias("text")).dropDuplicates(["entity"])
    return rows.select(F.xxhash64("entity").alias("record"), "text", "entity")


def write_postings(postings: DataFrame, path: str) -> None:
    """Store postings so that word and prefix searches read few row groups; a frequent word spans many files."""
    (postings.repartitionByRange("word", "record").sortWithinPartitions("word", "record").write.parquet(path))


@dataclass(frozen=True)
class Scoring:
    """How postings are scored: "explicit", "tfidf" or "bm25"."""

    mode: str = "explicit"
    b: float = 0.75
    k: float = 1.75

    def __post_init__(self):
        if self.mode not in ("explicit", "tfidf", "bm25"):
            raise ValueError("scoring is explicit, tfidf or bm25")
        if not 0 <= self.b <= 1 or self.k < 0:
            raise ValueError("BM25 needs 0 <= b <= 1 and k >= 0")


def _score(scoring: Scoring) -> Column:
    idf = F.log2(F.col("n_docs") / F.col("df"))
    if scoring.mode == "tfidf":
        return F.col("tf") * idf
    length = 1 - scoring.b + scoring.b * (F.col("dl") / F.col("avdl"))
    return F.col("tf") * (scoring.k + 1) / (scoring.k * length + F.col("tf")) * idf


def scored_postings(docs: DataFrame, scoring: Scoring, words: Sequence[str] | None = None,
                    record: str = "record", text: str = "text", only: DataFrame | None = None) -> DataFrame:
    """``(record, word, tf, score)`` of the texts themselves as records.

    With ``words`` (or ``only``, a table of words) only those words are counted, the document statistics still cover all texts.
    """
    # The size of the token array travels along, so document lengths need no join.
    sizes = lambda df: df.withColumn("dl", F.size("t"))
    lengths = sizes(docs.select(tokens(text).alias("t"))).agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avdl"))
    split = sizes(_by_record(docs, record, text).select("record", tokens("text").alias("t")))
    if words is not None:
        split = split.withColumn("t", F.filter("t", lambda w: w.isin(list(words))))
    rows = split.select("record", "dl", _each(word_counts(F.col("t"))).alias("c")).where("c is not null")
    counts = rows.groupBy("record", F.col("c.word").alias("word")).agg(F.sum("c.tf").alias("tf"), F.max("dl").alias("dl"))
    if only is not None:
        counts = counts.join(only.select("word"), "word", "left_semi").select(counts.columns)
    if scoring.mode == "explicit":
        return counts.select("record", "word", "tf", F.col("tf").cast("double").alias("score"))
    # The texts are tokenized once; the joins below read the counts several times.
    counts = cut_lineage(counts, "word-counts")
    frequency = cut_lineage(counts.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "word-frequency")
    joined = lookup_join(counts, frequency, "word", F.col("df"))
    # ``lengths`` is a single row.
    return joined.crossJoin(F.broadcast(lengths)).select("record", "word", "tf", _score(scoring).alias("score"))


def score_postings(postings: DataFrame, docs: DataFrame, scoring: Scoring) -> DataFrame:
    """Scores for given postings, whose records point to the next document id at or after them.

    A word that does not occur in that document scores 0; entity mentions keep their own score.
    """
    if scoring.mode == "explicit":
        return postings
    owners = next_at_or_after(postings.select("record"), docs.select("record"))
    given = postings.where(~F.col("is_entity"))
    scores = scored_postings(docs, scoring, only=given.select("word").distinct()).select(F.col("record").alias("doc"), "word", F.col("score").alias("__s"))
    words = given.join(owners, "record").join(scores, ["doc", "word"], "left")
    words = words.select("word", "is_entity", "record", F.coalesce("__s", F.lit(0.0)).alias("score"))
    return words.unionByName(postings.where("is_entity").select("word", "is_entity", "record", "score"))


LEVEL_BITS = 16


def next_at_or_after(records: DataFrame, docs: DataFrame) -> DataFrame:
    """``(record, doc)``: the smallest document id that is at least the record id.

    Ids fall into blocks of 2^16.  A record finds its document inside its own block, and otherwise in the next
    non-empty block, which is found the same way among block numbers.  Four levels cover 64-bit ids, and no group ever
    holds more than 2^16 distinct ids of each side.  Later levels run only while records are left.
    """
    rounds = Rounds(records.sparkSession, "next-doc")
    wanted = records.select(F.col("record").alias("key"), "record").where("record is not null").dropDuplicates()
    have = docs.select(F.col("record").alias("key"), F.col("record").alias("doc")).where("key is not null")
    # Records beyond the last document have no answer.
    last = have.agg(F.max("doc").alias("last")).first()["last"]
    wanted = wanted.where(F.col("record") <= F.lit(last))
    for level in range(64 // LEVEL_BITS):
        have = have.groupBy("key").agg(F.min("doc").alias("doc"))
        points = have.unionByName(wanted.select("key"), allowMissingColumns=True).groupBy("key").agg(
            F.min("doc").alias("doc"))
        # What is left of 64 bits at the last level are at most 2^16 keys, which form one group (with both signs).
        last_level = level == 64 // LEVEL_BITS - 1
        group = F.lit(0) if last_level else F.shiftright("key", LEVEL_BITS)
        # From the highest key down, so that the frame only grows: one that shrinks is read anew for each row.
        order = Window.partitionBy(group).orderBy(F.desc("key"))
        # A block number above the first level must lie strictly ahead.
        ahead = order.rowsBetween(Window.unboundedPreceding, -min(level, 1))
        nearest = points.select("key", F.last("doc", ignorenulls=True).over(ahead).alias("doc"))
        hits, _ = rounds.add(wanted.join(nearest, "key").select("key", "record", "doc"))
        left = hits.where("doc is null")
        if left.isEmpty():
            break
        wanted = left.select(F.shiftright("key", LEVEL_BITS).alias("key"), "record")
        have = have.select(F.shiftright("key", LEVEL_BITS).alias("key"), "doc")
    return rounds.all().where("doc is not null").select("record", "doc")


def text_of_record(records: DataFrame, docs: DataFrame) -> DataFrame:
    """``(record, text)`` by the same rule."""
    owners = next_at_or_after(records, docs)
    return owners.join(docs.select(F.col("record").alias("doc"), "text"), "doc").select("record", "text")


def word_search(postings: DataFrame, word: str, text: str = "text", score: str | None = None) -> DataFrame:
    """Records that hold a word; ``w*`` is a prefix search with one row per matching word."""
    _need_word(word)
    rows = postings.where(~F.col("is_entity"))
    lowered = word.lower()
    columns = [F.col("record").alias(text)]
    if word.endswith("*"):
        prefix = lowered[:-1]
        rows = rows.where(F.col("word").startswith(prefix))
        columns.append(F.col("word").alias(f"match_{text}_{prefix}"))
    else:
        rows = rows.where(F.col("word") == lowered)
    if score:
        columns.append(F.col("score").alias(score))
    return rows.select(*columns)


def entity_search(postings: DataFrame, words: str, text: str = "text", entity: str = "entity",
                  fixed: str | None = None, score: str | None = None) -> DataFrame:
    """Records that hold the words and an entity: one row per mention."""
    hits = multi_word_search(postings, words, text)
    mentions = postings.where("is_entity")
    if fixed is not None:
        mentions = mentions.where(F.col("word") == fixed)
    columns = [F.col("record").alias(text)]
    if fixed is None:
        columns.append(F.col("word").alias(entity))
    if score:
        columns.append(F.col("score").alias(score))
    return hits.join(mentions.select(*columns), text)


def multi_word_search(postings: DataFrame, words: str, text: str = "text", scores: bool = False) -> DataFrame:
    """Records that hold every one of several words or prefixes, given as one blank-separated text."""
    parts = words.split()
    if not parts:
        raise ValueError("a text search needs at least one word")
    result = None
    for n, word in enumerate(parts):
        hits = word_search(postings, word, text, f"score_{n}" if scores else None)
        result = hits if result is None else result.join(hits, text)
    return result


def _need_word(word) -> None:
    if not isinstance(word, str) or not word.strip() or word.strip() == "*":
        raise ValueError("a text search needs a non-empty word")


@dataclass(frozen=True)
class SearchConfig:
    """One text-search clause: exactly one of word and entity, on one text variable."""

    text: str
    word: str | None = None
    entity: str | None = None
    score: str | None = None

    def __post_init__(self):
        if not self.text:
            raise ValueError("a text search needs a text variable")
        if (self.word is None) == (self.entity is None):
            raise ValueError("a text search takes a word or an entity, not both")
        if self.word is not None:
            _need_word(self.word)


def text_search(postings: DataFrame, configs: Sequence[SearchConfig]) -> DataFrame:
    """Join of several clauses; an entity clause needs a word clause on the same text variable.

    ``entity`` is a variable ``?e`` or a fixed term.
    """
    result = None
    for config in sorted(configs, key=lambda c: c.word is None):
        if config.word is not None:
            hits = word_search(postings, config.word, config.text, config.score)
        else:
            if not any(c.text == config.text and c.word is not None for c in configs):
                raise ValueError(f"entity search on {config.text} needs a word on the same text")
            hits = _mentions(postings, config)
        on = [] if result is None else [c for c in result.columns if c in hits.columns]
        if result is None:
            result = hits
        else:
            result = result.join(hits, on) if on else result.crossJoin(hits)
    return result


def _mentions(postings: DataFrame, config: SearchConfig) -> DataFrame:
    rows = postings.where("is_entity")
    columns = [F.col("record").alias(config.text)]
    if config.entity.startswith("?"):
        columns.append(F.col("word").alias(config.entity[1:]))
    else:
        rows = rows.where(F.col("word") == config.entity)
    if config.score:
        columns.append(F.col("score").alias(config.score))
    return rows.select(*columns)


def text_limit(df: DataFrame, n: int, entities: Sequence[str], text: str, scores: Sequence[str]) -> DataFrame:
    """Per entity keep all rows of the ``n`` best records by summed score, ties to the higher record.

    Ranking runs over distinct (entity, record) pairs and ``rank <= n`` becomes a per-task limit before the shuffle,
    so an entity with very many records never gathers in one task.
    """
    summed = sum((F.col(s) for s in scores), F.lit(0))
    # The rows of one record share their score in a word search; otherwise the best row speaks for the record.
    pairs = df.groupBy(*entities, text).agg(F.max(summed).alias("__s"))
    best = Window.partitionBy(*entities).orderBy(F.desc("__s"), F.desc(text))
    kept = pairs.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= n)
    return df.join(kept.select(*entities, text), [*entities, text], "left_semi").select(df.columns)


def has_word_quads(graph, predicates: Sequence[str] | None = None, predicate: str = HAS_WORD) -> DataFrame:
    """Triples (literal, has-word, word)."""
    rows = as_quads(graph, predicates).where(F.col("o_term.kind") == "lit")
    words = rows.select(F.col("o").alias("s"), _each(F.array_distinct(tokens(F.col("o_term.lex")))).alias("w"))
    return words.where("w is not null").select("s", F.lit(predicate).alias("p"), F.concat(F.lit('"'), F.col("w"), F.lit('"')).alias("o")).dropDuplicates()
