"""Predicates of subjects: has-predicate, autocompletion counts, patterns; dataset statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from graphloom.functions.terms import DEFAULT_GRAPH, RDF_TYPE
from graphloom.operators.scan import as_quads, is_var


def has_predicate(graph, subjects: DataFrame | None = None, predicate: str | None = None) -> DataFrame:
    """Distinct (s, p) pairs; ``subjects`` is a table with a column ``s``, ``predicate`` a constant."""
    quads = as_quads(graph, [predicate] if predicate else None).select("s", "p")
    if subjects is not None:
        quads = quads.join(subjects.select("s"), "s", "left_semi")
    return quads.dropDuplicates()


def available_predicates(graph, subjects: DataFrame | None = None) -> DataFrame:
    """Per predicate the number of distinct entities (of ``subjects``) having it.

    Pairs are made distinct first, so the count by predicate is map-side combined even for a predicate that everybody has.
    """
    return has_predicate(graph, subjects).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


def subject_patterns(graph, subjects: DataFrame | None = None) -> DataFrame:
    """``(s, pattern)``: the sorted set of predicates of each subject; its size is bounded by the vocabulary."""
    return has_predicate(graph, subjects).groupBy("s").agg(F.array_sort(F.collect_list("p")).alias("pattern"))


def pattern_table(patterns: DataFrame) -> DataFrame:
    """``(pattern_id, pattern, n_subjects)``; the id is a hash, so no global numbering is needed."""
    return (
        patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_subjects"))
        .select(F.md5(F.array_join("pattern", "\n")).alias("pattern_id"), "pattern", "n_subjects")
    )


def available_from_patterns(patterns: DataFrame) -> DataFrame:
    """Predicate counts from a stored pattern table: one row per subject instead of one per triple."""
    return (
        patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode("pattern").alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n"))
    )


def pattern_statistics(graph) -> DataFrame:
    """Distinct subject-predicate pairs, average predicates per subject and subjects per predicate."""
    pairs = has_predicate(graph)
    stats = pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("s").alias("n_subjects"),
                      F.count_distinct("p").alias("n_predicates"))
    return stats.select("n_pairs", (F.col("n_pairs") / F.col("n_subjects")).alias("predicates_per_subject"),
                        (F.col("n_pairs") / F.col("n_predicates")).alias("subjects_per_predicate"))


def dataset_statistics(graph) -> DataFrame:
    """One row of counts over all quads."""
    quads = as_quads(graph)
    kind = F.col("o_term.kind")
    # Predicates and graphs are few: their counts come from one small aggregate.  Subjects and objects are made distinct in
    # passes of their own, so no quad is copied for each distinct count.
    groups = quads.groupBy("p", "g").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(kind == "lit", 1)).alias("lit"), F.count(F.when(kind == "iri", 1)).alias("iri"),
        F.count(F.when(kind == "bnode", 1)).alias("bnode"), F.count(F.when(F.col("s").startswith("_:"), 1)).alias("blank"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0))
    totals = groups.agg(
        whole("n").alias("n_triples"), F.count_distinct("p").alias("n_predicates"),
        F.count_distinct(F.when(F.col("g") != DEFAULT_GRAPH, F.col("g"))).alias("n_graphs"),
        whole("lit").alias("n_literal_objects"), whole("iri").alias("n_iri_objects"),
        whole("bnode").alias("n_blank_objects"), whole("blank").alias("n_blank_subjects"))
    subjects = quads.groupBy("s").agg(F.max(F.col("p") == RDF_TYPE).alias("typed")).agg(
        F.count(F.lit(1)).alias("n_subjects"), F.count(F.when(F.col("typed"), 1)).alias("n_typed_subjects"))
    objects = quads.select("o").distinct().agg(F.count(F.lit(1)).alias("n_objects"))
    # One row each.
    return totals.crossJoin(subjects).crossJoin(objects).select(
        "n_triples", "n_subjects", "n_predicates", "n_objects", "n_graphs", "n_typed_subjects", "n_literal_objects",
        "n_iri_objects", "n_blank_objects", "n_blank_subjects")


def top_predicates(graph, n: int = 10) -> DataFrame:
    counts = as_quads(graph).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "p").limit(n)


def predicate_counts(graph, triples: Sequence[Sequence]) -> dict[str, int]:
    """Counts for ordering the joins of ``triples``: of their constant predicates, so as many rows as patterns at most."""
    wanted = sorted({t[1] for t in triples if isinstance(t[1], str) and not is_var(t[1])})
    found = as_quads(graph, wanted).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect() if wanted else []
    return dict.fromkeys(wanted, 0) | {r["p"]: r["n"] for r in found}
