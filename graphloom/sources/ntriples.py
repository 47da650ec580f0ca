"""N-Triples and N-Quads as a distributed line reader.

Lines are split across tasks by Spark; parsing is JVM expressions.  Lines that are not valid go to a table of rejects
with a reason, nothing is dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.functions import terms
from graphloom.functions.terms import DEFAULT_GRAPH
from graphloom.sources.mapping import distinct_quads

_IRI = r'<[^<>"{}|^`\\\x00-\x20]*>'
_NODE = rf"{_IRI}|_:[^\s<>\"]+"
# The literal part is greedy up to the last quote; ``_problem`` rejects lines where that was not its end.
_LINE = (
    rf'(?s)^\s*({_NODE})\s*({_IRI})\s*({_NODE}|"(.*)"(@[A-Za-z]+(?:-[A-Za-z0-9]+)*|\^\^{_IRI})?)'
    rf"\s*({_NODE})?\s*\.\s*(?:#.*)?$"
)


@dataclass(frozen=True)
class Input:
    """One input: path or paths, the graph of triples without one, and a prefix that keeps its blank nodes apart."""

    path: str | Sequence[str]
    default_graph: str = DEFAULT_GRAPH
    blank_prefix: str = ""


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path if isinstance(path, str) else list(path)).select("value")


# Splits a matched line into its parts.  A line that holds it itself is taken apart group by group instead.
_MARK = "\x01"


def parse_lines(lines: DataFrame, default_graph: str = DEFAULT_GRAPH, blank_prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """``(quads, rejects)`` of a DataFrame with a column ``value``.

    One pattern match splits a line into its parts; a line that does not match stays in one piece.
    """
    rows = lines.where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    parts = F.split(F.regexp_replace("value", _LINE, f"$1{_MARK}$2{_MARK}$3{_MARK}$6"), _MARK)
    groups = F.when(F.col("value").rlike(_LINE), F.array(*[F.regexp_extract("value", _LINE, n) for n in (1, 2, 3, 6)]))
    parts = F.when(F.col("value").contains(_MARK), F.coalesce(groups, F.array("value"))).otherwise(parts)
    split = rows.select("value", F.inline(F.array(terms.let(parts, lambda m: F.struct(
        F.get(m, F.lit(0)).alias("s"), F.get(m, F.lit(1)).alias("p"), F.get(m, F.lit(2)).alias("o"),
        F.get(m, F.lit(3)).alias("g"), F.size(m).alias("n"))))))
    checked = split.withColumn("reason", _problem())
    rejects = checked.where("reason is not null").select("value", "reason")
    good = checked.where("reason is null")
    blank = lambda c: _own_blank(F.col(c), blank_prefix)
    quads = good.select(
        blank("s").alias("s"), "p", terms.canonical_text(blank("o")).alias("o"),
        F.when(F.col("g") == "", default_graph).otherwise(blank("g")).alias("g"))
    return quads, rejects


def _own_blank(col: Column, prefix: str) -> Column:
    if not prefix:
        return col
    return F.when(col.startswith("_:"), F.concat(F.lit(f"_:{prefix}"), F.substring(col, 3, 1 << 30))).otherwise(col)


def _problem() -> Column:
    literal = F.col("o")
    n_quotes = F.length(literal) - F.length(F.replace(literal, F.lit('"'), F.lit("")))
    inner = F.regexp_extract(literal, r'(?s)^"(.*)"[^"]*$', 1)
    unescaped_quote = (n_quotes > 2) & F.regexp_replace(inner, r"(?s)\\.", "").contains('"')
    return (
        F.when((F.col("n") != 4) & F.col("value").rlike(r"^\s*<<|>\s*<<"), F.lit("RDF* is not supported"))
        .when(F.col("n") != 4, F.lit("not a valid statement"))
        .when(unescaped_quote, F.lit("not a valid literal"))
    )


def read_quads_text(spark: SparkSession, inputs: Sequence[Input] | Input | str, distinct: bool = True) -> tuple[DataFrame, DataFrame]:
    """Quads and rejects of one or several inputs, each with its own default graph; a quad set by default."""
    if isinstance(inputs, str):
        inputs = Input(inputs)
    inputs = [inputs] if isinstance(inputs, Input) else list(inputs)
    parsed = [parse_lines(read_lines(spark, i.path), i.default_graph, i.blank_prefix) for i in inputs]
    quads = reduce(DataFrame.unionByName, [q for q, _ in parsed])
    rejects = reduce(DataFrame.unionByName, [r for _, r in parsed])
    if distinct:
        quads = quads.dropDuplicates()
    return quads.select("s", "p", "o", terms.parse_term("o").alias("o_term"), "g"), rejects


def _present(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def load_document(spark: SparkSession, path: str, graph: str = DEFAULT_GRAPH, silent: bool = False) -> DataFrame:
    """LOAD: the triples of a document, all put into ``graph``.

    A missing document or an invalid line raises; ``silent`` gives no triples instead.
    """
    empty = spark.createDataFrame([], terms.QUADS_DDL)
    try:
        if not _present(spark, path):
            raise FileNotFoundError(path)
        quads, rejects = read_quads_text(spark, Input(path))
        if not rejects.isEmpty():
            raise ValueError(f"{path} holds invalid lines, for example {rejects.first()['value']!r}")
    except (FileNotFoundError, ValueError):
        if silent:
            return empty
        raise
    return distinct_quads(quads.withColumn("g", F.lit(graph)))
