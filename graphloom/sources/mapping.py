"""Relational tables as a graph (direct mapping): one quad per non-null cell, subject = table + key.

A ``MappedGraph`` is virtual.  A pattern with a constant predicate becomes a scan of the key and one column of one
table; a pattern with a free predicate reads each table once and unpivots its rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from graphloom.functions import terms
from graphloom.functions.terms import DEFAULT_GRAPH, RDF_TYPE


@dataclass(frozen=True)
class TableMap:
    """How one table enters the graph.

    ``key`` are the columns naming a row (no two rows share a key); ``refs`` maps a foreign-key column to the table it points at;
    ``lang`` maps a text column to the column holding its language; ``prefix`` is cut off column names.
    """

    name: str
    df: DataFrame
    key: Sequence[str]
    refs: Mapping[str, str] = field(default_factory=dict)
    lang: Mapping[str, str] = field(default_factory=dict)
    prefix: str = ""
    graph: str = DEFAULT_GRAPH
    skip: Sequence[str] = ()

    def subject(self) -> Column:
        return entity(self.name, *self.key)

    def predicate(self, column: str) -> str:
        short = column[len(self.prefix):] if self.prefix and column.startswith(self.prefix) else column
        return f"<{self.name}/{short}>"

    def columns(self) -> dict[str, str]:
        """Predicate -> column."""
        return {self.predicate(c): c for c in self.df.columns if c not in self.skip}

    def term(self, column: str) -> Column:
        """TERM of a column whose NULLs are filtered elsewhere."""
        if column in self.refs:
            return terms.iri(F.concat(F.lit(self.refs[column] + "/"), F.col(column).cast("string")), bound=True)
        if column in self.lang:
            return terms.lang_literal(column, F.col(self.lang[column]), bound=True)
        kind = self.df.schema[column].dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return terms.integer(column, bound=True)
        if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            return terms.double(column, bound=True)
        if isinstance(kind, T.BooleanType):
            return terms.boolean(column, bound=True)
        if isinstance(kind, T.DateType):
            return terms.date(column, bound=True)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return terms.datetime(column, bound=True)
        return terms.literal(F.col(column).cast("string"), bound=True)

    def equals(self, column: str, constant: str) -> Column:
        """Whether a cell is a constant term, as a comparison of the column itself where possible.

        Such a comparison reaches the Parquet scan, one of formatted texts does not.
        """
        kind = self.df.schema[column].dataType
        whole = isinstance(kind, T.IntegralType)
        if column in self.refs:
            head = f"<{self.refs[column]}/"
            if not (constant.startswith(head) and constant.endswith(">")):
                return F.lit(False)
            return _same_key(column, kind, constant[len(head):-1])
        if not constant.startswith('"'):
            # Only references are anything but literals.
            return F.lit(False)
        if whole:
            number = re.fullmatch(rf'"(-?\d+)"\^\^<{re.escape(terms.XSD)}integer>', constant)
            return _same_key(column, kind, number[1]) if number else F.lit(False)
        if isinstance(kind, T.StringType) and column not in self.lang and "\\" not in constant:
            return F.col(column) == F.lit(constant[1:-1]) if re.fullmatch(r'(?s)".*"', constant) else F.lit(False)
        if not isinstance(kind, T.StringType) and not constant.endswith(">"):
            # Literals of other types carry their type.
            return F.lit(False)
        return terms.canonical(self.term(column)) == F.lit(constant)

    def is_subject(self, constant: str) -> Column:
        """Whether a row is a constant entity."""
        head = f"<{self.name}/"
        if not (constant.startswith(head) and constant.endswith(">")):
            return F.lit(False)
        if len(self.key) == 1:
            return _same_key(self.key[0], self.df.schema[self.key[0]].dataType, constant[len(head):-1])
        return self.subject() == F.lit(constant)

    def _cell(self, predicate: str) -> tuple[Column, Column]:
        term = (terms.iri(F.lit(self.name), bound=True) if predicate == RDF_TYPE
                else self.term(self.columns()[predicate]))
        return term, terms.canonical(term)

    def one_predicate(self, predicate: str, s: str | None = None, o: str | None = None) -> DataFrame:
        """Quads of one predicate; ``s`` and ``o`` restrict them to constants."""
        term, text = self._cell(predicate)
        rows = self.df if predicate == RDF_TYPE else self.df.where(F.col(self.columns()[predicate]).isNotNull())
        if s is not None:
            rows = rows.where(self.is_subject(s))
        if o is not None:
            rows = rows.where(text == F.lit(o) if predicate == RDF_TYPE else self.equals(self.columns()[predicate], o))
        return rows.select(
            self.subject().alias("s"), F.lit(predicate).alias("p"), text.alias("o"), term.alias("o_term"),
            F.lit(self.graph).alias("g"),
        )

    def may_hold(self, constant: str) -> bool:
        """Whether a constant can be the name of a row."""
        return constant.startswith(f"<{self.name}/") and constant.endswith(">")

    def unpivot(self, s: str | None = None, o: str | None = None) -> DataFrame:
        """All cells in one pass: rows are multiplied by a cell number, which then picks the cell.

        What a query does not use (the text or the term) is not computed, as every part is an expression of its own.
        A constant subject is a filter on the key; a constant object is a filter on the columns that can hold it, first
        for rows and then for cells.
        """
        predicates = [RDF_TYPE, *self.columns()]
        cells = [self._cell(p) for p in predicates]
        present = [F.lit(True), *[F.col(c).isNotNull() for c in self.columns().values()]]
        rows = self.df if s is None else self.df.where(self.is_subject(s))
        if o is not None:
            present = [F.lit(canonical_iri(self.name) == o), *[self.equals(c, o) for c in self.columns().values()]]
            rows = rows.where(reduce(Column.__or__, present))
        rows = rows.withColumn("__cell", F.explode(F.array(*[F.lit(n) for n in range(len(cells))])))
        present = _pick(present)
        return rows.where(present).select(
            self.subject().alias("s"), _pick([F.lit(p) for p in predicates]).alias("p"),
            _pick([text for _, text in cells]).alias("o"), _pick([term for term, _ in cells]).alias("o_term"),
            F.lit(self.graph).alias("g"))


def canonical_iri(name: str) -> str:
    return f"<{name}>"


def _same_key(column: str, kind: T.DataType, key: str) -> Column:
    """Column equals the value whose text is ``key``."""
    if isinstance(kind, T.IntegralType):
        try:
            value = int(key)
        except ValueError:
            return F.lit(False)
        fits = str(value) == key and -(2 ** 63) <= value < 2 ** 63
        return F.col(column).cast("bigint") == F.lit(value).cast("bigint") if fits else F.lit(False)
    return F.col(column).cast("string") == F.lit(key)


def _pick(options: Sequence[Column]) -> Column:
    out = F.when(F.col("__cell") == 0, options[0])
    for n, option in enumerate(options[1:], 1):
        out = out.when(F.col("__cell") == n, option)
    return out


def entity(table: str, *key: str) -> Column:
    """Canonical IRI text of a row."""
    return F.concat(F.lit(f"<{table}/"), F.concat_ws("-", *[F.col(k).cast("string") for k in key]), F.lit(">"))


def distinct_quads(quads: DataFrame) -> DataFrame:
    """The set of quads.  Only the texts are compared; the decoded object is rebuilt where a query uses it."""
    texts = quads.select("s", "p", "o", "g").dropDuplicates()
    return texts.select("s", "p", "o", terms.parse_term("o").alias("o_term"), "g")


class QuadSource:
    """A graph that is not one DataFrame: it gives the quads that a pattern's constants leave.

    ``only``, ``without`` and ``merged_graphs`` restrict it to graphs, the last one as one default graph.
    """

    def quads(self, predicates: Sequence[str] | None = None, s: str | None = None, o: str | None = None) -> DataFrame:
        raise NotImplementedError

    def only(self, graphs: Sequence[str]) -> "QuadSource":
        raise NotImplementedError

    def without(self, graph: str) -> "QuadSource":
        raise NotImplementedError

    def merged_graphs(self, graphs: Sequence[str]) -> "QuadSource":
        raise NotImplementedError


class MappedGraph(QuadSource):
    """Tables seen as one set of quads; ``merged`` folds their graphs into one default graph."""

    def __init__(self, tables: Iterable[TableMap], merged: bool = False):
        self.tables = list(tables)
        self.merged = merged

    def predicates(self) -> list[str]:
        return [RDF_TYPE, *(p for t in self.tables for p in t.columns())]

    def in_graphs(self, keep: Callable[[str], bool], merged: bool = False) -> "MappedGraph":
        """Only the tables whose graph passes the test; the others are never scanned."""
        return MappedGraph([t for t in self.tables if keep(t.graph)], merged)

    def only(self, graphs: Sequence[str]) -> "MappedGraph":
        return self.in_graphs(lambda g: g in graphs)

    def without(self, graph: str) -> "MappedGraph":
        return self.in_graphs(lambda g: g != graph)

    def merged_graphs(self, graphs: Sequence[str]) -> "MappedGraph":
        return self.in_graphs(lambda g: g in graphs, merged=True)

    def owner(self, predicate: str) -> TableMap | None:
        """The only table with a predicate, if there is just one."""
        found = [t for t in self.tables if predicate in t.columns()]
        return found[0] if len(found) == 1 else None

    def quads(self, predicates: Sequence[str] | None = None, s: str | None = None, o: str | None = None) -> DataFrame:
        """Quads, of the given predicates only; constant subjects and objects become column filters."""
        if predicates is None:
            parts = [t.unpivot(s, o) for t in self.tables if s is None or t.may_hold(s)]
        else:
            parts = [
                t.one_predicate(p, s, o)
                for p in dict.fromkeys(predicates)
                for t in self.tables
                if p == RDF_TYPE or p in t.columns()
            ]
        if not parts:
            return SparkSession.active().createDataFrame([], terms.QUADS_DDL)
        quads = reduce(DataFrame.unionByName, parts)
        if self.merged:
            quads = quads.withColumn("g", F.lit(DEFAULT_GRAPH))
            if len({t.graph for t in self.tables}) > 1:
                quads = distinct_quads(quads)
        return quads
