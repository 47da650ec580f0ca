"""Writers: every task writes its own part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from graphloom.functions import terms
from graphloom.functions.compare import is_term
from graphloom.functions.terms import DEFAULT_GRAPH, XSD


def _as_term(df: DataFrame, name: str) -> Column:
    """TERM of a result column: typed columns become literals, texts in canonical form are parsed."""
    kind = df.schema[name].dataType
    if is_term(kind):
        return F.col(name)
    if isinstance(kind, T.BooleanType):
        return terms.boolean(name)
    if isinstance(kind, T.IntegralType):
        return terms.integer(name)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return terms.double(name)
    if isinstance(kind, T.DateType):
        return terms.date(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return terms.datetime(name)
    canonical = F.col(name).rlike(r'(?s)^<[^<>]*>$|^_:\S+$|^".*"(@[A-Za-z0-9-]+|\^\^<[^<>]*>)?$')
    return F.when(canonical, terms.parse_term(name)).otherwise(terms.literal(name))


def _columns_as(df: DataFrame, body) -> DataFrame:
    return df.select([terms.let(_as_term(df, c), body).alias(c) for c in df.columns])


def _csv_cell(t: Column) -> Column:
    return F.when(t["kind"] == "bnode", F.concat(F.lit("_:"), t["lex"])).otherwise(t["lex"])


def _tsv_cell(t: Column) -> Column:
    """Numbers and booleans are written bare, everything else in RDF syntax; tabs and line ends are escaped."""
    bare = t["i"].isNotNull() | t["d"].isNotNull() | t["b"].isNotNull()
    text = F.when(bare, t["lex"]).otherwise(terms.canonical(t))
    return F.replace(text, F.lit("\t"), F.lit("\\t"))


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with plain values; unbound is empty."""
    _columns_as(df, _csv_cell).write.csv(path, header=True, compression=compression, escape='"', emptyValue="")


def write_tsv(df: DataFrame, path: str, compression: str = "none") -> None:
    """TSV with RDF syntax; column names carry a question mark."""
    cells = _columns_as(df, _tsv_cell)
    cells = cells.select([F.col(c).alias(f"?{c}") for c in cells.columns])
    cells.write.csv(path, sep="\t", header=True, compression=compression, quote="", emptyValue="")


def bindings(df: DataFrame) -> DataFrame:
    """One JSON object per row: variable -> {"value", "type"[, "datatype"][, "xml:lang"]}; unbound ones are left out."""
    def cell(t: Column) -> Column:
        plain = (t["dt"] == XSD + "string") | t["lang"].isNotNull()
        return F.when(t.isNotNull(), F.struct(
            t["lex"].alias("value"),
            F.when(t["kind"] == "iri", "uri").when(t["kind"] == "bnode", "bnode").otherwise("literal").alias("type"),
            F.when(~plain, t["dt"]).alias("datatype"), t["lang"].alias("xml:lang")))

    row = _columns_as(df, cell)
    return row.select(F.to_json(F.struct(*row.columns)).alias("value"))


def write_bindings(df: DataFrame, path: str, compression: str = "none") -> None:
    bindings(df).write.text(path, compression=compression)


def statement_lines(quads: DataFrame, with_graph: bool | None = None) -> DataFrame:
    """N-Triples or N-Quads lines; quads of the default graph are written without a graph."""
    if with_graph is None:
        with_graph = "g" in quads.columns
    parts = ["s", "p", "o"] + ([F.when(F.col("g") != DEFAULT_GRAPH, F.col("g"))] if with_graph else [])
    return quads.select(F.concat(F.concat_ws(" ", *parts), F.lit(" .")).alias("value"))


def write_ntriples(quads: DataFrame, path: str, compression: str = "none") -> None:
    """N-Triples, which is also valid Turtle; ``compression="gzip"`` for packed part files."""
    statement_lines(quads, with_graph=False).write.text(path, compression=compression)


def write_nquads(quads: DataFrame, path: str, compression: str = "none") -> None:
    statement_lines(quads, with_graph=True).write.text(path, compression=compression)
