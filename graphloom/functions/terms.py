"""RDF terms as Spark columns.

A term travels in two forms: the canonical N-Triples text (the join key, columns ``s p o g``) and the decoded
struct ``TERM`` (column ``o_term``), which typed expressions read.  Both are built from JVM expressions, so a scan that
needs only ``o_term.d`` never formats the text and the other way round.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
WKT = "http://www.opengis.net/ont/geosparql#wktLiteral"
DEFAULT_GRAPH = "<urn:graph:default>"

# The XML Schema types that count as integers, and the other numeric types.
INTEGER_TYPES = [
    "integer", "nonPositiveInteger", "negativeInteger", "long", "int", "short", "byte", "nonNegativeInteger",
    "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte", "positiveInteger",
]
REAL_TYPES = ["decimal", "float", "double"]
TIME_TYPES = ["date", "dateTime", "gYear", "gYearMonth"]

TERM_DDL = (
    "struct<kind:string,lex:string,dt:string,lang:string,i:bigint,d:double,b:boolean,ts:timestamp_ntz>"
)
QUADS_DDL = f"s string, p string, o string, o_term {TERM_DDL}, g string"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, for bodies that use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def make_term(kind, lex, dt=None, lang=None, i=None, d=None, b=None, ts=None) -> Column:
    def field(value, ddl, name):
        value = F.lit(value) if not isinstance(value, Column) else value
        return value.cast(ddl).alias(name)

    return F.struct(
        field(kind, "string", "kind"), field(lex, "string", "lex"), field(dt, "string", "dt"),
        field(lang, "string", "lang"), field(i, "bigint", "i"), field(d, "double", "d"),
        field(b, "boolean", "b"), field(ts, "timestamp_ntz", "ts"),
    )


def _guard(col: Column, term: Column, bound: bool = False) -> Column:
    # Without the guard a field of the struct is just its expression: the optimizer never builds the struct.
    return term if bound else F.when(col.isNotNull(), term)


def iri(col, bound: bool = False) -> Column:
    """IRI term from the bare IRI text (no angle brackets).  ``bound`` says that the column is never NULL."""
    col = _c(col)
    return _guard(col, make_term("iri", col), bound)


def bnode(col, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("bnode", col), bound)


def literal(col, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("lit", col, XSD + "string"), bound)


def lang_literal(col, lang, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("lit", col, LANG_STRING, lang), bound)


def integer(col, bound: bool = False) -> Column:
    col = _c(col).cast("bigint")
    return _guard(col, make_term("lit", col.cast("string"), XSD + "integer", i=col, d=col.cast("double")), bound)


def double(col, bound: bool = False) -> Column:
    col = _c(col).cast("double")
    return _guard(col, make_term("lit", number_text(col), XSD + "double", d=col), bound)


def boolean(col, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("lit", col.cast("string"), XSD + "boolean", b=col), bound)


def datetime(col, bound: bool = False) -> Column:
    col = _c(col).cast("timestamp_ntz")
    text = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    whole = F.date_trunc("second", col) == col
    micros = F.regexp_replace(F.date_format(col, ".SSSSSS"), r"\.?0+$", "")
    lex = F.when(whole, text).otherwise(F.concat(text, micros))
    return _guard(col, make_term("lit", lex, XSD + "dateTime", ts=col), bound)


def date(col, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("lit", F.date_format(col, "yyyy-MM-dd"), XSD + "date", ts=col), bound)


def wkt_literal(col, bound: bool = False) -> Column:
    col = _c(col)
    return _guard(col, make_term("lit", col, WKT), bound)


def number_text(col: Column) -> Column:
    """Text of a double: whole numbers without a fraction, everything else the shortest form."""
    whole = (col == F.floor(col)) & (F.abs(col) < F.lit(1e18))
    return F.when(whole, col.cast("bigint").cast("string")).otherwise(
        F.when(F.isnan(col), F.lit("NaN"))
        .when(col == F.lit(float("inf")), F.lit("INF"))
        .when(col == F.lit(float("-inf")), F.lit("-INF"))
        .otherwise(col.cast("string"))
    )


def escape(col: Column) -> Column:
    """N-Triples escapes; the common text without special characters is passed through untouched."""
    replaced = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    replaced = F.replace(F.replace(replaced, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.when(col.rlike(r'[\\"\n\r]'), replaced).otherwise(col)


def unescape(col: Column) -> Column:
    """Undo N-Triples escapes, including ``\\uXXXX`` and ``\\UXXXXXXXX``."""
    pieces = F.regexp_extract_all(
        col, F.lit(r"(\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|(?s:\\.)|[^\\]+)"), F.lit(1)
    )

    def one(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("\\"), piece)
            .when(piece.startswith("\\u"), F.decode(F.unhex(F.substring(piece, 3, 4)), "UTF-16BE"))
            .when(piece.startswith("\\U"), F.decode(F.unhex(F.substring(piece, 3, 8)), "UTF-32"))
            .when(piece == "\\n", F.lit("\n"))
            .when(piece == "\\r", F.lit("\r"))
            .when(piece == "\\t", F.lit("\t"))
            .when(piece == "\\b", F.lit("\b"))
            .when(piece == "\\f", F.lit("\f"))
            .otherwise(F.substring(piece, 2, 10))
        )

    return F.when(col.contains("\\"), F.array_join(F.transform(pieces, one), "")).otherwise(col)


def canonical(term) -> Column:
    """N-Triples text of a TERM."""
    term = _c(term)
    quoted = F.concat(F.lit('"'), escape(term["lex"]), F.lit('"'))
    return (
        F.when(term["kind"] == "iri", F.concat(F.lit("<"), term["lex"], F.lit(">")))
        .when(term["kind"] == "bnode", F.concat(F.lit("_:"), term["lex"]))
        .when(term["lang"].isNotNull(), F.concat(quoted, F.lit("@"), term["lang"]))
        .when(term["dt"] != XSD + "string", F.concat(quoted, F.lit("^^<"), term["dt"], F.lit(">")))
        .when(term["kind"] == "lit", quoted)
    )


def literal_suffix(text: Column) -> Column:
    """What follows the closing quote of a literal: nothing, a language or a datatype."""
    return F.substring_index(text, '"', -1)


def parse_term(text) -> Column:
    """TERM of a canonical or plain N-Triples text; numbers and dates are decoded and normalised."""
    text = _c(text)
    suffix = literal_suffix(text)
    body = F.substring(text, F.lit(2), F.length(text) - F.length(suffix) - 2)
    lang = F.when(suffix.startswith("@"), F.substring(suffix, 2, 1000))
    dt = F.when(suffix.startswith("^^<"), F.substring(suffix, F.lit(4), F.length(suffix) - 4))
    return _guard(
        text,
        F.when(text.startswith("<"), make_term("iri", F.substring(text, F.lit(2), F.length(text) - 2)))
        .when(text.startswith("_:"), make_term("bnode", F.substring(text, 3, 1 << 30)))
        .when(suffix == "", make_term("lit", unescape(body), XSD + "string"))
        .otherwise(let(F.struct(unescape(body).alias("lex"), dt.alias("dt"), lang.alias("lang")),
                       lambda t: typed_literal(t["lex"], t["dt"], t["lang"]))),
    )


def canonical_text(text) -> Column:
    """Canonical form of a plain N-Triples text.  Only typed literals and escapes are decoded for it."""
    text = _c(text)
    plain = text.startswith("<") | text.startswith("_:") | literal_suffix(text).startswith("@") | text.endswith('"')
    return F.when(plain & ~text.contains("\\"), text).otherwise(let(parse_term(text), canonical))


def _integer_value(lex: Column) -> Column:
    text = F.trim(lex)
    return F.when(text.rlike(r"^[+-]?\d+$"), F.regexp_replace(text, r"^\+", "").try_cast("bigint"))


def _real_value(lex: Column) -> Column:
    text = F.trim(lex)
    return (
        F.when(text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"),
               F.regexp_replace(text, r"^\+", "").try_cast("double"))
        .when(text.isin("INF", "+INF"), F.lit(float("inf")))
        .when(text == "-INF", F.lit(float("-inf")))
        .when(text == "NaN", F.lit(float("nan")))
    )


def _boolean_value(lex: Column) -> Column:
    return F.when(lex.isin("true", "1"), True).when(lex.isin("false", "0"), False)


def literal_of_type(lex: Column, datatype: str) -> Column:
    """Literal TERM of one fixed datatype; the value is decoded where the text allows it."""
    name = datatype.removeprefix(XSD)
    plain = make_term("lit", lex, datatype)
    if name in INTEGER_TYPES:
        return let(_integer_value(lex), lambda i: F.when(
            i.isNotNull(), make_term("lit", i.cast("string"), XSD + "integer", i=i, d=i.cast("double"))).otherwise(plain))
    if name in REAL_TYPES:
        return let(_real_value(lex), lambda d: F.when(
            d.isNotNull(), make_term("lit", number_text(d), XSD + "double", d=d)).otherwise(plain))
    if name == "boolean":
        return let(_boolean_value(lex), lambda b: F.when(
            b.isNotNull(), make_term("lit", b.cast("string"), datatype, b=b)).otherwise(plain))
    if name in TIME_TYPES:
        return make_term("lit", lex, datatype, ts=parse_time(lex))
    return plain


def typed_literal(lex: Column, dt: Column, lang: Column) -> Column:
    """Literal TERM from lexical form, datatype IRI (or NULL) and language (or NULL) that vary by row."""
    def one_of(names):
        return dt.isin([XSD + n for n in names])

    return (
        F.when(lang.isNotNull(), make_term("lit", lex, LANG_STRING, lang))
        .when(one_of(INTEGER_TYPES), literal_of_type(lex, XSD + "integer"))
        .when(one_of(REAL_TYPES), literal_of_type(lex, XSD + "double"))
        .when(dt == XSD + "boolean", literal_of_type(lex, XSD + "boolean"))
        .when(one_of(TIME_TYPES), make_term("lit", lex, dt, ts=parse_time(lex)))
        .otherwise(make_term("lit", lex, F.coalesce(dt, F.lit(XSD + "string"))))
    )


def parse_time(lex: Column) -> Column:
    """UTC instant of an xsd date, dateTime, gYear or gYearMonth text; NULL outside years 0001-9999."""
    padded = (
        F.when(lex.rlike(r"^\d{4}$"), F.concat(lex, F.lit("-01-01T00:00:00")))
        .when(lex.rlike(r"^\d{4}-\d\d$"), F.concat(lex, F.lit("-01T00:00:00")))
        .when(lex.rlike(r"^\d{4}-\d\d-\d\d(Z|[+-]\d\d:\d\d)?$"),
              F.concat(F.substring(lex, 1, 10), F.lit("T00:00:00"), F.substring(lex, 11, 10)))
        .when(lex.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)?$"), lex)
    )
    local = F.regexp_replace(padded, r"(Z|[+-]\d\d:\d\d)$", "").try_cast("timestamp_ntz")
    return local - zone_offset(lex)


def zone_offset(lex: Column) -> Column:
    """The literal's own zone as a day-time interval; zero without a zone."""
    zone = F.regexp_extract(lex, r"(?<=\d)([+-]\d\d:\d\d)$", 1)
    is_zoned = lex.rlike(r"^-?\d+-\d\d-\d\d.*[+-]\d\d:\d\d$")
    minutes = (
        F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 5, 2).try_cast("int")
    ) * F.when(zone.startswith("-"), -1).otherwise(1)
    seconds = F.when(is_zoned, minutes * 60).otherwise(F.lit(0))
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def constant(text: str) -> Column:
    """TERM column of one canonical text, decoded here so that the plan holds plain literals."""
    if text.startswith("<"):
        return make_term("iri", text[1:-1])
    if text.startswith("_:"):
        return make_term("bnode", text[2:])
    end = text.rindex('"')
    lex = re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", _escaped, text[1:end], flags=re.S)
    suffix = text[end + 1:]
    if suffix.startswith("@"):
        return make_term("lit", lex, LANG_STRING, suffix[1:])
    dt = suffix[3:-1] if suffix else XSD + "string"
    name = dt.removeprefix(XSD)
    if name in INTEGER_TYPES:
        return make_term("lit", str(int(lex)), XSD + "integer", i=int(lex), d=float(lex))
    if name in REAL_TYPES:
        return make_term("lit", number_text(F.lit(float(lex))), XSD + "double", d=float(lex))
    if name == "boolean":
        return make_term("lit", "true" if lex in ("true", "1") else "false", dt, b=lex in ("true", "1"))
    if name in TIME_TYPES:
        return make_term("lit", lex, dt, ts=parse_time(F.lit(lex)))
    return make_term("lit", lex, dt)


# The single-letter escapes.
_LETTERS = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def _escaped(match: re.Match) -> str:
    code = match.group(1)
    if code[0] in "uU" and len(code) > 1:
        return chr(int(code[1:], 16))
    return _LETTERS.get(code, code)


# Result types of ``as_type``.
AS_TYPES = ("term", "string", "double", "long", "boolean", "timestamp", "lang")


def typed(term: Column, as_type: str) -> Column:
    """A plain typed column from a TERM; values of another type become NULL."""
    if as_type == "term":
        return term
    if as_type == "string":
        return term["lex"]
    if as_type == "double":
        return term["d"]
    if as_type == "long":
        return term["i"]
    if as_type == "boolean":
        return term["b"]
    if as_type == "timestamp":
        return term["ts"]
    if as_type == "lang":
        return term["lang"]
    raise ValueError(f"as_type must be one of {AS_TYPES}")
