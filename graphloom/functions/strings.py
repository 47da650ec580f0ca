"""String functions on lexical forms (plain string columns) and, where language tags matter, on TERM columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from graphloom.functions.terms import (
    INTEGER_TYPES, LANG_STRING, REAL_TYPES, XSD, _c, let, literal_of_type, make_term, number_text,
)


def _s(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _text(x) -> Column:
    """A pattern argument: a Python string is a constant here."""
    return x if isinstance(x, Column) else F.lit(x)


def str_of(term) -> Column:
    """STR of a TERM: the lexical form."""
    return _c(term)["lex"]


def str_of_double(x) -> Column:
    """STR of a double: whole numbers print without a fraction."""
    return number_text(_s(x).cast("double"))


def make_iri(text, base: str = "") -> Column:
    """IRI(): a relative reference is resolved by putting the base in front."""
    text = _s(text)
    absolute = text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    full = F.when(absolute, text).otherwise(F.concat(F.lit(base), text)) if base else text
    return F.when(text.isNotNull(), make_term("iri", full))


def _plain(term: Column) -> Column:
    return (term["kind"] == "lit") & (term["dt"] == XSD + "string")


def str_lang(term, lang: str | Column) -> Column:
    """STRLANG: only for plain literals; the tag is a constant or a column, and an unbound or empty one gives unbound."""
    term = _c(term)
    tag = F.lower(lang) if isinstance(lang, Column) else F.lit(lang.lower())
    return F.when(_plain(term) & (tag != ""), make_term("lit", term["lex"], LANG_STRING, tag))


# For types that come from a column, the types whose texts are decoded alike.
_DATES = ("date", "dateTime", "gYear", "gYearMonth")


def str_dt(term, datatype: str | Column) -> Column:
    """STRDT: only for plain literals; the value is decoded by its new type, a constant or a column."""
    term = _c(term)
    if not isinstance(datatype, Column):
        return let(term, lambda t: F.when(_plain(t), literal_of_type(t["lex"], datatype)))
    families = [([XSD + n for n in INTEGER_TYPES], XSD + "integer"), ([XSD + n for n in REAL_TYPES], XSD + "double")]
    families += [([XSD + n], XSD + n) for n in ("boolean", *_DATES)]

    def typed_as(t: Column) -> Column:
        plain = make_term("lit", t["lex"], datatype)
        out = F.lit(None)
        for names, one in families:
            value = literal_of_type(t["lex"], one)
            known = F.coalesce(value["i"].cast("string"), value["d"].cast("string"), value["b"].cast("string"), value["ts"].cast("string"))
            out = F.when(datatype.isin(names), F.when(known.isNotNull(), value).otherwise(plain)).otherwise(out)
        return F.when(_plain(t) & datatype.isNotNull(), F.coalesce(out, plain))

    return let(term, typed_as)


def strlen(x) -> Column:
    return F.length(_s(x))


def substr(x, start, length=None) -> Column:
    """SUBSTR: 1-based; a start before the text shortens the length; numbers are rounded, NaN gives ""."""
    x = _s(x)
    start = start if isinstance(start, Column) else F.lit(start)
    begin = F.floor(start + F.lit(0.5)).cast("bigint") - 1
    if length is None:
        wanted = F.length(x).cast("bigint") - begin
        bad = F.isnan(start.cast("double"))
    else:
        length = length if isinstance(length, Column) else F.lit(length)
        wanted = F.floor(length + F.lit(0.5)).cast("bigint")
        bad = F.isnan(start.cast("double")) | F.isnan(length.cast("double"))
    wanted = F.when(begin < 0, wanted + begin).otherwise(wanted)
    begin = F.greatest(begin, F.lit(0))
    # Positions are clipped to the text, so huge numbers cannot overflow an int.
    size = F.length(x).cast("bigint")
    cut = F.substring(x, (F.least(begin, size) + 1).cast("int"), F.least(F.greatest(wanted, F.lit(0)), size).cast("int"))
    return F.when(bad, F.lit("")).otherwise(cut)


def ucase(x) -> Column:
    return F.upper(_s(x))


def lcase(x) -> Column:
    return F.lower(_s(x))


def str_starts(x, part) -> Column:
    return _s(x).startswith(_text(part))


def str_ends(x, part) -> Column:
    return _s(x).endswith(_text(part))


def contains(x, part) -> Column:
    return _s(x).contains(_text(part))


def str_before(x, part) -> Column:
    """STRBEFORE: "" where the part does not occur or is empty."""
    x, part = _s(x), _text(part)
    at = F.position(part, x)
    return F.when(part == "", F.lit("")).when(at > 0, F.substring(x, F.lit(1), at - 1)).when(at == 0, F.lit(""))


def str_after(x, part) -> Column:
    """STRAFTER: "" where the part does not occur, the whole text for an empty part."""
    x, part = _s(x), _text(part)
    at = F.position(part, x)
    rest = F.substring(x, at + F.length(part), F.length(x))
    return F.when(part == "", x).when(at > 0, rest).when(at == 0, F.lit(""))


def _with_text(term: Column, lex: Column) -> Column:
    return make_term("lit", lex, term["dt"], term["lang"])


def _compatible(term: Column, part: Column) -> Column:
    return (term["kind"] == "lit") & (part["kind"] == "lit") & (
        part["lang"].isNull() | part["lang"].eqNullSafe(term["lang"]))


def term_substr(term, start, length=None) -> Column:
    """SUBSTR keeping the language tag."""
    term = _c(term)
    return F.when(term["kind"] == "lit", _with_text(term, substr(term["lex"], start, length)))


def term_str_before(term, part) -> Column:
    """STRBEFORE on literals: keeps the tag of the text, incompatible tags are unbound."""
    term, part = _c(term), _c(part)
    found = part["lex"].eqNullSafe("") | term["lex"].contains(part["lex"])
    kept = _with_text(term, str_before(term["lex"], part["lex"]))
    return F.when(_compatible(term, part), F.when(found, kept).otherwise(make_term("lit", "", XSD + "string")))


def term_str_after(term, part) -> Column:
    term, part = _c(term), _c(part)
    found = part["lex"].eqNullSafe("") | term["lex"].contains(part["lex"])
    kept = _with_text(term, str_after(term["lex"], part["lex"]))
    return F.when(_compatible(term, part), F.when(found, kept).otherwise(make_term("lit", "", XSD + "string")))


def term_ucase(term) -> Column:
    term = _c(term)
    return F.when(term["kind"] == "lit", _with_text(term, F.upper(term["lex"])))


def term_lcase(term) -> Column:
    term = _c(term)
    return F.when(term["kind"] == "lit", _with_text(term, F.lower(term["lex"])))


def concat(*parts) -> Column:
    return F.concat(*[_text(p) for p in parts])


def term_concat(*terms) -> Column:
    """CONCAT on literals: language or datatype is kept only if all parts agree."""
    terms = [_c(t) for t in terms]
    lex = F.concat(*[t["lex"] for t in terms])
    first, same = terms[0], F.lit(True)
    for t in terms[1:]:
        same = same & t["lang"].eqNullSafe(first["lang"]) & (t["dt"] == first["dt"])
    return F.when(lex.isNotNull(), make_term(
        "lit", lex, F.when(same, first["dt"]).otherwise(F.lit(XSD + "string")), F.when(same, first["lang"])))


def _flagged(pattern: str, flags: str) -> str:
    if set(flags) - set("ims"):
        raise ValueError(f"regular expression flags {flags!r} are not supported")
    full = f"(?{flags}){pattern}" if flags else pattern
    try:
        re.compile(full)
    except re.error:
        # Java knows constructs that Python does not; only clear syntax errors are reported early.
        if full.count("(") - full.count("\\(") != full.count(")") - full.count("\\)"):
            raise ValueError(f"invalid regular expression {pattern!r}") from None
    return full


def _pattern(pattern: Column, flags: str | Column) -> Column:
    """A pattern from data; NULL if it, or its flags, are faulty."""
    flags = F.lit(flags) if isinstance(flags, str) else flags
    full = F.when(flags == "", pattern).otherwise(F.concat(F.lit("(?"), flags, F.lit(")"), pattern))
    # The class that Spark itself compiles patterns with tells whether it takes one.
    sound = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), full).isNotNull()
    return F.when(sound & F.regexp_like(flags, F.lit("^[ims]*$")), full)


def regex(x, pattern: str | Column, flags: str | Column = "") -> Column:
    """REGEX: a partial match.  A faulty constant raises; a faulty pattern from a column makes its row unbound."""
    if isinstance(pattern, Column) or isinstance(flags, Column):
        return F.regexp_like(_s(x), _pattern(pattern if isinstance(pattern, Column) else F.lit(pattern), flags))
    return _s(x).rlike(_flagged(pattern, flags))


def replace(x, pattern: str | Column, replacement: str | Column, flags: str | Column = "") -> Column:
    """REPLACE of all matches; ``$1`` stands for a group.  From columns, faulty patterns and groups make their row unbound."""
    if isinstance(pattern, Column) or isinstance(flags, Column) or isinstance(replacement, Column):
        full = _pattern(pattern if isinstance(pattern, Column) else F.lit(pattern), flags)
        new = replacement if isinstance(replacement, Column) else F.lit(replacement)
        # A text without group marks cannot fail; with them a missing group must not end the query.
        plain = F.when(~F.regexp_like(new, F.lit(r"[$\\]")), new)
        grouped = F.try_reflect(F.lit("org.apache.commons.lang3.RegExUtils"), F.lit("replaceAll"), _s(x), full, new)
        return F.when(full.isNotNull() & new.isNotNull() & _s(x).isNotNull(), F.when(plain.isNotNull(), F.regexp_replace(_s(x), full, plain)).otherwise(grouped))
    return F.regexp_replace(_s(x), _flagged(pattern, flags), replacement)


def prefix_match(x, prefix: str) -> Column:
    """A prefix filter; Spark pushes it into the Parquet scan."""
    return _s(x).startswith(prefix)


def encode_for_uri(x) -> Column:
    """Percent-encode everything but unreserved characters (form encoding differs in three places)."""
    out = F.url_encode(_s(x))
    for form, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(wanted))
    return out


def lang(term) -> Column:
    """LANG: "" for literals without a tag."""
    term = _c(term)
    return F.when(term["kind"] == "lit", F.coalesce(term["lang"], F.lit("")))


def lang_matches(tag, wanted: str | Column) -> Column:
    """LANGMATCHES: basic range matching, ``*`` is any tag; the range is a constant or a column."""
    tag = F.lower(_s(tag))
    if isinstance(wanted, Column):
        wanted = F.lower(wanted)
        return F.when(wanted == "*", tag != "").otherwise((tag == wanted) | tag.startswith(F.concat(wanted, F.lit("-"))))
    if wanted == "*":
        return tag != ""
    return (tag == wanted.lower()) | tag.startswith(wanted.lower() + "-")


def datatype(term) -> Column:
    """DATATYPE as an IRI term."""
    term = _c(term)
    return F.when(term["kind"] == "lit", make_term("iri", term["dt"]))


def md5(x) -> Column:
    return F.md5(_s(x))


def sha1(x) -> Column:
    return F.sha1(_s(x))


def sha2(x, bits: int) -> Column:
    """SHA256, SHA384 and SHA512."""
    return F.sha2(_s(x), bits)


def struuid() -> Column:
    return F.expr("uuid()")


def uuid_iri() -> Column:
    return make_term("iri", F.concat(F.lit("urn:uuid:"), F.expr("uuid()")))


def fresh_bnode(*row_key, label: str = "") -> Column:
    """BNODE(): fresh per row.  The key columns name the row, so a repeated task makes the same label."""
    keys = [F.coalesce(_s(k).cast("string"), F.lit("\x01")) for k in row_key]
    return make_term("bnode", F.concat(F.lit("b"), F.md5(F.concat_ws("\x00", F.lit(label), *keys))))


def bnode_of(text, *row_key) -> Column:
    """BNODE(text): the same text in the same row gives the same node, other rows give other nodes."""
    keys = [F.coalesce(_s(k).cast("string"), F.lit("\x01")) for k in row_key]
    text = _s(text)
    return F.when(text.isNotNull(), make_term("bnode", F.concat(F.lit("b"), F.md5(F.concat_ws("\x00", text, *keys)))))
