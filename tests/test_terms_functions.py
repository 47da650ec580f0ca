"""Terms, comparisons, aggregates and scalar functions on single values."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions import casts, compare, dates, geo, logic, numeric as n, strings as st, terms
from graphloom.operators import aggregates as a

XSD = "^^<http://www.w3.org/2001/XMLSchema#"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, want", [
    ("<http://x/y>", "<http://x/y>"), ("_:b1", "_:b1"), ('"a"', '"a"'), ('"a"@en', '"a"@en'),
    (f'"+05"{XSD}int>', f'"5"{XSD}integer>'), (f'"22.30"{XSD}float>', f'"22.3"{XSD}double>'),
    (f'"3.0"{XSD}decimal>', f'"3"{XSD}double>'), (f'"1"{XSD}boolean>', f'"true"{XSD}boolean>'),
    (f'"x"{XSD}string>', '"x"'), (r'"q\"\\\né\U0001F600"', '"q\\"\\\\\\né😀"'), (f'"bad"{XSD}int>', f'"bad"{XSD}int>' ),
    (f'"INF"{XSD}double>', f'"INF"{XSD}double>'), (r'"a\\u0041"', r'"a\\u0041"'), ('""', '""'), ('"a \\" b"@de', '"a \\" b"@de'),
])
def test_canonical_text(spark, text, want):
    got = one(spark, terms.canonical_text(F.lit(text)))
    if text == f'"bad"{XSD}int>':
        assert got.startswith('"bad"^^<')
    else:
        assert got == want
        assert one(spark, terms.canonical(terms.constant(text))) == want


def test_term_values(spark):
    t = one(spark, terms.parse_term(F.lit(f'"2000-01-02T03:04:05.5+02:00"{XSD}dateTime>')))
    assert str(t.ts) == "2000-01-02 01:04:05.500000"
    assert one(spark, terms.parse_term(F.lit(f'"12345-01-01"{XSD}date>'))).ts is None
    assert one(spark, terms.parse_term(F.lit(f'"1999"{XSD}gYear>'))).ts.year == 1999


def _terms(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    return df.withColumn("t", terms.parse_term("t"))


def test_order_and_comparison(spark):
    mixed = _terms(spark, '"b"', None, f'"2"{XSD}integer>', "<x>", f'"1.5"{XSD}double>', f'"true"{XSD}boolean>', "_:n",
                   f'"2001-01-01"{XSD}date>', '"a"', f'"10"{XSD}integer>')
    order = [r.k for r in mixed.orderBy(compare.sort_key("t").asc_nulls_first()).collect()]
    assert order == [1, 5, 4, 2, 9, 8, 0, 3, 7, 6]
    c = terms.constant
    assert one(spark, compare.term_lt(c(f'"1"{XSD}integer>'), c(f'"1.5"{XSD}double>'))) is True
    assert one(spark, compare.term_lt(c('"x"'), c(f'"1.5"{XSD}double>'))) is None
    assert one(spark, compare.term_eq(c('"x"@en'), c('"x"'))) is None
    assert one(spark, compare.term_in(c(f'"1"{XSD}integer>'), c('"z"'), c(f'"1"{XSD}double>'))) is True
    assert one(spark, compare.term_not_in(c(f'"1"{XSD}integer>'), c('"z"'))) is None
    big = f'"9007199254740993"{XSD}integer>'
    assert one(spark, compare.term_eq(c(big), c(f'"9007199254740992"{XSD}integer>'))) is False


def test_effective_boolean(spark):
    df = _terms(spark, '""', '"x"', f'"0"{XSD}integer>', f'"NaN"{XSD}double>', "<i>", "_:b", None, f'"false"{XSD}boolean>',
                f'"2001-01-01"{XSD}date>')
    kind = df.schema["t"].dataType
    got = [r.e for r in df.select("k", compare.ebv(F.col("t"), kind).alias("e")).orderBy("k").collect()]
    assert got == [False, True, False, False, True, None, None, False, True]


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None), (None, 5.0)], "k string, v double")
    got = {r.k: r for r in a.group_by(df, ["k"], s=a.total("v"), m=a.mean("v"), lo=a.minimum("v"), hi=a.maximum("v"),
                                      sd=a.stdev("v"), n=a.count("v")).collect()}
    assert (got["a"].s, got["a"].m, got["a"].lo, round(got["a"].sd, 6)) == (4.0, 2.0, 1.0, 1.414214)
    assert (got["b"].s, got["b"].m, got["b"].lo, got["b"].hi, got["b"].sd, got["b"].n) == (None, None, None, 2.0, None, 1)
    assert got[None].sd == 0.0
    empty = a.group_by(df.where("false"), [], s=a.total("v"), m=a.mean("v"), lo=a.minimum("v"), sd=a.stdev("v"), n=a.count()).first()
    assert (empty.s, empty.m, empty.lo, empty.sd, empty.n) == (0.0, 0.0, None, 0.0, 0)
    texts = spark.createDataFrame([("b",), ("a",), ("b",)], "t string")
    assert texts.agg(a.group_concat("t", ",")).first()[0] == "a,b,b"
    assert texts.agg(a.group_concat("t", ",", distinct=True)).first()[0] == "a,b"
    rows_ = spark.createDataFrame([(1, None), (1, None), (2, "x")], "p int, q string")
    assert rows_.agg(a.count_distinct_rows(rows_)).first()[0] == 2


def test_term_aggregates(spark):
    ints = _terms(spark, f'"1"{XSD}integer>', f'"2"{XSD}integer>')
    assert ints.agg(a.term_total("t").alias("v")).first().v.lex == "3"
    mixed = _terms(spark, f'"1"{XSD}integer>', f'"2.5"{XSD}double>', f'"true"{XSD}boolean>')
    got = mixed.agg(a.term_total("t").alias("s"), a.term_minimum("t").alias("lo"), a.term_maximum("t").alias("hi")).first()
    assert (got.s.d, got.lo.lex, got.hi.lex) == (4.5, "true", "2.5")
    bad = _terms(spark, f'"1"{XSD}integer>', '"x"')
    assert bad.agg(a.term_total("t").alias("s")).first().s is None
    gap = _terms(spark, f'"1"{XSD}integer>', None)
    assert gap.agg(a.term_minimum("t").alias("lo")).first().lo is None


NAN, INF = float("nan"), float("inf")


def cases():
    return [
    (n.round_half_up(F.lit(-1.5)), -1.0), (n.round_half_up(F.lit(2.5)), 3.0), (n.ceil(F.lit(1.2)), 2.0),
    (n.floor(F.lit(INF)), INF), (n.divide(F.lit(1), F.lit(0)), None), (n.divide(F.lit(1), F.lit(0), False), INF),
    (n.divide(F.lit(7), F.lit(2)), 3.5), (n.log(F.lit(0.0)), -INF), (n.sqrt(F.lit(4.0)), 2.0),
    (st.substr(F.lit("hello"), 2, 3), "ell"), (st.substr(F.lit("hello"), -1, 4), "he"), (st.substr(F.lit("hello"), 0, 2), "h"),
    (st.substr(F.lit("hello"), 1.5, 2.6), "ell"), (st.substr(F.lit("hello"), NAN, 2), ""), (st.substr(F.lit("hello"), 9), ""),
    (st.substr(F.lit("hello"), 3), "llo"), (st.str_before(F.lit("abc"), "b"), "a"), (st.str_before(F.lit("abc"), "z"), ""),
    (st.str_before(F.lit("abc"), ""), ""), (st.str_after(F.lit("abc"), "b"), "c"), (st.str_after(F.lit("abc"), ""), "abc"),
    (st.str_after(F.lit("abc"), "z"), ""), (st.encode_for_uri(F.lit("a b~c*é/")), "a%20b~c%2A%C3%A9%2F"),
    (st.lang_matches(F.lit("en-US"), "EN"), True), (st.lang_matches(F.lit(""), "*"), False), (st.regex(F.lit("aBc"), "b", "i"), True),
    (st.replace(F.lit("abcb"), "b", "x"), "axcx"), (st.str_of_double(F.lit(1e20)), "1.0E20"), (st.str_of_double(F.lit(42.0)), "42"),
    (casts.to_integer(F.lit(" +12 ")), 12), (casts.to_integer(F.lit("1.5")), None), (casts.to_decimal(F.lit("1e3")), None),
    (casts.to_double(F.lit("1e3")), 1000.0), (casts.to_double(F.lit("1d")), None), (casts.to_boolean(F.lit("yes")), None),
    (casts.to_boolean(F.lit("1")), True), (dates.year(F.lit("-0042-01-01")), -42), (dates.month(F.lit("1999")), None),
    (dates.month(F.lit("1999-07")), 7), (dates.hours(F.lit("2000-01-01")), None), (dates.seconds(F.lit("2000-01-01T00:00:01.25Z")), 1.25),
    (dates.tz(F.lit("2000-01-01T00:00:00Z")), "Z"), (dates.tz(F.lit("2000-01-01T00:00:00-05:30")), "-05:30"),
    (dates.tz(F.lit("2000-01-01")), ""), (dates.day(F.lit("2000-01-31Z")), 31), (dates.to_epoch(F.lit("1970-01-02T01:00:00+01:00")), 86400),
    (logic.if_else(F.lit(None).cast("boolean"), F.lit(1), F.lit(2)), None), (geo.longitude(F.lit("POINT(7.5 48)")), 7.5),
    ]


def test_functions(spark):
    wrong = [(k, got, want) for k, (column, want) in enumerate(cases()) if (got := one(spark, column)) != want]
    assert wrong == []


def test_special_values(spark):
    assert math.isnan(one(spark, n.log(F.lit(-1.0)))) and math.isnan(one(spark, n.divide(F.lit(0), F.lit(0), False)))
    assert math.isnan(one(spark, geo.latitude(F.lit("LINESTRING(0 0,1 1)"))))
    assert str(one(spark, dates.timezone(F.lit("2000-01-01T00:00:00-05:30")))) == "-1 day, 18:30:00"
    assert one(spark, dates.timezone(F.lit("2000-01-01T00:00:00"))) is None
    with pytest.raises(ValueError):
        st.regex(F.lit("a"), "a(", "")
    with pytest.raises(ValueError):
        st.regex(F.lit("a"), "a", "U")


def test_tagged_strings(spark):
    c = terms.constant
    cat = lambda *t: one(spark, st.term_concat(*map(c, t)))
    assert cat('"a"@en', '"b"@en').lang == "en" and cat('"a"@en', '"b"').lang is None
    assert one(spark, st.term_str_before(c('"abc"@en'), c('"b"'))).lang == "en"
    assert one(spark, st.term_str_before(c('"abc"@en'), c('"b"@de'))) is None
    assert one(spark, st.term_str_after(c('"abc"@en'), c('"z"'))).lang is None
    assert one(spark, st.str_lang(c('"x"@en'), "de")) is None
    assert one(spark, logic.is_numeric(c(f'"1"{XSD}int>'))) is True
    assert one(spark, st.datatype(c('"x"'))).lex.endswith("#string")


def test_fresh_nodes_are_stable(spark):
    df = spark.range(50).withColumn("b", st.fresh_bnode("id")["lex"])
    assert df.select("b").distinct().count() == 50 and rows(df) == rows(df.repartition(3))
