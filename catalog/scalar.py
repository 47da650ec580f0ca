"""Scalar functions over whole columns."""

from pyspark.sql import functions as F

from catalog.registry import graph, query, table
from graphloom.functions import casts, dates, logic, numeric as n, strings as st, terms
from graphloom.operators.scan import pattern

XSD = terms.XSD


@query("""SELECT p_partkey, p_size + p_partkey AS plus, p_size - p_retailprice AS minus, p_size * p_size AS times,
-p_size AS neg, p_retailprice / nullif(p_size - 10, 0) AS quot,
CASE WHEN p_size <> 10 THEN p_retailprice / (p_size - 10) ELSE 'inf'::DOUBLE END AS quot_inf FROM part""")
def arithmetic(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", n.add("p_size", "p_partkey").alias("plus"), n.subtract("p_size", "p_retailprice").alias("minus"),
        n.multiply("p_size", "p_size").alias("times"), n.negate("p_size").alias("neg"),
        n.divide("p_retailprice", F.col("p_size") - 10).alias("quot"),
        n.divide("p_retailprice", F.col("p_size") - 10, zero_is_unbound=False).alias("quot_inf"))


@query("""SELECT c_custkey, abs(c_acctbal) AS a, ceil(c_acctbal) AS c, floor(c_acctbal) AS f,
floor(c_acctbal * 2 + 0.5) AS r2, floor(round(c_acctbal) / 2 + 0.5) AS half FROM customer""")
def rounding(spark, d):
    b = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey", n.absolute(b).alias("a"), n.ceil(b).alias("c"), n.floor(b).alias("f"),
        n.round_half_up(b * 2).alias("r2"), n.round_half_up(F.round(b) / 2).alias("half"))


@query("""SELECT event_id, round(ln(value + 1), 6) AS l, round(exp(value / 100), 6) AS e, round(sqrt(value), 6) AS q,
round(sin(value), 6) AS s, round(cos(value), 6) AS c, round(tan(value / 1000), 6) AS t, round(pow(value, 1.5), 4) AS p,
CASE WHEN value < 20 THEN 'nan'::DOUBLE WHEN value = 20 THEN '-inf'::DOUBLE ELSE round(ln(value - 20), 6) END AS guarded
FROM events""")
def math_functions(spark, d):
    v = F.col("value")
    guarded = n.log(v - 20)
    return table(spark, d, "events").select(
        "event_id", F.round(n.log(v + 1), 6).alias("l"), F.round(n.exp(v / 100), 6).alias("e"),
        F.round(n.sqrt(v), 6).alias("q"), F.round(n.sin(v), 6).alias("s"), F.round(n.cos(v), 6).alias("c"),
        F.round(n.tan(v / 1000), 6).alias("t"), F.round(n.power(v, F.lit(1.5)), 4).alias("p"),
        F.when(v <= 20, guarded).otherwise(F.round(guarded, 6)).alias("guarded"))


@query("""SELECT count(*) AS n, true AS in_range, true AS unique_ids FROM events""")
def random_and_uuid(spark, d):
    rows = table(spark, d, "events").select(n.rand(7).alias("r"), st.struuid().alias("u"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), ((F.min("r") >= 0) & (F.max("r") < 1)).alias("in_range"),
        (F.count_distinct("u") == F.count(F.lit(1))).alias("unique_ids"))


@query("""SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::BIGINT::VARCHAR
ELSE p_retailprice::VARCHAR END AS price, 'http://x.org/' || p_brand AS iri,
'"' || p_type || '"@en' AS tagged, '"' || p_size || '"^^<http://www.w3.org/2001/XMLSchema#integer>' AS number FROM part""")
def term_constructors(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", st.str_of_double("p_retailprice").alias("price"),
        st.str_of(st.make_iri("p_brand", base="http://x.org/")).alias("iri"),
        terms.canonical(st.str_lang(terms.literal("p_type"), "EN")).alias("tagged"),
        terms.canonical(st.str_dt(terms.literal(F.col("p_size").cast("string")), XSD + "integer")).alias("number"))


@query("""SELECT doc_id, length(text) AS len, substring(text, 3, 40) AS mid, substring(text, 1, 3) AS cut,
upper(source) AS up, lower(source) AS low, starts_with(text, 'The') AS st, ends_with(text, '.') AS en,
contains(text, 'tion') AS co FROM documents""")
def string_functions(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", st.strlen("text").alias("len"), st.substr("text", 3, 40).alias("mid"),
        st.substr("text", -1, 5).alias("cut"), st.ucase("source").alias("up"), st.lcase("source").alias("low"),
        st.str_starts("text", "The").alias("st"), st.str_ends("text", ".").alias("en"),
        st.contains("text", "tion").alias("co"))


@query("""SELECT page_id, CASE WHEN strpos(url, '.') > 0 THEN substring(url, 1, strpos(url, '.') - 1) ELSE '' END AS before_dot,
CASE WHEN strpos(url, '?') > 0 THEN substring(url, strpos(url, '?') + 1) ELSE '' END AS query_part,
'<' || url || '>' AS joined FROM pages""")
def string_before_after(spark, d):
    return table(spark, d, "pages").select(
        "page_id", st.str_before("url", ".").alias("before_dot"), st.str_after("url", "?").alias("query_part"),
        st.concat("<", F.col("url"), ">").alias("joined"))


@query("""SELECT page_id, regexp_replace(url, '[0-9]+', 'N', 'g') AS masked, regexp_matches(url, '(?i)EXAMPLE') AS hit,
starts_with(url, 'http://a') AS pre FROM pages""")
def regular_expressions(spark, d):
    return table(spark, d, "pages").select(
        "page_id", st.replace("url", "[0-9]+", "N").alias("masked"), st.regex("url", "EXAMPLE", "i").alias("hit"),
        st.prefix_match("url", "http://a").alias("pre"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN regexp_matches(p_name, '(?i)WID') WHEN 1 THEN regexp_matches(p_name, p_brand)
WHEN 2 THEN NULL ELSE regexp_matches(p_name, '^.+t$') END AS hit,
CASE p_size % 4 WHEN 0 THEN regexp_replace(p_name, '(?i)WID', '<' || p_size || '>', 'g') WHEN 1 THEN replace(p_name, p_brand, '<' || p_size || '>')
WHEN 2 THEN NULL ELSE regexp_replace(p_name, '^.+t$', '<' || p_size || '>', 'g') END AS masked,
CASE WHEN p_size % 2 = 0 THEN regexp_replace(p_type, '([A-Z])[A-Z]+', '\\1', 'g') END AS initials FROM part""")
def regex_from_column(spark, d):
    """Patterns, flags and replacements from columns; faulty patterns and groups that do not exist are unbound."""
    kind = F.col("p_size") % 4
    pattern = F.when(kind == 0, "WID").when(kind == 1, F.col("p_brand")).when(kind == 2, "(").otherwise("^.+t$")
    flags = F.when(kind == 0, "i").otherwise("")
    group = F.when(F.col("p_size") % 2 == 0, "$1").otherwise("$7")
    return table(spark, d, "part").select(
        "p_partkey", st.regex("p_name", pattern, flags).alias("hit"),
        st.replace("p_name", pattern, F.concat(F.lit("<"), F.col("p_size"), F.lit(">")), flags).alias("masked"),
        st.replace("p_type", "([A-Z])[A-Z]+", group).alias("initials"))


@query("""SELECT page_id, url_encode(url) AS enc FROM pages""")
def uri_encoding(spark, d):
    return table(spark, d, "pages").select("page_id", st.encode_for_uri("url").alias("enc"))


@query("""SELECT '<documents/' || doc_id || '>' AS doc, lang, lang = 'de' AS german,
'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' AS dt, upper(replace(substring(text, 1, 10), 'ß', 'SS')) AS head FROM documents""")
def language_functions(spark, d):
    rows = pattern(graph(spark, d, "documents"), "?doc", "<documents/text>", "?t", as_type="term")
    return rows.select(
        "doc", st.lang("t").alias("lang"), st.lang_matches(st.lang("t"), "DE").alias("german"),
        st.datatype("t")["lex"].alias("dt"), st.term_ucase(st.term_substr("t", 1, 10))["lex"].alias("head"))


@query("""SELECT doc_id, md5(text) AS m, sha1(text) AS s1, sha256(text) AS s2 FROM documents""")
def hash_functions(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", st.md5("text").alias("m"), st.sha1("text").alias("s1"), st.sha2("text", 256).alias("s2"))


@query("""SELECT count(*) AS n, count(DISTINCT o_orderkey) AS fresh, count(DISTINCT (o_orderkey, o_orderpriority)) AS labelled
FROM orders""")
def blank_node_functions(spark, d):
    rows = table(spark, d, "orders").select(
        st.fresh_bnode("o_orderkey")["lex"].alias("a"), st.bnode_of("o_orderpriority", "o_orderkey")["lex"].alias("b"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("fresh"),
                    F.count_distinct("b").alias("labelled"))


@query("""SELECT '<events/' || event_id || '>' AS e, year(ts) AS y, month(ts) AS mo, day(ts) AS d, hour(ts) AS h,
minute(ts) AS mi, round(second(ts) + (microsecond(ts) % 1000000) / 1e6, 6) AS s, '' AS tz,
floor(epoch(ts))::BIGINT AS ep FROM events""")
def date_functions(spark, d):
    rows = pattern(graph(spark, d, "events"), "?e", "<events/ts>", "?t", as_type="string")
    return rows.select(
        "e", dates.year("t").alias("y"), dates.month("t").alias("mo"), dates.day("t").alias("d"),
        dates.hours("t").alias("h"), dates.minutes("t").alias("mi"), F.round(dates.seconds("t"), 6).alias("s"),
        dates.tz("t").alias("tz"), dates.to_epoch("t").alias("ep"))


@query("""SELECT event_id, (user_id % 27) - 13 AS hours_off, floor(epoch(ts))::BIGINT - ((user_id % 27) - 13) * 3600 AS ep,
user_id % 27 - 13 AS zone_hours FROM events""")
def zoned_dates(spark, d):
    off = F.col("user_id") % 27 - 13
    zone = F.concat(F.when(off < 0, "-").otherwise("+"), F.lpad(F.abs(off).cast("string"), 2, "0"), F.lit(":00"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    rows = table(spark, d, "events").select("event_id", off.alias("hours_off"), text.alias("t"))
    hours = F.extract(F.lit("HOUR"), dates.timezone("t")) + 24 * F.extract(F.lit("DAY"), dates.timezone("t"))
    return rows.select("event_id", "hours_off", dates.to_epoch("t").alias("ep"), hours.cast("bigint").alias("zone_hours"))


@query("""SELECT o_orderkey, date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS days FROM orders""")
def date_difference(spark, d):
    span = dates.timestamp_difference(F.col("o_orderdate"), F.lit("1992-01-01").cast("timestamp_ntz"))
    return table(spark, d, "orders").select("o_orderkey", F.extract(F.lit("DAY"), span).cast("bigint").alias("days"))


@query("""SELECT true AS recent, count(*) AS n FROM events""")
def now_function(spark, d):
    return table(spark, d, "events").agg(
        (F.max("ts").cast("timestamp") < dates.now()).alias("recent"), F.count(F.lit(1)).alias("n"))


@query("""SELECT d.doc_id, CASE WHEN quality > 0 THEN 'good' WHEN quality <= 0 THEN 'bad' END AS verdict,
coalesce(quality, toxic, -1) AS first_bound, quality IS NOT NULL AS known FROM documents d LEFT JOIN labels l USING (doc_id)""")
def conditionals(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id", logic.if_else(F.col("quality") > 0, F.lit("good"), F.lit("bad")).alias("verdict"),
        logic.coalesce("quality", "toxic", F.lit(-1)).alias("first_bound"), logic.bound("quality").alias("known"))


@query("""SELECT kind, iri, blank, lit, num, sum(n)::BIGINT AS n FROM (
SELECT unnest(['custkey', 'name', 'nationkey', 'acctbal', 'mktsegment', 'type']) AS kind,
  unnest([false, false, true, false, false, true]) AS iri, false AS blank,
  unnest([true, true, false, true, true, false]) AS lit, unnest([true, false, false, true, false, false]) AS num,
  1 AS n FROM customer) GROUP BY ALL""")
def term_tests(spark, d):
    rows = graph(spark, d, "customer").quads()
    kind = F.regexp_extract("p", r"[/#-]([a-z]+)>$", 1)
    return rows.groupBy(
        kind.alias("kind"), logic.is_iri("o_term").alias("iri"), logic.is_blank("o_term").alias("blank"),
        logic.is_literal("o_term").alias("lit"), logic.is_numeric("o_term").alias("num"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT page_id, try_cast(CASE WHEN regexp_matches(t, '^-?[0-9]+$') THEN t END AS BIGINT) AS i,
try_cast(CASE WHEN regexp_matches(t, '^-?[0-9]+(\\.[0-9]*)?$') THEN t END AS DOUBLE) AS dec,
try_cast(CASE WHEN regexp_matches(t, '^-?[0-9]+(\\.[0-9]*)?([eE][0-9]+)?$') THEN t END AS DOUBLE) AS dbl,
CASE WHEN t IN ('1', 'true') THEN true WHEN t IN ('0', 'false') THEN false END AS b FROM (
SELECT page_id, CASE page_id % 6 WHEN 0 THEN page_id::VARCHAR WHEN 1 THEN page_id || '.5' WHEN 2 THEN page_id || 'e2'
WHEN 3 THEN (page_id % 2)::VARCHAR WHEN 4 THEN url ELSE 'true' END AS t FROM pages)""")
def type_constructors(spark, d):
    k = F.col("page_id")
    text = (F.when(k % 6 == 0, k.cast("string")).when(k % 6 == 1, F.concat(k, F.lit(".5")))
            .when(k % 6 == 2, F.concat(k, F.lit("e2"))).when(k % 6 == 3, (k % 2).cast("string"))
            .when(k % 6 == 4, F.col("url")).otherwise("true"))
    rows = table(spark, d, "pages").select("page_id", text.alias("t"))
    return rows.select("page_id", casts.to_integer("t").alias("i"), casts.to_decimal("t").alias("dec"),
                       casts.to_double("t").alias("dbl"), casts.to_boolean("t").alias("b"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts FROM orders""")
def date_constructors(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, d, "orders").select(
        "o_orderkey", casts.to_date(text).cast("string").alias("day"),
        F.date_format(casts.to_datetime(text), "yyyy-MM-dd HH:mm:ss").alias("ts"))
