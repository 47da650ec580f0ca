"""Joins, optional and negated patterns, aggregation."""

from pyspark.sql import functions as F

from catalog.registry import graph, query, table
from graphloom.operators import aggregates as a, joins as j
from graphloom.operators.scan import pattern
from graphloom.plans.bgp import bgp, star


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, '<customer/' || o_custkey || '>' AS c,
'<nation/' || c_nationkey || '>' AS n FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_one_variable(spark, d):
    g = graph(spark, d, "orders", "customer")
    return j.natural_join(pattern(g, "?o", "<orders/custkey>", "?c"), pattern(g, "?c", "<customer/nationkey>", "?n"))


@query("""SELECT '<customer/' || c.c_custkey || '>' AS c, '<supplier/' || s.s_suppkey || '>' AS s,
'<nation/' || c_nationkey || '>' AS n, floor(c_acctbal / 1000)::BIGINT AS k
FROM customer c JOIN supplier s ON c_nationkey = s_nationkey AND floor(c_acctbal / 1000) = floor(s_acctbal / 1000)""")
def join_two_variables(spark, d):
    g = graph(spark, d, "customer", "supplier")
    left = bgp(g, [("?c", "<customer/nationkey>", "?n"), ("?c", "<customer/acctbal>", "?b", "double")])
    right = bgp(g, [("?s", "<supplier/nationkey>", "?n"), ("?s", "<supplier/acctbal>", "?b", "double")])
    thousand = F.floor(F.col("b") / 1000).alias("k")
    return j.natural_join(left.select("c", "n", thousand), right.select("s", "n", thousand), spread=True)


def _docs_labels(spark, d):
    """Documents with a quality where labelled (unbound elsewhere), and a table of qualities, one unbound."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    quality = table(spark, d, "labels").select("doc_id", F.col("quality").alias("q"))
    left = docs.join(quality, "doc_id", "left")
    right = (table(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("total"))
             .select("source", "total", F.when(F.col("total") % 3 != 0, (F.col("total") % 3 - 1).cast("int")).alias("q")))
    return left, right


_DL = """WITH l AS (SELECT d.doc_id, d.source, quality AS q FROM documents d LEFT JOIN labels USING (doc_id)),
r AS (SELECT source, sum(n_chars)::BIGINT AS total,
  CASE WHEN sum(n_chars) % 3 <> 0 THEN (sum(n_chars) % 3 - 1)::INT END AS q FROM documents GROUP BY source) """


@query(_DL + """SELECT l.doc_id, l.source, coalesce(l.q, r.q) AS q, r.total FROM l JOIN r
ON l.source = r.source AND (l.q = r.q OR l.q IS NULL OR r.q IS NULL)""")
def join_compatible(spark, d):
    left, right = _docs_labels(spark, d)
    return j.compat_join(left, right, nullable=["q"])


@query(_DL + """SELECT l.doc_id, l.source, coalesce(l.q, r.q) AS q, r.total FROM l LEFT JOIN r
ON l.source = r.source AND (l.q = r.q OR l.q IS NULL OR r.q IS NULL)""")
def optional_compatible(spark, d):
    left, right = _docs_labels(spark, d)
    return j.optional_join(left, right, nullable=["q"])


@query(_DL + """SELECT l.* FROM l WHERE NOT EXISTS (SELECT 1 FROM r
WHERE l.source = r.source AND (l.q = r.q OR l.q IS NULL OR r.q IS NULL))""")
def minus_compatible(spark, d):
    left, right = _docs_labels(spark, d)
    return j.minus(left, right, nullable=["q"])


@query("""WITH l AS (SELECT d.doc_id, quality AS q FROM documents d LEFT JOIN labels USING (doc_id)),
r AS (SELECT toxic AS q FROM labels WHERE toxic = 1 UNION ALL SELECT NULL FROM labels)
SELECT doc_id, q FROM l WHERE q IS NULL OR q <> 1""")
def minus_only_unbound_agreement(spark, d):
    # Rows that agree with the right side only through an unbound value stay.
    left, _ = _docs_labels(spark, d)
    right = table(spark, d, "labels").select(F.when(F.col("toxic") == 1, 1).alias("q"))
    return j.minus(left.select("doc_id", "q"), right, nullable=["q"])


@query(_DL + """SELECT l.*, EXISTS (SELECT 1 FROM r
WHERE l.source = r.source AND (l.q = r.q OR l.q IS NULL OR r.q IS NULL)) AS hit FROM l""")
def exists_flag_compatible(spark, d):
    left, right = _docs_labels(spark, d)
    return j.exists_flag(left, right, "hit", nullable=["q"])


@query("""SELECT '<customer/' || c_custkey || '>' AS c, c_name AS name, '<orders/' || o_orderkey || '>' AS o
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000""")
def optional_pattern(spark, d):
    g = graph(spark, d, "customer", "orders")
    big = bgp(g, [("?o", "<orders/custkey>", "?c"), ("?o", "<orders/totalprice>", "?p", "double")]).where("p > 450000")
    names = pattern(g, "?c", "<customer/name>", "?name", as_type="string")
    return j.optional_join(names, big.select("o", "c"), nullable=[])


@query("""SELECT '<supplier/' || s_suppkey || '>' AS s, r_name AS name FROM supplier LEFT JOIN
(SELECT r_name FROM region WHERE r_name LIKE 'A%') r ON TRUE""")
def optional_unconnected(spark, d):
    g = graph(spark, d, "supplier", "region")
    names = pattern(g, "?r", "<region/name>", "?name", as_type="string").where(F.col("name").startswith("A"))
    return j.optional_join(pattern(g, "?s", "<supplier/nationkey>", "?n").select("s"), names.select("name"))


@query("""SELECT '<customer/' || c_custkey || '>' AS c FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def minus_pattern(spark, d):
    g = graph(spark, d, "customer", "orders")
    done = bgp(g, [("?o", "<orders/custkey>", "?c"), ("?o", "<orders/orderstatus>", '"F"')])
    return j.minus(pattern(g, "?c", "<customer/name>", "?name").select("c"), done.select("c"), nullable=[])


@query("""SELECT '<customer/' || c_custkey || '>' AS c FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def exists_filter(spark, d):
    g = graph(spark, d, "customer", "orders")
    big = bgp(g, [("?o", "<orders/custkey>", "?c"), ("?o", "<orders/totalprice>", "?p", "double")]).where("p > 400000")
    return j.where_exists(pattern(g, "?c", "<customer/name>", "?name").select("c"), big.select("c"), nullable=[])


@query("""SELECT '<customer/' || c_custkey || '>' AS c FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def not_exists_filter(spark, d):
    g = graph(spark, d, "customer", "orders")
    return j.where_not_exists(pattern(g, "?c", "<customer/name>", "?name").select("c"),
                              pattern(g, "?o", "<orders/custkey>", "?c"), nullable=[])


@query("""SELECT c_mktsegment AS segment, r_name AS region, n FROM
(SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) CROSS JOIN region""")
def cartesian_product(spark, d):
    g = graph(spark, d, "customer", "region")
    segments = (pattern(g, "?c", "<customer/mktsegment>", "?segment", as_type="string")
                .groupBy("segment").agg(F.count(F.lit(1)).alias("n")))
    return j.product(segments, pattern(g, "?r", "<region/name>", "?region", as_type="string").select("region"))


@query("""SELECT r_name AS region, n_name AS nation, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def chain_join(spark, d):
    g = graph(spark, d, "orders", "customer", "nation", "region")
    rows = bgp(g, [
        ("?n", "<nation/regionkey>", "?r"), ("?r", "<region/name>", "?region", "string"),
        ("?n", "<nation/name>", "?nation", "string"), ("?c", "<customer/nationkey>", "?n"),
        ("?o", "<orders/custkey>", "?c"), ("?o", "<orders/totalprice>", "?p", "double"),
    ])
    return a.group_by(rows, ["region", "nation"], n_orders=a.count(), revenue=F.round(a.total("p"), 2))


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, o_orderstatus AS status, o_totalprice AS price,
'<customer/' || o_custkey || '>' AS c FROM orders""")
def star_join_one_table(spark, d):
    return star(graph(spark, d, "orders"), "?o", {
        "<orders/orderstatus>": ("?status", "string"), "<orders/totalprice>": ("?price", "double"),
        "<orders/custkey>": ("?c", None),
    })


@query("""SELECT '<documents/' || d.doc_id || '>' AS doc, source, n_chars AS chars, quality FROM documents d
JOIN labels USING (doc_id)""")
def star_join_pivot(spark, d):
    # The same subjects described by two sources: one pass and one shuffle by subject.
    from catalog.registry import table_map
    from graphloom.sources.mapping import MappedGraph, TableMap

    labels = TableMap("documents", table(spark, d, "labels").select("doc_id", "quality"), ["doc_id"])
    g = MappedGraph([table_map(spark, d, "documents"), labels])
    return star(g, "?doc", {
        "<documents/source>": ("?source", "string"), "<documents/n_chars>": ("?chars", "long"),
        "<documents/quality>": ("?quality", "long"),
    })


@query("""SELECT a.o AS a, b.o AS b, a.c AS c FROM (SELECT o_orderkey AS o, o_custkey AS c FROM orders
WHERE o_orderpriority LIKE '1%') a JOIN (SELECT o_orderkey AS o, o_custkey AS c FROM orders
WHERE o_orderpriority LIKE '5%') b USING (c)""")
def self_join(spark, d):
    g = graph(spark, d, "orders")

    def side(name, digit):
        rows = bgp(g, [("?x", "<orders/custkey>", "?c"), ("?x", "<orders/orderpriority>", "?p", "string")])
        return rows.where(F.col("p").startswith(digit)).select(_key("x").alias(name), _key("c").alias("c"))

    return j.natural_join(side("a", "1"), side("b", "5"))


def _key(column):
    return F.regexp_extract(column, r"/(\d+)>", 1).cast("bigint")


@query("""SELECT event_type AS type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total,
round(avg(value), 4) AS mean, min(value) AS lo, max(value) AS hi, round(stddev_samp(value), 4) AS sd
FROM events GROUP BY event_type""")
def group_by_aggregates(spark, d):
    rows = star(graph(spark, d, "events"), "?e", {
        "<events/event_type>": ("?type", "string"), "<events/user_id>": ("?user", None),
        "<events/value>": ("?value", "double")})
    return a.group_by(
        rows, ["type"], n=a.count("e"), users=a.count("user", distinct=True), total=F.round(a.total("value"), 2),
        mean=F.round(a.mean("value"), 4), lo=a.minimum("value"), hi=a.maximum("value"), sd=F.round(a.stdev("value"), 4))


@query("""SELECT floor(p_retailprice / 100)::BIGINT AS band, count(*) AS n FROM part GROUP BY 1""")
def group_by_expression(spark, d):
    rows = pattern(graph(spark, d, "part"), "?x", "<part/retailprice>", "?p", as_type="double")
    return a.group_by(rows, [F.floor(F.col("p") / 100).alias("band")], n=a.count())


@query("""SELECT 0::BIGINT AS n, 0.0::DOUBLE AS s, NULL::DOUBLE AS lo, 0.0::DOUBLE AS sd""")
def group_implicit_empty(spark, d):
    rows = pattern(graph(spark, d, "orders"), "?o", "<orders/totalprice>", "?p", as_type="double").where("p < 0")
    return a.group_by(rows, [], n=a.count(), s=a.total("p").cast("double"), lo=a.minimum("p"), sd=a.stdev("p"))


@query("""SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 3000000""")
def having_filter(spark, d):
    rows = bgp(graph(spark, d, "orders"), [("?o", "<orders/custkey>", "?x"), ("?o", "<orders/totalprice>", "?p", "double")])
    grouped = a.group_by(rows, [_key("x").alias("c")], n=a.count(), total=a.total("p"))
    return a.having(grouped, F.col("total") > 3000000).select("c", "n")


@query("""SELECT source, CASE WHEN count(q) = count(*) THEN sum(q) END AS total,
CASE WHEN count(q) = count(*) THEN avg(q) END AS mean, CASE WHEN count(q) = count(*) THEN min(q) END AS lo, max(q) AS hi
FROM (SELECT d.source || '/' || d.lang AS source, quality AS q FROM documents d LEFT JOIN labels USING (doc_id))
GROUP BY source""")
def aggregates_with_unbound(spark, d):
    left, _ = _docs_labels(spark, d)
    rows = left.join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    key = F.concat_ws("/", "source", "lang").alias("source")
    return a.group_by(rows, [key], total=a.total("q").cast("bigint"), mean=a.mean("q"), lo=a.minimum("q"), hi=a.maximum("q"))


@query("""SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus
FROM lineitem)) AS n_distinct FROM lineitem""")
def count_star_distinct(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return rows.agg(a.count().alias("n"), a.count_distinct_rows(rows).alias("n_distinct"))


@query("""SELECT p_brand AS brand, sum(DISTINCT p_size)::BIGINT AS total, round(avg(DISTINCT p_size), 6) AS mean,
round(coalesce(stddev_samp(DISTINCT p_size), 0), 6) AS sd FROM part GROUP BY p_brand""")
def distinct_aggregates(spark, d):
    rows = star(graph(spark, d, "part"), "?x", {"<part/brand>": ("?brand", "string"), "<part/size>": ("?size", "long")})
    return a.group_by(rows, ["brand"], total=a.total("size", distinct=True),
                      mean=F.round(a.mean("size", distinct=True), 6), sd=F.round(a.stdev("size", distinct=True), 6))


@query("""SELECT n_regionkey AS r, string_agg(n_name, ', ' ORDER BY n_name) AS names,
min(n_name) AS some, (SELECT string_agg(DISTINCT p, '|' ORDER BY p) FROM (SELECT o_orderpriority AS p FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation n2 ON c_nationkey = n2.n_nationkey
WHERE n2.n_regionkey = n.n_regionkey)) AS priorities FROM nation n GROUP BY n_regionkey""")
def group_concat_sample(spark, d):
    g = graph(spark, d, "nation", "customer", "orders")
    names = bgp(g, [("?n", "<nation/regionkey>", "?reg"), ("?n", "<nation/name>", "?name", "string")])
    flat = a.group_by(names, ["reg"], names=a.group_concat("name", ", "), some=a.sample_lowest("name"))
    kinds = bgp(g, [("?n", "<nation/regionkey>", "?reg"), ("?c", "<customer/nationkey>", "?n"),
                    ("?o", "<orders/custkey>", "?c"), ("?o", "<orders/orderpriority>", "?p", "string")])
    lists = a.group_by(kinds, ["reg"], priorities=a.group_concat("p", "|", distinct=True))
    return flat.join(lists, "reg").select(_key("reg").cast("int").alias("r"), "names", "some", "priorities")


@query("""SELECT l_returnflag AS flag, round(sum(l_extendedprice) / count(l_tax), 4) AS per_line,
round(sum(l_extendedprice * (1 - l_discount)) / sum(l_quantity), 4) AS per_unit FROM lineitem
GROUP BY l_returnflag HAVING count(*) > 10 ORDER BY sum(l_quantity) DESC""")
def expressions_over_aggregates(spark, d):
    rows = table(spark, d, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    grouped = a.group_by(rows, [F.col("l_returnflag").alias("flag")],
                         per_line=F.round(a.total("l_extendedprice") / a.count("l_tax"), 4),
                         per_unit=F.round(a.total(net) / a.total("l_quantity"), 4), n=a.count(), q=a.total("l_quantity"))
    return a.having(grouped, F.col("n") > 10).orderBy(F.col("q").desc_nulls_last()).select("flag", "per_line", "per_unit")


@query("""SELECT '<part/' || p_partkey || '>' AS s, greatest(p_partkey, p_size, p_retailprice) AS top_number, p_type AS hi,
least(p_partkey, p_size, p_retailprice) AS lo, round(p_partkey + p_size + p_retailprice, 6) AS total FROM part""")
def aggregates_mixed_types(spark, d):
    quads = graph(spark, d, "part").quads(["<part/partkey>", "<part/size>", "<part/retailprice>", "<part/type>"])
    numeric = F.when(F.col("o_term.d").isNotNull(), F.col("o_term"))
    grouped = a.group_by(quads.where("o_term.d is not null"), ["s"], top=a.term_maximum(numeric), t=a.term_total("o_term"))
    mixed = a.group_by(quads, ["s"], lo=a.term_minimum("o_term"), hi=a.term_maximum("o_term"))
    return grouped.join(mixed, "s").select(
        "s", F.col("top.d").alias("top_number"), F.col("hi.lex").alias("hi"), F.col("lo.d").alias("lo"),
        F.round(F.col("t.d"), 6).alias("total"))
