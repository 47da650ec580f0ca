"""Scans, projection, filters, set operations, ordering."""

from pyspark.sql import Window, functions as F

from catalog.registry import graph, query, table, table_map
from graphloom.functions import compare, terms
from graphloom.functions.terms import RDF_TYPE
from graphloom.operators import modifiers as m
from graphloom.operators.scan import from_graphs, from_named, graph_except, graph_only, pattern
from graphloom.plans.bgp import bgp
from graphloom.sources.mapping import MappedGraph, TableMap

XSD_INT = "^^<http://www.w3.org/2001/XMLSchema#integer>"


@query("""SELECT '<customer/' || c_custkey || '>' AS c, '<nation/' || c_nationkey || '>' AS n FROM customer""")
def scan_two_variables(spark, d):
    return pattern(graph(spark, d, "customer"), "?c", "<customer/nationkey>", "?n")


@query("""SELECT '<customer/' || c_custkey || '>' AS c FROM customer WHERE c_nationkey = 7""")
def scan_one_variable(spark, d):
    return pattern(graph(spark, d, "customer"), "?c", "<customer/nationkey>", "<nation/7>")


@query("""
SELECT '<nation/' || n_nationkey || '>' AS s, unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>',
  '<nation/nationkey>', '<nation/name>', '<nation/regionkey>']) AS p, unnest(['<nation>',
  '"' || n_nationkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>', '"' || n_name || '"',
  '<region/' || n_regionkey || '>']) AS o FROM nation
UNION ALL
SELECT '<orders/' || o_orderkey || '>', unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>',
  '<orders/orderkey>', '<orders/custkey>', '<orders/orderstatus>', '<orders/orderdate>', '<orders/orderpriority>', '<orders/totalprice>']),
  unnest(['<orders>', '"' || o_orderkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>',
  '<customer/' || o_custkey || '>', '"' || o_orderstatus || '"',
  '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"^^<http://www.w3.org/2001/XMLSchema#dateTime>',
  '"' || o_orderpriority || '"', '"' || CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT::VARCHAR ELSE o_totalprice::VARCHAR END || '"^^<http://www.w3.org/2001/XMLSchema#double>'])
  FROM orders""")
def scan_three_variables(spark, d):
    maps = [table_map(spark, d, "nation"), table_map(spark, d, "orders")]
    return pattern(MappedGraph(maps), "?s", "?p", "?o")


@query("""SELECT '<nation/' || n_nationkey || '>' AS x FROM nation WHERE n_nationkey = n_regionkey
UNION ALL SELECT '<customer/' || c_custkey || '>' FROM customer WHERE c_custkey = c_nationkey""")
def scan_repeated_variable(spark, d):
    # With these references an entity points at itself where both keys are equal.
    maps = [table_map(spark, d, "nation", refs={"n_regionkey": "nation"}),
            table_map(spark, d, "customer", refs={"c_nationkey": "customer"})]
    return pattern(MappedGraph(maps), "?x", "?p", "?x").select("x")


def _two_graphs(spark, d):
    orders = table(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    urgent = F.col("o_orderpriority").startswith("1")
    return MappedGraph([
        _orders_part(orders.where(late), "<graph/late>"),
        _orders_part(orders.where(urgent), "<graph/urgent>"),
        table_map(spark, d, "customer"),
    ])


def _orders_part(df, name):
    return TableMap("orders", df.select("o_orderkey", "o_custkey"), ["o_orderkey"], {"o_custkey": "customer"},
                    prefix="o_", graph=name)


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, '<customer/' || o_custkey || '>' AS c FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' OR o_orderpriority LIKE '1%'""")
def scan_from_graphs(spark, d):
    merged = from_graphs(_two_graphs(spark, d), ["<graph/late>", "<graph/urgent>"])
    return pattern(merged, "?o", "<orders/custkey>", "?c")


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, '<graph/urgent>' AS g FROM orders WHERE o_orderpriority LIKE '1%'""")
def scan_from_named(spark, d):
    named = from_named(_two_graphs(spark, d), ["<graph/urgent>"])
    return pattern(named, "?o", "<orders/custkey>", "?c", g="?g").select("o", "g")


@query("""SELECT g, count(*) AS n FROM (
SELECT '<graph/late>' AS g FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
UNION ALL SELECT '<graph/urgent>' FROM orders WHERE o_orderpriority LIKE '1%') GROUP BY g""")
def scan_graph_variable(spark, d):
    hits = pattern(_two_graphs(spark, d), "?o", "<orders/custkey>", "?c", g="?g")
    return hits.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT '<orders/' || o_orderkey || '>' AS o FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""")
def scan_graph_fixed(spark, d):
    return pattern(graph_only(_two_graphs(spark, d), "<graph/late>"), "?o", "<orders/custkey>", "?c").select("o")


@query("""SELECT count(*) AS n FROM (SELECT 1 FROM orders WHERE o_orderpriority LIKE '1%' UNION ALL
SELECT 1 FROM orders WHERE o_orderpriority LIKE '1%' UNION ALL
SELECT 1 FROM orders WHERE o_orderpriority LIKE '1%' UNION ALL SELECT unnest([1,2,3,4,5,6]) FROM customer)""")
def scan_graph_excluded(spark, d):
    return graph_except(_two_graphs(spark, d), "<graph/late>").quads().agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT '<customer/' || c_custkey || '>' AS c, v.seg AS seg, v.label AS label FROM customer
JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', NULL)) AS v(seg, label) ON c_mktsegment = v.seg""")
def values_join(spark, d):
    rows = pattern(graph(spark, d, "customer"), "?c", "<customer/mktsegment>", "?seg", as_type="string")
    return m.join_values(rows, m.values(spark, "seg string, label string", [("BUILDING", "b"), ("MACHINERY", None)]))


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, '<customer/' || o_custkey || '>' AS c FROM orders
JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 9000""")
def external_values(spark, d):
    wanted = table(spark, d, "customer").where("c_acctbal > 9000").select(
        F.concat(F.lit("<customer/"), F.col("c_custkey"), F.lit(">")).alias("c"))
    return m.join_values(pattern(graph(spark, d, "orders"), "?o", "<orders/custkey>", "?c"), wanted)


@query("""SELECT '<part/' || p_partkey || '>' AS part, p_retailprice * 2 AS twice FROM part""")
def select_expression(spark, d):
    rows = pattern(graph(spark, d, "part"), "?part", "<part/retailprice>", "?price", as_type="double")
    return m.select(rows, "part", twice=F.col("price") * 2)


@query("""SELECT '<part/' || p_partkey || '>' AS part, p_retailprice AS price,
CASE WHEN p_retailprice > 1000 THEN 'high' ELSE 'low' END AS band FROM part""")
def bind_column(spark, d):
    rows = pattern(graph(spark, d, "part"), "?part", "<part/retailprice>", "?price", as_type="double")
    return m.bind(rows, "band", F.when(F.col("price") > 1000, "high").otherwise("low"))


@query("""SELECT '<events/' || event_id || '>' AS e, value AS v FROM events WHERE value > 20 AND NOT (value < 30)""")
def filter_logical(spark, d):
    rows = pattern(graph(spark, d, "events"), "?e", "<events/value>", "?v", as_type="double")
    return m.filter_rows(rows, (F.col("v") > 20) & ~(F.col("v") < 30))


@query("""SELECT '<labels/' || doc_id || '>' AS l FROM labels WHERE toxic <> 0""")
def filter_effective_boolean(spark, d):
    rows = pattern(graph(spark, d, "labels"), "?l", "<labels/toxic>", "?t", as_type="long")
    return m.filter_rows(rows, F.col("t")).select("l")


@query("""SELECT '<part/' || p_partkey || '>' AS part, p_size AS size FROM part WHERE p_size IN (3, 9, 27)""")
def filter_in(spark, d):
    rows = pattern(graph(spark, d, "part"), "?part", "<part/size>", "?size", as_type="long")
    return rows.where(F.col("size").isin(3, 9, 27))


@query("""SELECT '<part/' || p_partkey || '>' AS part, p_size AS size FROM part WHERE p_size NOT IN (3, 9, 27)""")
def filter_not_in(spark, d):
    rows = pattern(graph(spark, d, "part"), "?part", "<part/size>", "?t", as_type="term")
    options = [terms.constant(f'"{n}"{XSD_INT}') for n in (3, 9, 27)]
    return rows.where(compare.term_not_in("t", *options)).select("part", F.col("t.i").alias("size"))


@query("""SELECT s, p, o FROM (
SELECT '<part/' || p_partkey || '>' AS s, '<part/size>' AS p, p_size::DOUBLE AS o FROM part WHERE p_size >= 25
UNION ALL SELECT '<part/' || p_partkey || '>', '<part/partkey>', p_partkey::DOUBLE FROM part WHERE p_partkey >= 25
UNION ALL SELECT '<part/' || p_partkey || '>', '<part/retailprice>', p_retailprice FROM part WHERE p_retailprice >= 25)""")
def filter_mixed_types(spark, d):
    rows = graph(spark, d, "part").quads().where(compare.term_ge("o_term", terms.constant(f'"25"{XSD_INT}')))
    return rows.select("s", "p", F.col("o_term.d").alias("o"))


@query("""SELECT '<documents/' || doc_id || '>' AS doc, lang FROM documents WHERE lang IN ('en', 'fr')""")
def filter_language(spark, d):
    rows = pattern(graph(spark, d, "documents"), "?doc", "<documents/text>", "?t", as_type="term")
    return m.language_filter(rows, "t", "en", "fr").select("doc", F.col("t.lang").alias("lang"))


@query("""SELECT '<customer/' || c_custkey || '>' AS c, o.n AS n FROM customer JOIN
(SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12) o ON o_custkey = c_custkey""")
def subquery_grouped(spark, d):
    g = graph(spark, d, "customer", "orders")
    busy = (pattern(g, "?o", "<orders/custkey>", "?c").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
            .where("n > 12"))
    return pattern(g, "?c", RDF_TYPE, "<customer>").join(busy, "c")


@query("""SELECT '<customer/' || c_custkey || '>' AS x, c_name AS name, NULL::DOUBLE AS bal FROM customer
UNION ALL SELECT '<supplier/' || s_suppkey || '>', NULL, s_acctbal FROM supplier""")
def union_unbound(spark, d):
    g = graph(spark, d, "customer", "supplier")
    return m.union(pattern(g, "?x", "<customer/name>", "?name", as_type="string"),
                   pattern(g, "?x", "<supplier/acctbal>", "?bal", as_type="double"))


@query("""SELECT DISTINCT p_brand AS brand, p_type AS type FROM part""")
def distinct_columns(spark, d):
    g = graph(spark, d, "part")
    rows = bgp(g, [("?x", "<part/brand>", "?brand", "string"), ("?x", "<part/type>", "?type", "string")])
    return m.distinct(rows, "brand", "type")


@query("""SELECT p_brand AS brand FROM part""")
def reduced_rows(spark, d):
    return m.reduced(pattern(graph(spark, d, "part"), "?x", "<part/brand>", "?brand", as_type="string").select("brand"))


@query("""SELECT '<orders/' || o_orderkey || '>' AS o, o_totalprice AS price FROM orders
ORDER BY o_totalprice DESC, o LIMIT 25 OFFSET 10""")
def order_limit_offset(spark, d):
    rows = pattern(graph(spark, d, "orders"), "?o", "<orders/totalprice>", "?price", as_type="double")
    return m.limit(m.order_by(rows, ("price", "desc"), "o"), 25, offset=10)


@query("""SELECT s, txt, lag(s) OVER w AS before FROM (
SELECT '<customer/' || c_custkey || '>' AS s, 2 AS rank, c_custkey::DOUBLE AS num, NULL AS txt FROM customer
UNION ALL SELECT '<customer/' || c_custkey || '>', 3, NULL, c_mktsegment FROM customer)
WINDOW w AS (PARTITION BY rank, txt ORDER BY num NULLS FIRST, s)""")
def order_mixed_types(spark, d):
    """The whole table in the order of a column that mixes numbers and texts: each row with the one before it.

    Neighbours are looked up within equal kinds and texts, so no task sees the whole order.
    """
    rows = m.order_by(graph(spark, d, "customer").quads(["<customer/custkey>", "<customer/mktsegment>"]).select("s", "o_term"), "o_term", "s")
    text = F.when(F.col("o_term.d").isNull(), F.col("o_term.lex"))
    order = Window.partitionBy(F.col("o_term.d").isNull(), text).orderBy(compare.sort_key("o_term").asc_nulls_first(), F.col("s"))
    return rows.select("s", text.alias("txt"), F.lag("s").over(order).alias("before"))


@query("""SELECT count(*) > 0 AS result FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal < -900""")
def ask_pattern(spark, d):
    rows = bgp(graph(spark, d, "customer", "orders"),
               [("?c", "<customer/acctbal>", "?b", "double"), ("?o", "<orders/custkey>", "?c")])
    return m.ask(rows.where("b < -900"))
