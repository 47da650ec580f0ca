"""Property paths, transitive paths, path search, DESCRIBE and CONSTRUCT."""

from pyspark.sql import Window, functions as F

from catalog.registry import graph, query, table, table_map
from catalog.scans import _two_graphs
from graphloom.functions.terms import DEFAULT_GRAPH, RDF_TYPE
from graphloom.operators import construct as cs
from graphloom.operators.scan import pattern
from graphloom.operators.updates import with_terms
from graphloom.plans import property_paths as pp
from graphloom.plans.bgp import bgp
from graphloom.plans.describe import describe
from graphloom.plans.path_search import path_search
from graphloom.plans.transitive import reach
from graphloom.sources.mapping import MappedGraph

_UP = pp.alternatives("<orders/custkey>", "<customer/nationkey>", "<nation/regionkey>")
_UP_SQL = """e AS (SELECT '<orders/' || o_orderkey || '>' AS s, '<customer/' || o_custkey || '>' AS t FROM orders
UNION ALL SELECT '<customer/' || c_custkey || '>', '<nation/' || c_nationkey || '>' FROM customer
UNION ALL SELECT '<nation/' || n_nationkey || '>', '<region/' || n_regionkey || '>' FROM nation) """


_DOUBLE = "'\"' || CASE WHEN {0} = floor({0}) THEN {0}::BIGINT::VARCHAR ELSE {0}::VARCHAR END || '\"^^<http://www.w3.org/2001/XMLSchema#double>'"
_INTEGER = "'\"' || {0} || '\"^^<http://www.w3.org/2001/XMLSchema#integer>'"


def _cells_sql(name: str, key: str, /, **cells: str) -> str:
    """All quads of a table: predicate -> SQL of its object."""
    predicates = ", ".join(f"'<{name}/{p}>'" for p in cells)
    return (f"SELECT '<{name}/' || {key} || '>' AS s, unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', {predicates}]) AS p, "
            f"unnest(['<{name}>', {', '.join(cells.values())}]) AS o FROM {name}")


_NATION_CELLS = _cells_sql("nation", "n_nationkey", nationkey=_INTEGER.format("n_nationkey"), name="'\"' || n_name || '\"'", regionkey="'<region/' || n_regionkey || '>'")
_CUSTOMER_CELLS = _cells_sql(
    "customer", "c_custkey", custkey=_INTEGER.format("c_custkey"), name="'\"' || c_name || '\"'", nationkey="'<nation/' || c_nationkey || '>'",
    acctbal=_DOUBLE.format("c_acctbal"), mktsegment="'\"' || c_mktsegment || '\"'")
_ORDER_CELLS = _cells_sql(
    "orders", "o_orderkey", orderkey=_INTEGER.format("o_orderkey"), custkey="'<customer/' || o_custkey || '>'", orderstatus="'\"' || o_orderstatus || '\"'",
    totalprice=_DOUBLE.format("o_totalprice"), orderpriority="'\"' || o_orderpriority || '\"'",
    orderdate="'\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '\"^^<http://www.w3.org/2001/XMLSchema#dateTime>'")
#: All nodes of the graph of the three tables.
_NODES_SQL = f""", q AS ({_NATION_CELLS} UNION ALL {_CUSTOMER_CELLS} UNION ALL {_ORDER_CELLS}), n AS (SELECT s AS x FROM q UNION SELECT o FROM q) """


@query("""SELECT '<orders/' || o_orderkey || '>' AS start, '<nation/' || c_nationkey || '>' AS "end"
FROM orders JOIN customer ON o_custkey = c_custkey""")
def path_sequence(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer"), pp.sequence("<orders/custkey>", "<customer/nationkey>"))


@query("""SELECT '<supplier/' || s_suppkey || '>' AS start, '<customer/' || c_custkey || '>' AS "end"
FROM supplier JOIN customer ON s_nationkey = c_nationkey""")
def path_inverse(spark, d):
    path = pp.sequence("<supplier/nationkey>", ~pp.Step("<customer/nationkey>"))
    return pp.edges(graph(spark, d, "supplier", "customer"), path)


@query("WITH " + _UP_SQL + """SELECT s AS start, t AS "end" FROM e""")
def path_alternative(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP)


@query(f"""WITH q AS ({_NATION_CELLS} UNION ALL {_CUSTOMER_CELLS})
SELECT s AS start, o AS "end" FROM q WHERE p <> '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>'
UNION ALL SELECT o, s FROM q WHERE p NOT IN ('<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', '<nation/regionkey>', '<customer/nationkey>')""")
def path_negated(spark, d):
    return pp.edges(graph(spark, d, "nation", "customer"), pp.Negated((RDF_TYPE,), (RDF_TYPE, "<nation/regionkey>", "<customer/nationkey>")))


@query("WITH RECURSIVE " + _UP_SQL + """, r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s)
SELECT s AS start, t AS "end" FROM r""")
def transitive_plus(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP.plus())


@query("WITH RECURSIVE " + _UP_SQL + _NODES_SQL + """,
r AS (SELECT x AS s, x AS t FROM n UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s)
SELECT s AS start, t AS "end" FROM r""")
def transitive_star(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP.star())


@query("WITH " + _UP_SQL + """, h2 AS (SELECT DISTINCT a.s, b.t FROM e a JOIN e b ON a.t = b.s),
h3 AS (SELECT DISTINCT h2.s, e.t FROM h2 JOIN e ON h2.t = e.s)
SELECT s AS start, t AS "end" FROM h2 UNION SELECT s, t FROM h3""")
def transitive_bounded(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP.repeat(2, 3))


@query("WITH " + _UP_SQL + _NODES_SQL + """SELECT s AS start, t AS "end" FROM e UNION SELECT x, x FROM n""")
def transitive_optional(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP.repeat(0, 1))


@query("WITH RECURSIVE " + _UP_SQL + """, r AS (SELECT s, t FROM e WHERE t = '<region/2>'
UNION SELECT e.s, r.t FROM e JOIN r ON e.t = r.s) SELECT s AS start, t AS "end" FROM r""")
def transitive_bound_end(spark, d):
    return pp.edges(graph(spark, d, "orders", "customer", "nation"), _UP.plus(), end="<region/2>")


_NEXT = """nx AS (SELECT * FROM (SELECT o_orderkey AS s, lead(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority
ORDER BY o_orderdate, o_orderkey) AS t FROM orders) WHERE t IS NOT NULL) """


def _next_orders(spark, d):
    """The order that the same customer placed next with the same priority."""
    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("start"), F.lead("o_orderkey").over(w).alias("end"))
    return rows.where("end is not null")


@query("WITH RECURSIVE " + _NEXT + """, r AS (SELECT s, t FROM nx UNION SELECT r.s, nx.t FROM r JOIN nx ON r.t = nx.s)
SELECT s AS start, t AS "end" FROM r""")
def transitive_chains(spark, d):
    return reach(_next_orders(spark, d))


_TRADE = """tr AS (SELECT DISTINCT c_nationkey AS s, s_nationkey AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey) """


def _trade(spark, d):
    """Nations of customers to the nations of the suppliers from which they bought; has cycles."""
    lots = table(spark, d, "lineitem")
    rows = (lots.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")))
    return rows.select(F.col("c_nationkey").alias("start"), F.col("s_nationkey").alias("end")).dropDuplicates()


@query("WITH RECURSIVE " + _TRADE + """, r AS (SELECT s, t FROM tr UNION SELECT r.s, tr.t FROM r JOIN tr ON r.t = tr.s)
SELECT s AS start, t AS "end" FROM r""")
def transitive_cycles(spark, d):
    return reach(_trade(spark, d))


def _paths_sql(edges: str, first: str, depth: int, hit: str = "true", rank: str = "") -> str:
    return f"""WITH RECURSIVE {edges}, p AS (SELECT s AS source, t AS last, [s, t] AS nodes,
['{{"start":' || s || ',"end":' || t || ',"copy":1}}'] AS js FROM {first} WHERE s <> t
UNION ALL SELECT source, x.t, list_append(nodes, x.t), list_append(js, '{{"start":' || x.s || ',"end":' || x.t || ',"copy":1}}')
FROM p JOIN {edges.split(' AS ')[0]} x ON x.s = p.last WHERE NOT list_contains(nodes, x.t) AND len(js) < {depth}),
h AS (SELECT *, md5(array_to_string(js, '|')) AS path FROM p WHERE {hit}),
k AS (SELECT *, row_number() OVER (PARTITION BY source, last ORDER BY len(js), path) AS rk FROM h)
SELECT source, last AS target, path, i - 1 AS edge, nodes[i] AS start, nodes[i + 1] AS "end"
FROM (SELECT *, unnest(range(1, len(nodes))) AS i FROM k {rank})"""


@query(_paths_sql(_NEXT.strip(), "nx", 1000))
def path_search_all(spark, d):
    return path_search(_next_orders(spark, d))


@query(_paths_sql(_TRADE.strip(), "tr", 3, "last IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)"))
def path_search_targets_max_depth(spark, d):
    ends = table(spark, d, "nation").where("n_regionkey = 1").select("n_nationkey")
    return path_search(_trade(spark, d), targets=ends, max_depth=3)


@query(# No path beyond three edges is among the two shortest: every pair of nations has several of two.
         _paths_sql(_TRADE.strip(), "(SELECT tr.* FROM tr JOIN nation ON s = n_nationkey WHERE n_regionkey = 0)", 3, "true", "WHERE rk <= 2"))
def path_search_per_target(spark, d):
    begins = table(spark, d, "nation").where("n_regionkey = 0").select("n_nationkey")
    return path_search(_trade(spark, d), sources=begins, paths_per_target=2)


@query(_paths_sql(_NEXT.strip(), "nx", 1000, "(len(js) = 2 OR len(js) = 5) AND (source + last) % 3 <> 0"))
def path_search_pairs(spark, d):
    """Paths from each order to the customer's second and fifth next one, for pairs by their keys; others are not searched."""
    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderdate", "o_orderkey")
    ahead = table(spark, d, "orders").select(F.col("o_orderkey").alias("a"), *[F.lead("o_orderkey", n).over(w).alias(f"b{n}") for n in (2, 5)])
    pairs = ahead.select("a", F.explode(F.array("b2", "b5")).alias("b")).where("b is not null and (a + b) % 3 <> 0")
    return path_search(_next_orders(spark, d), pairs=pairs)


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS s, lead(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority
ORDER BY o_orderdate, o_orderkey) AS t, o_totalprice AS price FROM orders), x AS (SELECT * FROM e WHERE t IS NOT NULL),
p AS (SELECT s AS source, t AS target, [s, t] AS nodes, [price] AS prices FROM x
UNION ALL SELECT source, x.t, list_append(nodes, x.t), list_append(prices, x.price) FROM p JOIN x ON p.target = x.s)
SELECT source, target, i - 1 AS edge, nodes[i] AS start, nodes[i + 1] AS "end", prices[i] AS price
FROM (SELECT *, unnest(range(1, len(nodes))) AS i FROM p)""")
def path_search_edge_properties(spark, d):
    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("start"), F.lead("o_orderkey").over(w).alias("end"), F.col("o_totalprice").alias("price"))
    return path_search(rows.where("end is not null"), edge_properties=["price"]).drop("path")


@query(f"""WITH rich AS (SELECT * FROM customer WHERE c_acctbal > 9000)
SELECT * FROM ({_CUSTOMER_CELLS}) WHERE s IN (SELECT '<customer/' || c_custkey || '>' FROM rich)
UNION ALL SELECT '<customer/' || c_custkey || '>', '<customer/address>', '_:a' || c_custkey FROM rich
UNION ALL SELECT '_:a' || c_custkey, '<address/nation>', '_:n' || c_nationkey FROM rich
UNION ALL SELECT DISTINCT '_:n' || n_nationkey, '<nation/name>', '"' || n_name || '"' FROM nation JOIN rich ON c_nationkey = n_nationkey""")
def describe_blank_nodes(spark, d):
    # Addresses and nations as blank nodes: customer -> address -> nation.
    customers = table(spark, d, "customer")
    base = graph(spark, d, "customer").quads().select("s", "p", "o")
    address = F.concat(F.lit("_:a"), F.col("c_custkey"))
    nation = F.concat(F.lit("_:n"), F.col("c_nationkey"))
    who = F.concat(F.lit("<customer/"), F.col("c_custkey"), F.lit(">"))
    quads = (base.unionByName(customers.select(who.alias("s"), F.lit("<customer/address>").alias("p"), address.alias("o")))
             .unionByName(customers.select(address.alias("s"), F.lit("<address/nation>").alias("p"), nation.alias("o")))
             .unionByName(table(spark, d, "nation").select(
                 F.concat(F.lit("_:n"), F.col("n_nationkey")).alias("s"), F.lit("<nation/name>").alias("p"),
                 F.concat(F.lit('"'), F.col("n_name"), F.lit('"')).alias("o"))))
    return describe(quads, customers.where("c_acctbal > 9000").select(who.alias("node")))


@query("""SELECT '<customer/' || c_custkey || '>' AS s, '<buys-with>' AS p, '"' || o_orderpriority || '"' AS o
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def construct_distinct(spark, d):
    rows = pattern(graph(spark, d, "orders"), "?o", "<orders/custkey>", "?c").join(
        pattern(graph(spark, d, "orders"), "?o", "<orders/orderpriority>", "?prio"), "o")
    return cs.construct(rows, [("?c", "<buys-with>", "?prio")], distinct=True)


@query("""SELECT '<documents/' || doc_id || '>' AS doc, '"' || quality || '"^^<http://www.w3.org/2001/XMLSchema#integer>' AS q,
1 AS about FROM documents LEFT JOIN labels USING (doc_id)""")
def construct_blank_nodes(spark, d):
    g = graph(spark, d, "documents", "labels")
    docs = pattern(g, "?doc", "<documents/source>", "?src")
    quality = pattern(g, "?l", "<labels/doc_id>", "?doc").join(pattern(g, "?l", "<labels/quality>", "?q"), "l").drop("l")
    rows = docs.join(quality, "doc", "left")
    # An unbound quality skips its triple; each row has a blank node of its own.
    out = cs.construct(rows, [("_:x", "<about>", "?doc"), ("_:x", "<quality>", "?q")], row_key=["doc"])
    value = lambda p: F.max(F.when(F.col("p") == p, F.col("o")))
    return out.groupBy("s").agg(value("<about>").alias("doc"), value("<quality>").alias("q"),
                                F.count(F.when(F.col("p") == "<about>", 1)).alias("about")).drop("s")


def _next_graph(spark, d):
    """Orders with their customers, the next order of each, and the customers' nations, as stored quads."""
    iri = lambda name, key: F.concat(F.lit(f"<{name}/"), F.col(key), F.lit(">"))
    nexts = _next_orders(spark, d).select(iri("orders", "start").alias("s"), F.lit("<next>").alias("p"), iri("orders", "end").alias("o"))
    maps = graph(spark, d, "orders", "customer").quads(["<orders/custkey>", "<customer/nationkey>"])
    return with_terms(nexts.withColumn("g", F.lit(DEFAULT_GRAPH))).unionByName(maps.select("s", "p", "o", "o_term", "g"))


@query("WITH RECURSIVE " + _NEXT + """, r AS (SELECT s, t FROM nx JOIN orders ON s = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey = 7 UNION SELECT r.s, nx.t FROM r JOIN nx ON r.t = nx.s)
SELECT '<customer/' || o_custkey || '>' AS c, '<orders/' || r.s || '>' AS o, '<orders/' || r.t || '>' AS later
FROM r JOIN orders ON r.s = o_orderkey""")
def transitive_bound_table(spark, d):
    """Later orders of one nation's customers: the search begins at the orders that the other patterns find."""
    return bgp(_next_graph(spark, d), [("?c", "<customer/nationkey>", "<nation/7>"), ("?o", "<orders/custkey>", "?c"),
                                       ("?o", pp.Step("<next>").plus(), "?later")])


@query("WITH RECURSIVE " + _NEXT + """, r AS (SELECT o_orderkey AS s, o_orderkey AS t FROM orders UNION SELECT r.s, nx.t FROM r JOIN nx ON r.t = nx.s)
SELECT '<customer/' || o_custkey || '>' AS start, '<orders/' || r.t || '>' AS "end" FROM orders JOIN r ON r.s = o_orderkey""")
def path_sequence_repeat(spark, d):
    """From customers to their orders and all that follow: the orders seed the repetition."""
    return pp.edges(_next_graph(spark, d), ~pp.Step("<orders/custkey>") / pp.Step("<next>").star())


@query("""SELECT '<orders/' || a.o_orderkey || '>' AS o, '<customer/' || a.o_custkey || '>' AS c, g,
'"' || a.o_orderkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>' AS k
FROM (SELECT o_orderkey, o_custkey, '<graph/late>' AS g FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
UNION ALL SELECT o_orderkey, o_custkey, '<graph/urgent>' FROM orders WHERE o_orderpriority LIKE '1%') a""")
def bgp_graph_variable(spark, d):
    """Two patterns that must match within one named graph."""
    return bgp(_two_graphs(spark, d), [("?o", "<orders/custkey>", "?c"), ("?o", "<orders/orderkey>", "?k")], g="?g")
