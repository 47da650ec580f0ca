"""Readers, sinks, updates, the quad store, views and the change feed."""

import uuid

from pyspark.sql import functions as F

from catalog.registry import graph, query, table, table_map
from graphloom.functions import terms
from graphloom.operators import updates as up, views
from graphloom.operators.scan import pattern
from graphloom.plans.bgp import bgp
from graphloom.session import cut_lineage, shared_folder
from graphloom.sources import ntriples as nt, sinks
from graphloom.sources.mapping import MappedGraph
from graphloom.sources.quadstore import QuadStore
from graphloom.sources.store import read_quads, write_quads
from graphloom.streaming.feed import start_feed


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}"


_ORDER_SPO = """SELECT '<orders/' || o_orderkey || '>' AS s, unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>',
'<orders/orderkey>', '<orders/custkey>', '<orders/orderstatus>', '<orders/orderdate>', '<orders/orderpriority>', '<orders/totalprice>']) AS p,
unnest(['<orders>', '"' || o_orderkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>', '<customer/' || o_custkey || '>',
'"' || o_orderstatus || '"', '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"^^<http://www.w3.org/2001/XMLSchema#dateTime>',
'"' || o_orderpriority || '"', '"' || CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT::VARCHAR ELSE o_totalprice::VARCHAR END || '"^^<http://www.w3.org/2001/XMLSchema#double>']) AS o FROM orders"""


def _orders(spark, d, **changes):
    return MappedGraph([table_map(spark, d, "orders", **changes)])


@query("SELECT s, p, o, '<graph/orders>' AS g FROM (" + _ORDER_SPO + ")")
def nquads_round_trip(spark, d):
    path = _folder(spark)
    sinks.write_nquads(_orders(spark, d, graph="<graph/orders>").quads(), path)
    return nt.read_quads_text(spark, path)[0].select("s", "p", "o", "g")


@query("""SELECT '<documents/' || doc_id || '>' AS s, text AS lex, lang FROM documents""")
def ntriples_gzip_round_trip(spark, d):
    # Whole texts with quotes, line ends and backslashes.
    path = _folder(spark)
    sinks.write_ntriples(graph(spark, d, "documents").quads(["<documents/text>"]), path, compression="gzip")
    quads, _ = nt.read_quads_text(spark, path)
    return quads.select("s", F.col("o_term.lex").alias("lex"), F.col("o_term.lang").alias("lang"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN conv_id % 4 = 1 THEN 'RDF* is not supported'
WHEN conv_id % 4 = 2 THEN 'not a valid statement' WHEN conv_id % 4 = 3 THEN 'not a valid literal' END AS reason FROM conversations)
WHERE reason IS NOT NULL GROUP BY reason""")
def reader_rejects(spark, d):
    text = terms.escape(F.col("text"))
    k = F.col("conv_id") % 4
    start = F.concat(F.lit("<c/"), F.col("conv_id"), F.lit("> <says> "))
    line = (F.when(k == 0, F.concat(start, F.lit('"'), text, F.lit('"@fr . # said')))
            .when(k == 1, F.concat(F.lit("<< <a> <b> <c> >> <says> \""), text, F.lit('" .')))
            .when(k == 2, F.concat(start, text, F.lit('" .')))
            .otherwise(F.concat(start, F.lit('"a" "'), text, F.lit('" .'))))
    rejects = nt.parse_lines(table(spark, d, "conversations").select(line.alias("value")))[1]
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT '<nation/' || c_nationkey || '>' AS s, '<serves>' AS p, '"' || c_mktsegment || '"' AS o, '<graph/customers>' AS g FROM customer
UNION ALL SELECT '<supplier/' || s_suppkey || '>', '<supplier/nationkey>', '<nation/' || s_nationkey || '>', '<graph/suppliers>' FROM supplier""")
def several_inputs(spark, d):
    a, b = _folder(spark), _folder(spark)
    segments = bgp(graph(spark, d, "customer"), [("?c", "<customer/mktsegment>", "?o"), ("?c", "<customer/nationkey>", "?s")])
    sinks.write_ntriples(segments.select("s", F.lit("<serves>").alias("p"), "o"), a)
    sinks.write_ntriples(graph(spark, d, "supplier").quads(["<supplier/nationkey>"]), b)
    quads, _ = nt.read_quads_text(spark, [nt.Input(a, "<graph/customers>"), nt.Input(b, "<graph/suppliers>")])
    return quads.select(up.KEY)


@query("""SELECT '<orders/' || o_orderkey || '>' AS s, '<orders/custkey>' AS p, '<customer/' || o_custkey || '>' AS o, '<graph/loaded>' AS g FROM orders
UNION ALL SELECT '<customer/' || c_custkey || '>', '<customer/nationkey>', '<nation/' || c_nationkey || '>', '<graph/loaded>' FROM customer
UNION ALL SELECT '<region/' || r_regionkey || '>', '<region/name>', '"' || r_name || '"', '<urn:graph:default>' FROM region""")
def load_into_graph(spark, d):
    path = _folder(spark)
    g = graph(spark, d, "orders", "customer", "region")
    sinks.write_nquads(g.quads(["<orders/custkey>", "<customer/nationkey>"]), path)
    loaded = nt.load_document(spark, path, "<graph/loaded>")
    nothing = nt.load_document(spark, path + "-missing", "<graph/loaded>", silent=True)
    state = up.apply_update(g.quads(["<region/name>"]), loaded.unionByName(nothing))
    return state.select(up.KEY)


def _mixed_rows(spark, d):
    g = graph(spark, d, "part", "supplier")
    rows = bgp(g, [("?x", "<part/name>", "?name", "term"), ("?x", "<part/size>", "?size", "long")])
    return rows.unionByName(pattern(g, "?x", "<supplier/name>", "?name", as_type="term"), allowMissingColumns=True)


@query("""SELECT 'part/' || p_partkey || ',' || p_name || ',' || p_size AS line FROM part
UNION ALL SELECT 'supplier/' || s_suppkey || ',' || s_name || ',' FROM supplier""")
def sink_csv(spark, d):
    path = _folder(spark)
    sinks.write_csv(_mixed_rows(spark, d).select("x", "name", "size"), path)
    return spark.read.text(path).where("value <> 'x,name,size'").select(F.col("value").alias("line"))


@query("""SELECT '<part/' || p_partkey || '>' || chr(9) || '"' || p_name || '"' || chr(9) || p_size AS line FROM part
UNION ALL SELECT '<supplier/' || s_suppkey || '>' || chr(9) || '"' || s_name || '"' || chr(9) FROM supplier""")
def sink_tsv(spark, d):
    path = _folder(spark)
    sinks.write_tsv(_mixed_rows(spark, d).select("x", "name", "size"), path)
    return spark.read.text(path).where(~F.col("value").startswith("?")).select(F.col("value").alias("line"))


@query("""SELECT '{"x":{"value":"part/' || p_partkey || '","type":"uri"},"name":{"value":"' || p_name || '","type":"literal"},' ||
'"size":{"value":"' || p_size || '","type":"literal","datatype":"http://www.w3.org/2001/XMLSchema#integer"}}' AS line FROM part
UNION ALL SELECT '{"x":{"value":"supplier/' || s_suppkey || '","type":"uri"},"name":{"value":"' || s_name || '","type":"literal"}}' FROM supplier""")
def sink_json_bindings(spark, d):
    path = _folder(spark)
    sinks.write_bindings(_mixed_rows(spark, d).select("x", "name", "size"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT s, o FROM (" + _ORDER_SPO + ") WHERE p = '<orders/custkey>'")
def stored_quads_scan(spark, d):
    path = _folder(spark)
    write_quads(_orders(spark, d).quads(), path)
    return pattern(read_quads(spark, path), "?s", "<orders/custkey>", "?o")


_CELLS = """SELECT '<customer/' || c_custkey || '>' AS s, unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', '<customer/custkey>', '<customer/name>',
'<customer/nationkey>', '<customer/acctbal>', '<customer/mktsegment>']) AS p, unnest(['<customer>',
'"' || c_custkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>', '"' || c_name || '"', '<nation/' || c_nationkey || '>',
'"' || CASE WHEN c_acctbal = floor(c_acctbal) THEN c_acctbal::BIGINT::VARCHAR ELSE c_acctbal::VARCHAR END || '"^^<http://www.w3.org/2001/XMLSchema#double>',
'"' || c_mktsegment || '"']) AS o FROM customer WHERE c_custkey = 7"""


_STORES: dict[tuple[str, str], QuadStore] = {}


def _changed_store(spark, d) -> QuadStore:
    """Orders and customers, clustered, and changes that no base holds yet: built on first use in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key in _STORES:
        return _STORES[key]
    store = _STORES[key] = QuadStore(spark, _folder(spark)).create(graph(spark, d, "orders", "customer").quads())
    store.update(inserts=up.quads_of(spark, [("<customer/7>", "<vip>", '"yes"'), ("<list>", "<member>", "<customer/7>")]),
                 deletes=up.quads_of(spark, [("<customer/7>", "<customer/nationkey>", f"<nation/{n}>") for n in range(25)]))
    return store


@query("SELECT p, o FROM (" + _CELLS + """) WHERE p <> '<customer/nationkey>' UNION ALL SELECT '<vip>', '"yes"'""")
def scan_subject_bound(spark, d):
    """All about one subject, from the copy that is clustered by subject, with the changes since."""
    return pattern(_changed_store(spark, d).graph(), "<customer/7>", "?p", "?o")


@query("""SELECT '<orders/' || o_orderkey || '>' AS s, '<orders/custkey>' AS p FROM orders WHERE o_custkey = 7
UNION ALL SELECT '<list>', '<member>'""")
def scan_object_bound(spark, d):
    """All that points to one object, from the copy that is clustered by object, with the changes since."""
    return pattern(_changed_store(spark, d).graph(), "?s", "?p", "<customer/7>")


@query("SELECT 's' AS what, p, o AS x FROM (" + _CELLS + """) UNION ALL
SELECT 'o', '<orders/custkey>', '<orders/' || o_orderkey || '>' FROM orders WHERE o_custkey = 7
UNION ALL SELECT 'n', '<orders/orderstatus>', '<orders/' || o_orderkey || '>' FROM orders WHERE o_orderstatus = 'F'""")
def scan_mapped_constants(spark, d):
    """A constant subject or object with a variable predicate on mapped tables: filters on the key and on the columns."""
    g = graph(spark, d, "orders", "customer", "nation")
    parts = [pattern(g, "<customer/7>", "?p", "?x"), pattern(g, "?x", "?p", "<customer/7>"), pattern(g, "?x", "?p", '"F"')]
    whats = [p.select(F.lit(w).alias("what"), "p", "x") for w, p in zip("son", parts)]
    return whats[0].unionByName(whats[1]).unionByName(whats[2])


# --- updates --------------------------------------------------------------------------------------------------------

def _status(spark, d):
    return graph(spark, d, "orders").quads(["<orders/orderstatus>"])


_STATUS = "SELECT '<orders/' || o_orderkey || '>' AS s, '<orders/orderstatus>' AS p, '\"' || {} || '\"' AS o FROM orders"


@query(_STATUS.format("o_orderstatus") + " WHERE o_orderkey <> 2 UNION SELECT '<orders/new>', '<orders/orderstatus>', '\"N\"'"
       " UNION SELECT '<orders/2>', '<orders/orderstatus>', '\"Q\"'")
def update_insert_delete_data(spark, d):
    inserts = up.quads_of(spark, [("<orders/new>", "<orders/orderstatus>", '"N"'), ("<orders/2>", "<orders/orderstatus>", '"Q"')])
    old = [("<orders/2>", "<orders/orderstatus>", f'"{x}"') for x in "FOP"]
    # A quad that is absent can be deleted without effect.
    deletes = up.quads_of(spark, [*old, ("<orders/2>", "<absent>", '"x"')])
    return up.apply_update(_status(spark, d), inserts, deletes).select("s", "p", "o")


@query(_STATUS.format("CASE WHEN o_totalprice > 300000 THEN 'big' ELSE o_orderstatus END"))
def update_where(spark, d):
    g = graph(spark, d, "orders")
    rows = bgp(g, [("?x", "<orders/totalprice>", "?p", "double"), ("?x", "<orders/orderstatus>", "?st")]).where("p > 300000")
    return up.update_where(_status(spark, d), rows.select("x", "st"), insert=[("?x", "<orders/orderstatus>", '"big"')],
                           delete=[("?x", "<orders/orderstatus>", "?st")]).select("s", "p", "o")


@query(_STATUS.format("o_orderstatus") + " WHERE o_totalprice <= 300000")
def update_delete_where(spark, d):
    g = graph(spark, d, "orders")
    rows = bgp(g, [("?x", "<orders/totalprice>", "?p", "double"), ("?x", "<orders/orderstatus>", "?st")]).where("p > 300000")
    return up.update_where(_status(spark, d), rows, delete=[("?x", "<orders/orderstatus>", "?st")]).select("s", "p", "o")


@query("""SELECT '<nation/' || n_nationkey || '>' AS s, '<serves>' AS p, '<customer/' || c_custkey || '>' AS o, '<graph/out>' AS g
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1""")
def update_using_graph(spark, d):
    maps = [table_map(spark, d, "customer", graph="<graph/in>"), table_map(spark, d, "nation", graph="<graph/in>")]
    g = MappedGraph(maps).in_graphs(lambda name: name == "<graph/in>")
    rows = bgp(g, [("?n", "<nation/regionkey>", "<region/1>"), ("?c", "<customer/nationkey>", "?n")])
    return up.update_where(up.none(spark), rows, insert=[("?n", "<serves>", "?c", "<graph/out>")]).select("s", "p", "o", "g")


def _graphs(spark, d):
    parts = [table_map(spark, d, "customer", graph="<graph/customer>"), table_map(spark, d, "supplier", graph="<graph/supplier>"),
             table_map(spark, d, "nation")]
    return MappedGraph(parts).quads(["<customer/nationkey>", "<supplier/nationkey>", "<nation/regionkey>"])


_GRAPHS = """WITH c AS (SELECT '<customer/' || c_custkey || '>' AS s, '<customer/nationkey>' AS p, '<nation/' || c_nationkey || '>' AS o FROM customer),
s AS (SELECT '<supplier/' || s_suppkey || '>' AS s, '<supplier/nationkey>' AS p, '<nation/' || s_nationkey || '>' AS o FROM supplier),
n AS (SELECT '<nation/' || n_nationkey || '>' AS s, '<nation/regionkey>' AS p, '<region/' || n_regionkey || '>' AS o FROM nation) """


def _in_graphs(*parts: str) -> str:
    """SQL of quads: each part is a table of _GRAPHS and the graph it is in."""
    names = {"customer": "<graph/customer>", "supplier": "<graph/supplier>", "default": "<urn:graph:default>"}
    return " UNION ALL ".join(f"SELECT s, p, o, '{names[g]}' AS g FROM {t}" for t, g in (x.split() for x in parts))


def _what(name: str, *parts: str) -> str:
    return f"SELECT '{name}' AS what, * FROM ({_in_graphs(*parts)})"


@query(_GRAPHS + _what("one", "s supplier", "n default") + " UNION ALL " + _what("default", "c customer", "s supplier")
       + " UNION ALL " + _what("named", "n default"))
def update_clear(spark, d):
    quads = _graphs(spark, d)
    parts = [("one", "<graph/customer>"), ("default", "DEFAULT"), ("named", "NAMED"), ("all", "ALL")]
    kept = [up.clear(quads, t).select(F.lit(w).alias("what"), *up.KEY) for w, t in parts]
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(kept[3])


@query(_GRAPHS + _in_graphs("c customer", "s supplier", "c supplier", "n default"))
def update_add_graph(spark, d):
    return up.add_graph(up.create(_graphs(spark, d), "<graph/x>"), "<graph/customer>", "<graph/supplier>").select(up.KEY)


@query(_GRAPHS + _in_graphs("c customer", "c supplier", "n default"))
def update_copy_graph(spark, d):
    return up.copy_graph(_graphs(spark, d), "<graph/customer>", "<graph/supplier>").select(up.KEY)


@query(_GRAPHS + _in_graphs("c supplier", "n default"))
def update_move_graph(spark, d):
    return up.move_graph(_graphs(spark, d), "<graph/customer>", "<graph/supplier>").select(up.KEY)


@query(_GRAPHS + _in_graphs("n customer", "n default", "s default"))
def graph_store_methods(spark, d):
    state = _graphs(spark, d)
    suppliers = up.graph_read(state, "<graph/supplier>")
    nations = up.graph_read(state, terms.DEFAULT_GRAPH)
    state = up.graph_insert(state, terms.DEFAULT_GRAPH, suppliers)
    state = up.graph_drop(state, "<graph/supplier>")
    return up.graph_replace(state, "<graph/customer>", nations).select(up.KEY)


_CHANGES = """WITH ch AS (SELECT CASE event_type WHEN 'error' THEN 'delete' ELSE 'insert' END AS op, '<user/' || user_id || '>' AS s,
'<does>' AS p, '"' || floor(value)::BIGINT || '"' AS o, '<urn:graph:default>' AS g, event_id AS seq FROM events),
last AS (SELECT s, p, o, g, arg_max(op, seq) AS op FROM ch GROUP BY ALL),
base AS (SELECT DISTINCT '<user/' || user_id || '>' AS s, '<does>' AS p, '"' || floor(value)::BIGINT || '"' AS o, '<urn:graph:default>' AS g
FROM events WHERE event_type IN ('error', 'click')) """
_STATE = """SELECT s, p, o, g FROM (SELECT * FROM base WHERE (s, o) NOT IN (SELECT (s, o) FROM last WHERE op = 'delete')
UNION SELECT s, p, o, g FROM last WHERE op = 'insert')"""


def _event_changes(events):
    return events.select(
        F.when(F.col("event_type") == "error", "delete").otherwise("insert").alias("op"),
        F.concat(F.lit("<user/"), F.col("user_id"), F.lit(">")).alias("s"), F.lit("<does>").alias("p"),
        F.concat(F.lit('"'), F.floor("value"), F.lit('"')).alias("o"), F.lit(terms.DEFAULT_GRAPH).alias("g"),
        F.col("event_id").alias("seq"))


def _event_base(spark, d):
    rows = table(spark, d, "events").where("event_type in ('error', 'click')")
    return up.with_terms(_event_changes(rows).select(up.KEY).dropDuplicates())


@query(_CHANGES + _STATE)
def delta_merge(spark, d):
    return up.merge_changes(_event_base(spark, d), _event_changes(table(spark, d, "events"))).select(up.KEY)


@query(_CHANGES + """SELECT (SELECT count(*) FROM last WHERE op = 'insert' AND (s, o) NOT IN (SELECT (s, o) FROM base)) AS n_inserted,
(SELECT count(*) FROM last WHERE op = 'delete' AND (s, o) IN (SELECT (s, o) FROM base)) AS n_deleted""")
def delta_statistics(spark, d):
    return up.delta_statistics(_event_base(spark, d), _event_changes(table(spark, d, "events")))


@query(_CHANGES + ", state AS (" + _STATE + """) SELECT '+' AS side, s, o FROM (SELECT s, o FROM state EXCEPT SELECT s, o FROM base)
UNION ALL SELECT '-', s, o FROM (SELECT s, o FROM base EXCEPT SELECT s, o FROM state)""")
def snapshot_diff(spark, d):
    base = _event_base(spark, d)
    new, gone = up.diff(base, up.merge_changes(base, _event_changes(table(spark, d, "events"))))
    return new.select(F.lit("+").alias("side"), "s", "o").unionByName(gone.select(F.lit("-").alias("side"), "s", "o"))


@query(_CHANGES + _STATE)
def store_compaction(spark, d):
    store = QuadStore(spark, _folder(spark)).create(_event_base(spark, d))
    store.log(_event_changes(table(spark, d, "events")), "all")
    store.compact()
    return store.current().select(up.KEY)


@query("SELECT '<region/' || r_regionkey || '>' AS s, '<region/name>' AS p, '\"' || r_name || '\"' AS o FROM region"
       " UNION ALL SELECT '<nation/' || n_nationkey || '>', '<nation/name>', '\"' || n_name || '\"' FROM nation WHERE n_regionkey <> 2"
       " UNION ALL SELECT '<customer/' || c_custkey || '>', '<customer/name>', '\"' || c_name || '\"' FROM customer")
def store_write_delete_files(spark, d):
    g = graph(spark, d, "region", "nation", "customer")
    store = QuadStore(spark, _folder(spark)).create(g.quads(["<region/name>", "<nation/name>"]))
    new, gone = _folder(spark), _folder(spark)
    sinks.write_ntriples(g.quads(["<customer/name>"]), new)
    asia = bgp(g, [("?s", "<nation/regionkey>", "<region/2>"), ("?s", "<nation/name>", "?o")])
    sinks.write_ntriples(asia.select("s", F.lit("<nation/name>").alias("p"), "o"), gone)
    store.update(inserts=nt.read_quads_text(spark, new)[0])
    store.update(deletes=nt.read_quads_text(spark, gone)[0])
    return store.current().select("s", "p", "o")


@query(_GRAPHS + _in_graphs("c customer", "s supplier", "n default"))
def store_clone(spark, d):
    store = QuadStore(spark, _folder(spark)).create(_graphs(spark, d))
    return store.clone(_folder(spark)).current().select(up.KEY)


@query(_CHANGES + _STATE)
def change_feed_stream(spark, d):
    store = QuadStore(spark, _folder(spark)).create(_event_base(spark, d))
    stream = (spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet")
              .parquet(d))
    feed = start_feed(_event_changes(stream), store, _folder(spark), available_now=True)
    feed.awaitTermination()
    return store.current().select(up.KEY)


@query(_CHANGES + _STATE)
def change_feed_two_sources(spark, d):
    """Two feeds into one store, a compaction between them, and the first feed once more with nothing new."""
    store = QuadStore(spark, _folder(spark)).create(_event_base(spark, d))
    stream = (spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet")
              .parquet(d))
    checkpoints = [_folder(spark), _folder(spark)]
    for part in (0, 1, 0):
        feed = start_feed(_event_changes(stream.where(F.col("user_id") % 2 == part)), store, checkpoints[part], available_now=True)
        feed.awaitTermination()
        if part == 0:
            store.compact()
    return store.current().select(up.KEY)


# --- views ----------------------------------------------------------------------------------------------------------

@query("""SELECT '<orders/' || o_orderkey || '>' AS order_iri, o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT'""")
def view_scan(spark, d):
    folder = _folder(spark)
    rows = bgp(graph(spark, d, "orders"), [
        ("?o", "<orders/orderpriority>", "?prio", "string"), ("?o", "<orders/totalprice>", "?price", "double")])
    views.write_view(rows.select("prio", "o", "price"), folder, "by-priority")
    return views.read_view(spark, folder, "by-priority", fixed={"prio": "1-URGENT"}, rename={"o": "order_iri"})


@query("""SELECT p_brand AS brand, count(*) AS n FROM part GROUP BY p_brand""")
def view_load_unload(spark, d):
    folder = _folder(spark)
    rows = pattern(graph(spark, d, "part"), "?x", "<part/brand>", "?brand", as_type="string")
    views.write_view(rows, folder, "brands")
    views.load_view(spark, folder, "brands")
    counts = spark.table("view_brands").groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    views.unload_view(spark, "brands")
    return counts


@query("""SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def pinned_result(spark, d):
    views.pin(pattern(graph(spark, d, "customer"), "?c", "<customer/mktsegment>", "?segment", as_type="string"), "segments")
    counts = views.pinned(spark, "segments").groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    # The counts go on from a file, so the pinned rows can be let go.
    counts = cut_lineage(counts, "segments")
    views.unpin(spark, "segments")
    return counts
