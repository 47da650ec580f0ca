"""Spatial joins; places are derived from keys by a fixed formula."""

from pyspark.sql import functions as F

from catalog.registry import query, table
from graphloom.functions import geo
from graphloom.operators import spatial as sp

# Places of customers and suppliers: spread over the globe, the date line and the poles included.
_SQL = """WITH a AS (SELECT c_custkey AS c, (c_custkey * 7919 % 36001) / 100.0 - 180 AS x, (c_custkey * 104729 % 18001) / 100.0 - 90 AS y FROM customer),
b AS (SELECT s_suppkey AS s, (s_suppkey * 15485863 % 36001) / 100.0 - 180 AS u, (s_suppkey * 32452843 % 18001) / 100.0 - 90 AS v FROM supplier),
d AS (SELECT c, s, 2 * 6371.01 * asin(sqrt(least(1.0, pow(sin(radians(v - y) / 2), 2) + cos(radians(y)) * cos(radians(v)) * pow(sin(radians(u - x) / 2), 2)))) AS km FROM a, b) """


def _places(spark, d, name, key, short, m1, m2):
    k = F.col(key)
    lng, lat = (k * m1 % 36001) / 100.0 - 180, (k * m2 % 18001) / 100.0 - 90
    return table(spark, d, name).select(k.alias(short), geo.make_point(lng, lat).alias(f"{short}_at"))


def _customers(spark, d):
    return _places(spark, d, "customer", "c_custkey", "c", 7919, 104729)


def _suppliers(spark, d):
    return _places(spark, d, "supplier", "s_suppkey", "s", 15485863, 32452843)


@query(_SQL + "SELECT c, s, round(km, 6) AS km FROM d WHERE km * 1000 <= 500000")
def spatial_max_distance(spark, d):
    out = sp.within_distance(_customers(spark, d), _suppliers(spark, d), 500_000, "c_at", "s_at", distance="km", payload=["s"])
    return out.select("c", "s", F.round("km", 6).alias("km"))


@query(_SQL + """SELECT c, s, round(km, 6) AS km FROM
(SELECT *, row_number() OVER (PARTITION BY c ORDER BY km, s) AS r FROM d) WHERE r <= 3""")
def spatial_nearest_neighbors(spark, d):
    out = sp.nearest_neighbors(_customers(spark, d), _suppliers(spark, d), 3, "c_at", "s", "s_at", distance="km", payload=["s"])
    return out.select("c", "s", F.round("km", 6).alias("km"))


@query(_SQL + """SELECT s, c FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY km, c) AS r FROM d
WHERE km * 1000 <= 300000) WHERE r <= 5""")
def spatial_nearest_with_limit(spark, d):
    out = sp.nearest_neighbors(_suppliers(spark, d), _customers(spark, d), 5, "s_at", "c", "c_at", max_metres=300_000, payload=["c"])
    return out.select("s", "c")


# Boxes of parts and suppliers on an integer grid: many share corners and edges.
_BOXES = """WITH a AS (SELECT p_partkey AS p, p_partkey * 37 % 120 AS x0, p_partkey * 53 % 60 AS y0,
1 + p_partkey % 5 AS w, 1 + p_partkey % 3 AS h FROM part),
b AS (SELECT s_suppkey AS s, s_suppkey * 41 % 120 AS u0, s_suppkey * 29 % 60 AS v0, 2 + s_suppkey % 7 AS w, 1 + s_suppkey % 4 AS h FROM supplier),
j AS (SELECT p, s, x0, y0, x0 + a.w AS x1, y0 + a.h AS y1, u0, v0, u0 + b.w AS u1, v0 + b.h AS v1 FROM a, b),
t AS (SELECT *, x0 <= u1 AND u0 <= x1 AND y0 <= v1 AND v0 <= y1 AS touch, x0 < u1 AND u0 < x1 AND y0 < v1 AND v0 < y1 AS open,
x0 <= u0 AND u1 <= x1 AND y0 <= v0 AND v1 <= y1 AS has, u0 <= x0 AND x1 <= u1 AND v0 <= y0 AND y1 <= v1 AS isin FROM j) """


def _box(x0, y0, w, h):
    def corner(x, y):
        return F.concat(x.cast("string"), F.lit(" "), y.cast("string"))

    x1, y1 = x0 + w, y0 + h
    ring = F.concat_ws(",", corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return F.concat(F.lit("POLYGON(("), ring, F.lit("))"))


def _part_boxes(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("p"), _box(k * 37 % 120, k * 53 % 60, 1 + k % 5, 1 + k % 3).alias("p_wkt"))


def _supplier_boxes(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("s"), _box(k * 41 % 120, k * 29 % 60, 2 + k % 7, 1 + k % 4).alias("s_wkt"))


def _box_query(name, condition):
    def run(spark, d):
        return sp.spatial_join(_part_boxes(spark, d), _supplier_boxes(spark, d), name, "p", "p_wkt", "s", "s_wkt")

    run.__name__ = f"spatial_{name}"
    run.__doc__ = f"Boxes of parts and suppliers: {name}."
    query(_BOXES + f"SELECT p, s FROM t WHERE {condition}")(run)


_box_query("intersects", "touch")
_box_query("touches", "touch AND NOT open")
_box_query("contains", "has")
_box_query("covers", "has")
_box_query("within", "isin")
_box_query("equals", "has AND isin")
_box_query("overlaps", "open AND NOT has AND NOT isin")


@query("""WITH a AS (SELECT p_partkey AS p, p_partkey * 37 % 120 + 0.5 AS x, p_partkey * 53 % 60 AS y0, 1 + p_partkey % 6 AS h FROM part),
b AS (SELECT s_suppkey AS s, s_suppkey * 41 % 120 AS u0, s_suppkey * 29 % 60 AS v0, 2 + s_suppkey % 7 AS w, 1 + s_suppkey % 4 AS h FROM supplier)
SELECT p, s FROM a, b WHERE u0 < x AND x < u0 + w AND y0 < v0 + b.h AND v0 < y0 + a.h AND NOT (v0 <= y0 AND y0 + a.h <= v0 + b.h)""")
def spatial_crosses(spark, d):
    k = F.col("p_partkey")
    x, y0 = (k * 37 % 120).cast("string"), k * 53 % 60
    line = F.concat(F.lit("LINESTRING("), x, F.lit(".5 "), y0, F.lit(","), x, F.lit(".5 "), y0 + 1 + k % 6, F.lit(")"))
    lines = table(spark, d, "part").select(k.alias("p"), line.alias("p_wkt"))
    return sp.spatial_join(lines, _supplier_boxes(spark, d), "crosses", "p", "p_wkt", "s", "s_wkt")


@query("""WITH a AS (SELECT c_custkey AS c, c_custkey * 37 % 120 AS x, c_custkey * 53 % 60 AS y FROM customer),
b AS (SELECT s_suppkey AS s, s_suppkey * 41 % 120 AS u, s_suppkey * 29 % 60 AS v FROM supplier),
d AS (SELECT c, s, 2 * 6371.01 * asin(sqrt(least(1.0, pow(sin(radians(v - y) / 2), 2) + cos(radians(y)) * cos(radians(v)) * pow(sin(radians(u - x) / 2), 2)))) AS km FROM a, b)
SELECT c, s FROM d WHERE km <= 350""")
def spatial_within_dist(spark, d):
    def points(name, key, short, m1, m2):
        k = F.col(key)
        return table(spark, d, name).select(k.alias(short), geo.point_wkt(k * m1 % 120, k * m2 % 60).alias(f"{short}_wkt"))

    return sp.spatial_join(points("customer", "c_custkey", "c", 37, 53), points("supplier", "s_suppkey", "s", 41, 29),
                           "within-dist", "c", "c_wkt", "s", "s_wkt", metres=350_000)


@query(_BOXES + """SELECT p, 'POLYGON' AS kind, 1 AS parts, x0 + w / 2.0 AS cx, y0 + h / 2.0 AS cy, x0::DOUBLE AS minx, y0::DOUBLE AS miny,
(x0 + w)::DOUBLE AS maxx, (y0 + h)::DOUBLE AS maxy, 'http://www.opengis.net/ont/sf#Polygon' AS type,
'POINT(' || x0::DOUBLE || ' ' || y0::DOUBLE || ')' AS low, 'POINT(' || (x0 + w)::DOUBLE || ' ' || (y0 + h)::DOUBLE || ')' AS high FROM a""")
def geometry_enrichment(spark, d):
    rows = sp.enrich_geometry(_part_boxes(spark, d), "p_wkt")
    i = F.col("geo_info")
    return rows.select("p", i["kind"].alias("kind"), geo.num_geometries(i).alias("parts"),
                       F.round(i["centroid"]["lng"], 6).alias("cx"), F.round(i["centroid"]["lat"], 6).alias("cy"),
                       geo.min_x(i).alias("minx"), geo.min_y(i).alias("miny"), geo.max_x(i).alias("maxx"),
                       geo.max_y(i).alias("maxy"), geo.geometry_type("p_wkt").alias("type"),
                       geo.envelope_lower_left(i).alias("low"), geo.envelope_upper_right(i).alias("high"))


@query("""WITH a AS (SELECT p_partkey AS p, p_partkey * 37 % 120 AS x0, p_partkey * 53 % 60 AS y0, 1 + p_partkey % 5 AS w, 1 + p_partkey % 3 AS h FROM part)
SELECT p, round(6371.01 * radians(h), 4) AS side_km, round(6371.01 * radians(h) / 1.609344, 4) AS side_miles FROM a""")
def geometry_length(spark, d):
    k = F.col("p_partkey")
    x, y = (k * 37 % 120), (k * 53 % 60)
    line = F.concat(F.lit("LINESTRING("), x, F.lit(" "), y, F.lit(","), x, F.lit(" "), y + 1 + k % 3, F.lit(")"))
    rows = sp.enrich_geometry(table(spark, d, "part").select(k.alias("p"), line.alias("wkt")), "wkt")
    return rows.select("p", F.round(geo.length("geo_info"), 4).alias("side_km"),
                       F.round(geo.length("geo_info", "mile"), 4).alias("side_miles"))


@query("""SELECT p_partkey AS p, round(radians(1 + p_partkey % 90) * 6371.01 * 6371.01, 2) AS sqkm,
round(radians(1 + p_partkey % 90) * 6371.01 * 6371.01 * 100, 1) AS hectares FROM part""")
def geometry_area(spark, d):
    # Triangles between the equator and the north pole: their area is the angle times the squared radius.
    k = F.col("p_partkey")
    x, x1 = k * 37 % 120, k * 37 % 120 + 1 + k % 90
    wkt = F.concat(F.lit("POLYGON(("), x, F.lit(" 0,"), x1, F.lit(" 0,"), x1, F.lit(" 90,"), x, F.lit(" 0))"))
    rows = sp.enrich_geometry(table(spark, d, "part").select(k.alias("p"), wkt.alias("wkt")), "wkt")
    return rows.select("p", F.round(geo.area("geo_info", "sqkm"), 2).alias("sqkm"),
                       F.round(geo.area("geo_info", "hectare"), 1).alias("hectares"))


@query("""SELECT c_custkey AS c, c_custkey % 360 - 180.5 AS lng, (c_custkey % 170 - 85)::DOUBLE AS lat,
round(6371.01 * radians(1), 6) AS km, round(6371.01 * radians(1) * 1000 / 0.3048, 2) AS feet FROM customer""")
def geometry_points(spark, d):
    k = F.col("c_custkey")
    here = geo.point_wkt(k % 360 - 180.5, (k % 170 - 85))
    north = geo.point_wkt(k % 360 - 180.5, (k % 170 - 84))
    rows = table(spark, d, "customer").select(k.alias("c"), here.alias("a"), north.alias("b"))
    return rows.select("c", geo.longitude("a").alias("lng"), geo.latitude("a").alias("lat"),
                       F.round(geo.distance("a", "b"), 6).alias("km"), F.round(geo.distance("a", "b", "foot"), 2).alias("feet"))


@query("""SELECT s_suppkey AS s, 'POINT(' || s_suppkey || ' 2)' AS second, 'LINESTRING(0 0,' || s_suppkey + 10 || ' 0)' AS simple FROM supplier""")
def geometry_parts_simplify(spark, d):
    k = F.col("s_suppkey")
    multi = F.concat(F.lit("MULTIPOINT((0 1),("), k, F.lit(" 2))"))
    line = F.concat(F.lit("LINESTRING(0 0,5 0.01,"), k + 10, F.lit(" 0)"))
    rows = table(spark, d, "supplier").select(k.alias("s"), multi.alias("m"), line.alias("l"))
    return rows.select("s", sp.geometry_n("m", 2).alias("second"), sp.simplify_geometry("l", 0.1).alias("simple"))
