"""Spatial joins against brute force, and relations of single geometries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.functions import geo
from graphloom.operators import geometry as gm, spatial as sp


def km(a, b):
    (x1, y1), (x2, y2) = a, b
    h = (math.sin(math.radians(y2 - y1) / 2) ** 2
         + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(math.radians(x2 - x1) / 2) ** 2)
    return 2 * 6371.01 * math.asin(math.sqrt(min(1.0, h)))


def cloud(seed, n):
    """Points over the globe, a tight cluster holding a third, many equal points, the poles and the date line."""
    rng = random.Random(seed)
    pts = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(n)]
    pts += [(10 + rng.uniform(0, 1e-3), 50 + rng.uniform(0, 1e-3)) for _ in range(n // 2)]
    pts += [(20.0, 20.0)] * 12 + [(180.0, 0.0), (-180.0, 0.0), (179.9999, 0.0), (0.0, 90.0), (90.0, 90.0), (0.0, -90.0)]
    return pts


def frame(spark, pts, short):
    rows_ = [(i, x, y) for i, (x, y) in enumerate(pts)] + [(-1, None, None)]
    df = spark.createDataFrame(rows_, f"{short} bigint, lng double, lat double")
    return df.select(short, geo.make_point("lng", "lat").alias(f"{short}_at"))


@pytest.mark.parametrize("metres", [0, 30, 400_000])
def test_within_distance(spark, metres):
    a, b = cloud(1, 60), cloud(2, 60)
    want = sorted(((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if km(p, q) * 1000 <= metres), key=repr)
    got = sp.within_distance(frame(spark, a, "a"), frame(spark, b, "b"), metres, "a_at", "b_at", payload=["b"])
    assert rows(got, "a", "b") == want


@pytest.mark.parametrize("k, limit", [(1, None), (5, None), (4, 2_000_000)])
def test_nearest(spark, k, limit):
    a, b = cloud(3, 40), cloud(4, 150)
    want = []
    for i, p in enumerate(a):
        near = sorted((km(p, q), j) for j, q in enumerate(b) if limit is None or km(p, q) * 1000 <= limit)
        want += [(i, round(d, 6)) for d, _ in near[:k]]
    got = sp.nearest_neighbors(frame(spark, a, "a"), frame(spark, b, "b"), k, "a_at", "b", "b_at", max_metres=limit,
                               distance="km", payload=["b"])
    assert rows(got.select("a", F.round("km", 6))) == sorted(want, key=repr)


def test_nearest_prefers_small_ids_on_ties(spark):
    b = [(20.0, 20.0)] * 6
    got = sp.nearest_neighbors(frame(spark, [(0.0, 0.0)], "a"), frame(spark, b, "b"), 3, "a_at", "b", "b_at", payload=["b"])
    assert rows(got, "b") == [(0,), (1,), (2,)]
    none = sp.nearest_neighbors(frame(spark, [(0.0, 0.0)], "a"), frame(spark, [], "b"), 3, "a_at", "b", "b_at", payload=["b"])
    assert none.count() == 0


SQUARE = "POLYGON((0 0,4 0,4 4,0 4,0 0))"
HOLED = "POLYGON((0 0,9 0,9 9,0 9,0 0),(3 3,6 3,6 6,3 6,3 3))"


@pytest.mark.parametrize("a, b, true", [
    ("POINT(1 1)", SQUARE, {"intersects", "within"}),
    ("POINT(0 2)", SQUARE, {"intersects", "touches"}),
    ("POINT(5 5)", SQUARE, set()),
    ("POINT(1 1)", "POINT(1 1)", {"intersects", "within", "contains", "covers", "equals"}),
    (SQUARE, SQUARE, {"intersects", "within", "contains", "covers", "equals"}),
    (SQUARE, "POLYGON((4 0,8 0,8 4,4 4,4 0))", {"intersects", "touches"}),
    (SQUARE, "POLYGON((4 4,8 4,8 8,4 8,4 4))", {"intersects", "touches"}),
    (SQUARE, "POLYGON((2 2,6 2,6 6,2 6,2 2))", {"intersects", "overlaps"}),
    (SQUARE, "POLYGON((1 1,2 1,2 2,1 2,1 1))", {"intersects", "contains", "covers"}),
    (SQUARE, "POLYGON((0 0,2 0,2 2,0 2,0 0))", {"intersects", "contains", "covers"}),
    (SQUARE, "LINESTRING(0 0,4 0)", {"intersects", "covers", "touches"}),
    (SQUARE, "LINESTRING(1 1,3 3)", {"intersects", "covers", "contains"}),
    (SQUARE, "LINESTRING(-1 2,5 2)", {"intersects", "crosses"}),
    (SQUARE, "LINESTRING(-1 2,0 2)", {"intersects", "touches"}),
    ("LINESTRING(0 0,2 2)", "LINESTRING(0 2,2 0)", {"intersects", "crosses"}),
    ("LINESTRING(0 0,2 0)", "LINESTRING(1 0,3 0)", {"intersects", "overlaps"}),
    ("LINESTRING(0 0,2 0)", "LINESTRING(2 0,3 0)", {"intersects", "touches"}),
    ("LINESTRING(0 0,2 0)", "LINESTRING(2 0,0 0)", {"intersects", "within", "contains", "covers", "equals"}),
    ("LINESTRING(0 0,2 0)", "POINT(1 0)", {"intersects", "contains", "covers"}),
    ("LINESTRING(0 0,2 0)", "POINT(2 0)", {"intersects", "covers", "touches"}),
    (HOLED, "POLYGON((4 4,5 4,5 5,4 5,4 4))", set()),
    (HOLED, "POLYGON((3 3,6 3,6 6,3 6,3 3))", {"intersects", "touches"}),
    (HOLED, "POLYGON((2 2,7 2,7 7,2 7,2 2))", {"intersects", "overlaps"}),
    ("MULTIPOINT(1 1,9 9)", SQUARE, {"intersects", "crosses"}),
    ("MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((2 2,3 2,3 3,2 3,2 2)))", SQUARE, {"intersects", "within"}),
    ("GEOMETRYCOLLECTION(POINT(1 1),LINESTRING(1 1,2 2))", SQUARE, {"intersects", "within"}),
])
def test_relations(a, b, true):
    names = [p for p in sp.PREDICATES if p != "within-dist"]
    assert {p for p in names if gm.test(p, gm.parse(a), gm.parse(b))} == true
    mirror = {"within": "contains", "contains": "within"}
    back = {p for p in names if gm.test(p, gm.parse(b), gm.parse(a))}
    assert back - {"covers"} == {mirror.get(p, p) for p in true} - {"covers"}


def test_spatial_join_mixed_sizes(spark):
    shapes = [SQUARE, HOLED, "POINT(1 1)", "POINT(4 4)", "LINESTRING(-170 10,170 10)", "POLYGON((-180 -90,180 -90,180 90,-180 90,-180 -90))",
              "POLYGON((1.5 1.5,1.6 1.5,1.6 1.6,1.5 1.6,1.5 1.5))", "no geometry", None]
    df = lambda s: spark.createDataFrame(list(enumerate(shapes)), f"{s} bigint, {s}_wkt string")
    parsed = [gm.parse(s) for s in shapes]
    want = sorted(((i, j) for i, p in enumerate(parsed) for j, q in enumerate(parsed) if p and q and gm.relate(p, q).meets), key=repr)
    got = sp.spatial_join(df("a"), df("b"), "intersects", "a", "a_wkt", "b", "b_wkt")
    assert rows(got) == want
    with pytest.raises(ValueError):
        sp.spatial_join(df("a"), df("b"), "within-dist", "a", "a_wkt", "b", "b_wkt")


def test_geometry_columns(spark):
    data = [(HOLED,), ("POINT(7 8)",), ("LINESTRING(0 0,0 1,0 2)",), ("bad",), (None,)]
    df = sp.enrich_geometry(spark.createDataFrame(data, "w string"), "w").select(
        "w", "geo_info", geo.metric_length("geo_info").alias("len"), geo.centroid("geo_info").alias("c"),
        sp.simplify_geometry("w", 0.5).alias("s"), sp.geometry_n("w", 1).alias("one")).collect()
    assert df[0].geo_info.n_parts == 1 and df[0].c == "POINT(4.5 4.5)" and df[0].geo_info.area_sqm > 0
    assert df[1].geo_info.area_sqm == 0 and df[1].one == "POINT(7 8)"
    assert df[2].len == pytest.approx(2 * math.radians(1) * 6371010) and df[2].s == "LINESTRING(0 0,0 2)"
    assert df[3].geo_info is None and df[4].geo_info is None


def test_equal_shapes_are_tested_once(spark, monkeypatch):
    """Many rows with the same few geometries: the exact test meets each pair of shapes once, the result has all rows."""
    tested = []
    monkeypatch.setattr(sp, "cut_lineage", lambda df, name: tested.append((name, c := df.cache())) or c)
    square = "POLYGON(({0} 0,{1} 0,{1} 2,{0} 2,{0} 0))"
    many = [(i, square.format(i % 3, i % 3 + 2)) for i in range(60)]
    few = [(i, square.format(1, 3)) for i in range(10)]
    got = sp.spatial_join(spark.createDataFrame(many, "a bigint, w string"),
                          spark.createDataFrame(few, "b bigint, v string"), "overlaps", "a", "w", "b", "v")
    assert rows(got) == sorted(((i, k) for i in range(60) if i % 3 != 1 for k in range(10)), key=repr)
    assert [df.count() for name, df in tested if name == "shape-pairs"] == [2]


def test_within_distance_spreads_a_crowd(spark):
    at = lambda n, short: spark.range(n).select(F.col("id").alias(short), geo.make_point(F.lit(5.0), F.lit(5.0)).alias(f"{short}_at"))
    got = sp.within_distance(at(3000, "a"), at(3000, "b").repartition(1), 10, "a_at", "b_at", payload=["b"])
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert sum(tasks) == 9_000_000 and max(tasks) < 7_000_000


def test_measures_run_in_many_tasks(spark):
    texts = spark.range(0, 400, 1, 1).select("id", geo.point_wkt(F.col("id") % 90, F.col("id") % 45).alias("wkt"))
    got = sp.enrich_geometry(texts, "wkt")
    assert got.where("geo_info.kind = 'POINT'").count() == 400
    assert got.select(F.spark_partition_id().alias("t")).distinct().count() > 1


def test_nearest_keeps_only_what_cannot_be_computed_again(spark, monkeypatch):
    """Rounds of the search hold places and cells, not positions and ranges; the result stays exact."""
    held, add = [], sp.Rounds.add

    def seen(self, df):
        held.append((self.base, df.columns))
        return add(self, df)

    monkeypatch.setattr(sp.Rounds, "add", seen)
    pts = [(10 + 0.01 * (i % 20), 50 + 0.01 * (i // 20)) for i in range(200)]
    got = rows(sp.nearest_neighbors(frame(spark, pts[:3], "a"), frame(spark, pts, "b"), 1, "a_at", "b", "b_at", payload=["b"]).select("a", "b"))
    assert got == [(0, 0), (1, 1), (2, 2)]
    frontiers = [columns for base, columns in held if "/frontier-" in base]
    assert frontiers and all(columns == ["lng", "lat", "bound", "cx", "cy", "cz"] for columns in frontiers)
