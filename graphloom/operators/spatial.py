"""Spatial joins and geometry columns.

Points live on the unit sphere in three dimensions, where straight-line distance orders like great-circle distance, so
neither the date line nor the poles are special.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from graphloom.functions import geo
from graphloom.plans.skew import spread_join
from graphloom.session import Rounds, cut_lineage, ship, task_count

GEO_INFO_DDL = (
    "struct<kind:string,n_parts:int,centroid:struct<lng:double,lat:double>,"
    "bbox:struct<minx:double,miny:double,maxx:double,maxy:double>,length_m:double,area_sqm:double>"
)


def _point_of(df: DataFrame, column: str) -> Column:
    """A point column is a struct<lng, lat> or a POINT text."""
    if isinstance(df.schema[column].dataType, T.StructType):
        return F.col(column)
    return geo.point(column)


def _payload(df: DataFrame, keep: Sequence[str] | None) -> list[str]:
    return df.columns if keep is None else list(keep)


# --- maximum distance -----------------------------------------------------------------------------------------------

def within_distance(left: DataFrame, right: DataFrame, metres: float, left_point: str, right_point: str,
                    distance: str | None = None, payload: Sequence[str] | None = None) -> DataFrame:
    """Pairs of rows whose points are at most ``metres`` apart; ``distance`` names a column in kilometres.

    ``payload`` selects the right columns; rows without a point drop out.  Each right point lies in one grid cell, each
    left point in the at most eight cells its ball reaches, and the equi-join on cells is followed by the exact test.
    A cell is two radii wide, so candidates exceed results by a constant factor only, and crowded cells are dealt over
    many tasks.
    """
    if metres < 0:
        raise ValueError("the distance must not be negative")
    common = set(left.columns) & set(_payload(right, payload))
    if common:
        raise ValueError(f"both sides have columns {sorted(common)}")
    radius = geo.chord(metres) * (1 + 1e-9) + 1e-9
    width = 2 * radius
    cells = ["__cx", "__cy", "__cz"]

    def located(df: DataFrame, point: str, kept: Sequence[str], side: str) -> DataFrame:
        rows = df.withColumn("__p", _point_of(df, point)).where("__p is not null")
        position = geo.unit_vector(F.col("__p.lng"), F.col("__p.lat"))
        return rows.select(*kept, F.col("__p").alias(f"__{side}"), *[a.alias(f"__{side}{n}") for n, a in zip("xyz", position)])

    a, b = located(left, left_point, left.columns, "p"), located(right, right_point, _payload(right, payload), "q")
    for name, n in zip(cells, "xyz"):
        low = F.floor((F.col(f"__p{n}") - radius) / width).cast("bigint")
        high = F.floor((F.col(f"__p{n}") + radius) / width).cast("bigint")
        a = a.withColumn(name, F.explode_outer(F.sequence(low, high)))
        b = b.withColumn(name, F.floor(F.col(f"__q{n}") / width).cast("bigint"))
    # Straight lines leave out most pairs of the cells; haversines cost far more.
    square = sum((F.col(f"__p{n}") - F.col(f"__q{n}")) * (F.col(f"__p{n}") - F.col(f"__q{n}")) for n in "xyz")
    km = geo.haversine_km(F.col("__p.lng"), F.col("__p.lat"), F.col("__q.lng"), F.col("__q.lat"))
    near = spread_join(a, b, cells).where(~(square > radius ** 2))
    pairs = near.withColumn("__km", km).where(F.col("__km") * 1000 <= metres)
    extra = [F.col("__km").alias(distance)] if distance else []
    return pairs.select(*left.columns, *_payload(right, payload), *extra)


# --- nearest neighbours ---------------------------------------------------------------------------------------------

_BITS = 29  # bits per axis of the finest cells: about two centimetres
_ROOT = 2  # the coarsest level has at most 64 cells
_STEP = 3  # levels per round: a cell has at most 512 children
_LEAF = 32
_CELL = ["cx", "cy", "cz"]


def nearest_neighbors(left: DataFrame, right: DataFrame, k: int, left_point: str, right_id: str, right_point: str,
                      max_metres: float | None = None, distance: str | None = None,
                      payload: Sequence[str] | None = None) -> DataFrame:
    """For each left row its ``k`` closest right rows (ties to the smaller ``right_id``), at most ``max_metres`` away.

    ``right_id`` must be unique.  The right points are counted in a hierarchy of cells.  Every distinct left location
    starts with the coarsest cells and repeatedly replaces its cells by their children, dropping a cell as soon as
    enough points are known to lie closer than its nearest corner.  Only the points of the last cells are compared, so
    a crowd far from a location costs nothing, and equal locations are searched once.
    """
    if k < 1:
        raise ValueError("k must be positive")
    columns = _payload(right, payload)
    spark = left.sparkSession
    points = _right_points(right, right_id, right_point, k)
    tree, depth = _cell_tree(spark, points, k)
    places = left.select(_point_of(left, left_point).alias("p")).where("p is not null").select(
        _plus_zero("p.lng").alias("lng"), _plus_zero("p.lat").alias("lat")).dropDuplicates()
    # The search is expensive per row: a fixed number of tasks keeps short rows from being packed into one.
    places = places.repartition(task_count(spark), "lng", "lat")
    for name, axis in zip("xyz", geo.unit_vector(F.col("lng"), F.col("lat"))):
        places = places.withColumn(name, axis)
    frontier = _descend(spark, places, tree, depth, k, max_metres)
    best = _closest(frontier, points, depth, k, max_metres)
    rows = left.withColumn("__p", _point_of(left, left_point)).where("__p is not null")
    rows = rows.join(best, (_plus_zero("__p.lng") == F.col("__lng")) & (_plus_zero("__p.lat") == F.col("__lat")))
    picked = right.select(F.col(right_id).alias("__rid"), *[F.col(c) for c in columns])
    extra = [F.col("__km").alias(distance)] if distance else []
    return rows.join(picked, "__rid").select(*left.columns, *columns, *extra)


def _plus_zero(column: str) -> Column:
    # Negative zero and zero are the same place.
    return F.col(column) + F.lit(0.0)


def _right_points(right: DataFrame, right_id: str, right_point: str, k: int) -> DataFrame:
    """Right points with their finest cell; of equal locations only the first k ids can ever be chosen."""
    rows = right.select(F.col(right_id).alias("rid"), _point_of(right, right_point).alias("p")).where("p is not null")
    rows = rows.select("rid", _plus_zero("p.lng").alias("lng"), _plus_zero("p.lat").alias("lat"))
    same = Window.partitionBy("lng", "lat").orderBy("rid")
    rows = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k).drop("n")
    axes = geo.unit_vector(F.col("lng"), F.col("lat"))
    top = (1 << _BITS) - 1
    cells = [F.least(F.floor((a + 1) * float(1 << (_BITS - 1))).cast("bigint"), F.lit(top)) for a in axes]
    rows = rows.select("*", *[c.alias(n) for n, c in zip(_CELL, cells)])
    return Rounds(right.sparkSession, "places").add(rows)[0]


def _at_level(level: int) -> list[Column]:
    return [F.shiftright(c, _BITS - level).alias(c) for c in _CELL]


def _cell_tree(spark, points: DataFrame, k: int) -> tuple[dict[int, DataFrame], int]:
    """Counts per cell for the levels 2, 5, ... down to where no cell holds more than a leaf's worth of points."""
    leaf = max(_LEAF, 4 * k)
    total = points.count()
    # Points fill the surface of the sphere: each step refines a cell into about 64 others.
    steps = math.ceil(math.log(max(total / leaf / 32, 1.0), 64))
    depth = min(_ROOT + _STEP * steps, _BITS)
    while True:
        counts = points.groupBy(*_at_level(depth)).agg(F.count(F.lit(1)).alias("n"))
        cells, _ = Rounds(spark, "cells").add(counts)
        crowd = cells.agg(F.max("n").alias("m")).first()["m"] or 0
        if crowd <= leaf or depth >= _BITS:
            break
        depth += _STEP
    tree = {depth: cells}
    for level in range(depth - _STEP, _ROOT - 1, -_STEP):
        up = [F.shiftright(c, _STEP).alias(c) for c in _CELL]
        tree[level] = Rounds(spark, "cells").add(
            tree[level + _STEP].groupBy(*up).agg(F.sum("n").alias("n")))[0]
    return tree, depth


_PLACE = ["lng", "lat", "x", "y", "z"]


def _first_cut(roots: list, k: int, start: float):
    """Choose among the coarsest cells (at most 64) for a batch of places at once."""
    lows = np.array([[r[c] for c in _CELL] for r in roots], dtype=float).reshape(-1, 3) * (2.0 / (1 << _ROOT)) - 1.0
    numbers = np.array([[r[c] for c in _CELL] for r in roots], dtype="int64").reshape(-1, 3)
    counts, width = np.array([r["n"] for r in roots], dtype="int64"), 2.0 / (1 << _ROOT)

    def run(batches):
        for batch in batches:
            off = batch[["x", "y", "z"]].to_numpy()[:, None, :] - lows[None]
            near = np.sqrt((np.maximum(np.maximum(-off, off - width), 0.0) ** 2).sum(axis=2))
            far = np.sqrt((np.maximum(np.abs(off), np.abs(off - width)) ** 2).sum(axis=2))
            bound = np.full(len(batch), start)
            if counts.sum() >= k:
                order = np.argsort(far, axis=1)
                enough = (np.cumsum(counts[order], axis=1) >= k).argmax(axis=1)
                reach = np.take_along_axis(far, order, axis=1)[np.arange(len(batch)), enough]
                bound = np.minimum(bound, reach)
            row, cell = np.nonzero(near <= _slack(bound)[:, None])
            out = batch.iloc[row].assign(bound=bound[row])
            for n, name in enumerate(_CELL):
                out[name] = numbers[cell, n]
            yield out

    return run


def _slack(bound):
    # Room for rounding: distances here and the final ones are computed differently.
    return bound * (1 + 1e-6) + 1e-12


def _descend(spark, places: DataFrame, tree: dict[int, DataFrame], depth: int, k: int, max_metres) -> DataFrame:
    """Per place the finest cells that can hold one of its k nearest points."""
    start = 4.0 if max_metres is None else geo.chord(max_metres) * (1 + 1e-9) + 1e-9
    columns = ", ".join(f"{c} double" for c in [*_PLACE, "bound"]) + ", " + ", ".join(f"{c} bigint" for c in _CELL)
    slim = ["lng", "lat", "bound", *_CELL]
    state = places.select(_PLACE).mapInPandas(_first_cut(tree[_ROOT].collect(), k, start), columns).select(slim)
    for level in range(_ROOT + _STEP, depth + 1, _STEP):
        state, _ = Rounds(spark, "frontier").add(state)
        up = [F.shiftright(c, _STEP).alias(f"up_{c}") for c in _CELL]
        parents = state.select("lng", "lat", "bound", *[F.col(c).alias(f"up_{c}") for c in _CELL])
        rows = parents.join(tree[level].select(*_CELL, "n", *up), [f"up_{c}" for c in _CELL])
        rows = _ranged(rows, level).where(F.col("near") <= _slack(F.col("bound"))).select(*slim, "n")
        # Only what cannot be computed again is shuffled; positions and ranges are eight bytes each that do not compress.
        # Dealt by a hash, as the window would deal doubles anew.
        rows = _ranged(rows.withColumn("h", F.xxhash64("lng", "lat")).repartition(task_count(spark), "h"), level)
        # The cells of one place are few: those that survived the level above, times their children.
        place = Window.partitionBy("h", "lng", "lat")
        seen = F.sum("n").over(place.orderBy("far", *_CELL).rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("seen", seen)
        sure = F.min(F.when(F.col("seen") >= k, F.col("far"))).over(place)
        rows = rows.withColumn("bound", F.least("bound", sure)).where(F.col("near") <= _slack(F.col("bound")))
        state = rows.select(slim)
    return state.select(F.col("lng").alias("__lng"), F.col("lat").alias("__lat"), *_CELL)


def _ranged(rows: DataFrame, level: int) -> DataFrame:
    """Rows with the nearest and farthest distance from their place to their cell."""
    for name, axis in zip("xyz", geo.unit_vector(F.col("lng"), F.col("lat"))):
        rows = rows.withColumn(name, axis)
    near, far = _range(level)
    return rows.withColumn("near", near).withColumn("far", far)


def _range(level: int) -> tuple[Column, Column]:
    """Nearest and farthest distance from (x, y, z) to the cell (cx, cy, cz)."""
    width = 2.0 / (1 << level)
    near, far = F.lit(0.0), F.lit(0.0)
    for axis, c in zip("xyz", _CELL):
        off = F.col(axis) - (F.col(c) * F.lit(width) - 1.0)
        near = near + F.pow(F.greatest(-off, off - width, F.lit(0.0)), F.lit(2.0))
        far = far + F.pow(F.greatest(F.abs(off), F.abs(off - width)), F.lit(2.0))
    return F.sqrt(near), F.sqrt(far)


def _closest(frontier: DataFrame, points: DataFrame, depth: int, k: int, max_metres) -> DataFrame:
    located = points.select("rid", "lng", "lat", *_at_level(depth))
    km = geo.haversine_km(F.col("__lng"), F.col("__lat"), F.col("lng"), F.col("lat"))
    pairs = frontier.join(located, _CELL).select("__lng", "__lat", F.col("rid").alias("__rid"), km.alias("__km"))
    if max_metres is not None:
        pairs = pairs.where(F.col("__km") * 1000 <= max_metres)
    order = Window.partitionBy("__lng", "__lat").orderBy("__km", "__rid")
    return pairs.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k).drop("__n")


# --- predicates on arbitrary geometries -----------------------------------------------------------------------------

# The predicates of a spatial join.
PREDICATES = ("intersects", "contains", "covers", "crosses", "touches", "equals", "overlaps", "within", "within-dist")
_MAX_LEVEL = 24


def spatial_join(left: DataFrame, right: DataFrame, predicate: str, left_id: str, left_wkt: str, right_id: str,
                 right_wkt: str, metres: float | None = None) -> DataFrame:
    """Pairs ``(left_id, right_id)`` whose geometries satisfy a predicate; ids must be unique on their side.

    Equal geometries are one shape: shapes are compared, and their pairs are then given back to the ids.  Every shape picks
    the grid level whose cells are as large as itself, so it covers at most four of them.  Two shapes meet at the coarser
    of their levels.  Bounding boxes are tested in the join; a pair is taken only in the cell that holds the lower left
    corner of the boxes' intersection, so no duplicates arise.  The exact predicate runs on Arrow batches of the remaining
    pairs.
    """
    if predicate not in PREDICATES:
        raise ValueError(f"predicate must be one of {PREDICATES}")
    if (predicate == "within-dist") != (metres is not None):
        raise ValueError("within-dist, and only it, takes a distance")
    ship(left.sparkSession)
    grow = 0.0 if metres is None else metres
    shapes_a, rows_a = _shapes(left, left_id, left_wkt, "a", metres is None)
    shapes_b, rows_b = _shapes(right, right_id, right_wkt, "b", metres is None)
    pairs = _box_pairs(_boxes(shapes_a, "a_shape", "a_box", "a", grow), _boxes(shapes_b, "b_shape", "b_box", "b", 0.0), predicate)
    if metres is not None:
        # Both parts of a box may meet a wide one.
        pairs = pairs.distinct()
    full = pairs.join(shapes_a.select("a_shape", "a_wkt"), "a_shape").join(shapes_b.select("b_shape", "b_wkt"), "b_shape")
    # The exact test costs far more than a shuffle, and a shape that meets very many others must not run in one task.
    full = full.repartition(task_count(left.sparkSession), "a_shape", "b_shape")
    # ``mapInPandas`` and not a filter: Spark would move a filter below the shuffle.
    kept = cut_lineage(full.mapInPandas(_exact(predicate, metres), "a_shape bigint, b_shape bigint"), "shape-pairs")
    found = spread_join(spread_join(kept, rows_a, ["a_shape"]).drop("a_shape"), rows_b, ["b_shape"])
    return found.select(F.col("a_id").alias(left_id), F.col("b_id").alias(right_id))


def _shapes(df: DataFrame, id_: str, wkt: str, side: str, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """Numbered shapes ``(shape, box, wkt)``, where ``box`` is the text that gives the box, and ``(id, shape)`` of the rows."""
    shape, box, text = f"{side}_shape", f"{side}_box", f"{side}_wkt"
    rows = df.select(F.col(id_).alias(f"{side}_id"), F.col(wkt).alias(text)).where(f"{side}_id is not null and {text} is not null")
    boxes = rows.withColumnRenamed(text, box)
    # An id that repeats against the rule has the boxes of all its rows for each of its geometries.
    rows = boxes.join(rows, f"{side}_id") if by_id else boxes.withColumn(text, F.col(box))
    shapes = cut_lineage(rows.select(box, text).distinct().withColumn(shape, F.monotonically_increasing_id()), "shapes")
    return shapes, rows.join(shapes, [box, text]).select(f"{side}_id", shape)


def _boxes(df: DataFrame, id_: str, wkt: str, side: str, metres: float) -> DataFrame:
    # ``inline`` keeps the optimizer from repeating the parse for each of the four numbers.
    rows = df.select(id_, F.inline(F.array(geo.bounding_box(wkt)))).where("minx is not null")
    up = math.degrees(metres / (1000 * geo.EARTH_RADIUS_KM)) * (1 + 1e-9)
    lat = F.greatest(F.abs("miny"), F.abs("maxy")) + up
    rows = rows.withColumn("miny", F.col("miny") - up).withColumn("maxy", F.col("maxy") + up)
    if metres:
        # The circle around a point bulges: its widest meridian is reached off its centre's parallel.
        aside = F.degrees(F.asin(F.least(F.sin(F.radians(F.lit(up))) / F.cos(F.radians(lat)), F.lit(1.0)))) * (1 + 1e-9)
        x0, x1 = F.col("minx") - aside, F.col("maxx") + aside
        box = lambda a, b: F.struct(F.greatest(a, F.lit(-180.0)).alias("minx"), F.least(b, F.lit(180.0)).alias("maxx"))
        # A box that reaches a pole reaches all meridians; one that crosses the date line has a second part behind it.
        around = (lat >= 90) | (x1 - x0 >= 360)
        parts = F.when(around, F.array(box(F.lit(-180.0), F.lit(180.0)))).otherwise(F.filter(F.array(
            box(x0, x1), F.when(x0 < -180, box(x0 + 360, F.lit(180.0))), F.when(x1 > 180, box(F.lit(-180.0), x1 - 360))),
            lambda part: part.isNotNull()))
        rows = rows.select(id_, "miny", "maxy", F.inline(parts))
    rows = rows.select(id_, F.col("minx").alias(f"{side}_x0"), F.col("miny").alias(f"{side}_y0"),
                       F.col("maxx").alias(f"{side}_x1"), F.col("maxy").alias(f"{side}_y1"))
    extent = F.greatest(F.col(f"{side}_x1") - F.col(f"{side}_x0"), F.col(f"{side}_y1") - F.col(f"{side}_y0"))
    level = F.when(extent <= 360.0 / (1 << _MAX_LEVEL), _MAX_LEVEL).otherwise(
        F.greatest(F.floor(F.log2(360.0 / extent)), F.lit(0)))
    return rows.withColumn("own", level.cast("int"))


def _levels(boxes: DataFrame) -> list[int]:
    return sorted(r["own"] for r in boxes.select("own").distinct().collect())


def _on_grid(boxes: DataFrame, side: str, levels: Sequence[int]) -> DataFrame:
    """One row per level (own or listed coarser) and covered cell."""
    wanted = F.array_distinct(F.concat(
        F.array(F.col("own")), F.filter(F.array(*[F.lit(n) for n in levels]), lambda n: n < F.col("own"))))
    rows = boxes.withColumn("level", F.explode_outer(wanted))
    width = F.lit(360.0) / F.pow(F.lit(2.0), F.col("level"))
    for cell, low, high in (("gx", "x0", "x1"), ("gy", "y0", "y1")):
        first = F.floor((F.col(f"{side}_{low}") + 180.0) / width).cast("bigint")
        last = F.floor((F.col(f"{side}_{high}") + 180.0) / width).cast("bigint")
        rows = rows.withColumn(cell, F.explode_outer(F.sequence(first, last)))
    return rows.withColumn(f"{side}_own", F.col("own") == F.col("level")).drop("own")


def _box_condition(predicate: str) -> Column:
    """What the bounding boxes must satisfy beyond meeting each other; a hair of slack leaves borders to the exact test."""
    def inside(p: str, q: str) -> Column:
        e = 1e-9
        return ((F.col(f"{p}_x0") >= F.col(f"{q}_x0") - e) & (F.col(f"{p}_y0") >= F.col(f"{q}_y0") - e)
                & (F.col(f"{p}_x1") <= F.col(f"{q}_x1") + e) & (F.col(f"{p}_y1") <= F.col(f"{q}_y1") + e))

    if predicate == "within":
        return inside("a", "b")
    if predicate in ("contains", "covers"):
        return inside("b", "a")
    if predicate == "equals":
        return inside("a", "b") & inside("b", "a")
    return F.lit(True)


def _box_pairs(a: DataFrame, b: DataFrame, predicate: str) -> DataFrame:
    ga, gb = _on_grid(a, "a", _levels(b)), _on_grid(b, "b", _levels(a))
    keys = ["level", "gx", "gy"]
    # At least one side is at its own level, so two small geometries never meet in a large cell.
    joined = ga.join(gb.where("b_own"), keys).unionByName(ga.where("a_own").join(gb.where("not b_own"), keys))
    width = F.lit(360.0) / F.pow(F.lit(2.0), F.col("level"))
    x, y = F.greatest("a_x0", "b_x0"), F.greatest("a_y0", "b_y0")
    return joined.where(_box_condition(predicate)).where(
        (x <= F.least("a_x1", "b_x1")) & (y <= F.least("a_y1", "b_y1"))
        & (F.floor((x + 180.0) / width) == F.col("gx")) & (F.floor((y + 180.0) / width) == F.col("gy"))
    ).select("a_shape", "b_shape")


def _exact(predicate: str, metres: float | None):
    def check(batches):
        from graphloom.operators import geometry as gm

        def one(x, y):
            p, q = gm.parse(x), gm.parse(y)
            if p is None or q is None:
                return False
            return gm.distance_m(p, q) <= metres if predicate == "within-dist" else gm.test(predicate, p, q)

        for batch in batches:
            hit = [one(x, y) for x, y in zip(batch["a_wkt"], batch["b_wkt"])]
            yield batch.loc[hit, ["a_shape", "b_shape"]]

    return check


# --- geometry columns -----------------------------------------------------------------------------------------------

def enrich_geometry(df: DataFrame, wkt: str, info: str = "geo_info") -> DataFrame:
    """Add a struct with type, number of parts, centroid, bounding box, metric length and area; NULL for other texts."""
    @F.pandas_udf("struct<kind:string,n_parts:int,cx:double,cy:double,minx:double,miny:double,maxx:double,"
                  "maxy:double,length_m:double,area_sqm:double>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        from graphloom.operators import geometry as gm

        names = ["kind", "n_parts", "cx", "cy", "minx", "miny", "maxx", "maxy", "length_m", "area_sqm"]
        found = [gm.measures(g) if (g := gm.parse(t)) is not None else {} for t in texts]
        # Object columns: Arrow then sees plain values and None.
        return pd.DataFrame({n: pd.Series([m.get(n) for m in found], dtype=object) for n in names})

    ship(df.sparkSession)
    # Measuring costs far more than a shuffle, and a scan of a small table has few tasks.  Ranges of places keep the rows' order.
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    df = placed.repartitionByRange(task_count(df.sparkSession), "__place").sortWithinPartitions("__place").drop("__place")
    m = F.col("__m")
    built = F.when(m["kind"].isNotNull(), F.struct(
        m["kind"].alias("kind"), m["n_parts"].alias("n_parts"),
        F.struct(m["cx"].alias("lng"), m["cy"].alias("lat")).alias("centroid"),
        F.struct(*[m[c].alias(c) for c in ("minx", "miny", "maxx", "maxy")]).alias("bbox"),
        m["length_m"].alias("length_m"), m["area_sqm"].alias("area_sqm")))
    return df.withColumn("__m", measure(wkt)).withColumn(info, built).drop("__m")


def geometry_n(wkt, n: int) -> Column:
    """The n-th member (from 1) as WKT; NULL if there is none."""
    @F.pandas_udf("string")
    def pick(texts: pd.Series) -> pd.Series:
        from graphloom.operators import geometry as gm

        def one(text):
            g = gm.parse(text)
            members = gm.parts(g) if g is not None else []
            return members[n - 1] if 1 <= n <= len(members) else None

        return texts.map(one)

    ship(SparkSession.active())
    return pick(wkt)


def simplify_geometry(wkt, tolerance: float) -> Column:
    """Lines and rings simplified with a tolerance in degrees."""
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")

    @F.pandas_udf("string")
    def reduce_(texts: pd.Series) -> pd.Series:
        from graphloom.operators import geometry as gm

        def one(text):
            g = gm.parse(text)
            return None if g is None else gm.simplified(g, tolerance)

        return texts.map(one)

    ship(SparkSession.active())
    return reduce_(wkt)
