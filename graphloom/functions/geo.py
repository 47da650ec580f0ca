"""Points and distances as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from graphloom.functions.terms import _c, let

EARTH_RADIUS_KM = 6371.01

# Units of length in metres and of area in square metres.
LENGTH_UNITS = {
    "m": 1.0, "km": 1000.0, "mile": 1609.344, "foot": 0.3048, "yard": 0.9144,
}
AREA_UNITS = {
    "sqm": 1.0, "sqkm": 1e6, "sqmile": 2589988.110336, "sqfoot": 0.09290304, "sqyard": 0.83612736,
    "acre": 4046.8564224, "are": 100.0, "hectare": 10000.0,
}

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POINT = rf"(?i)^\s*POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)\s*$"


def point(wkt) -> Column:
    """struct<lng, lat> of a POINT text; NULL for everything else."""
    wkt = _c(wkt)
    return F.when(wkt.rlike(_POINT), F.struct(
        F.regexp_extract(wkt, _POINT, 1).cast("double").alias("lng"),
        F.regexp_extract(wkt, _POINT, 2).cast("double").alias("lat")))


def make_point(lng, lat) -> Column:
    lng, lat = _c(lng).cast("double"), _c(lat).cast("double")
    return F.when(lng.isNotNull() & lat.isNotNull(), F.struct(lng.alias("lng"), lat.alias("lat")))


def point_wkt(lng, lat) -> Column:
    return F.concat(F.lit("POINT("), _c(lng).cast("string"), F.lit(" "), _c(lat).cast("string"), F.lit(")"))


def longitude(wkt) -> Column:
    """Longitude of a POINT text, NaN for everything else."""
    wkt = _c(wkt)
    return F.when(wkt.isNotNull(), F.coalesce(point(wkt)["lng"], F.lit(float("nan"))))


def latitude(wkt) -> Column:
    wkt = _c(wkt)
    return F.when(wkt.isNotNull(), F.coalesce(point(wkt)["lat"], F.lit(float("nan"))))


def haversine_km(lng1, lat1, lng2, lat2) -> Column:
    """Great-circle distance in kilometres."""
    lng1, lat1, lng2, lat2 = (F.radians(_c(x)) for x in (lng1, lat1, lng2, lat2))
    h = (F.pow(F.sin((lat2 - lat1) / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lng2 - lng1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def distance(a, b, unit: str = "km") -> Column:
    """Distance of two POINT texts in a unit of length."""
    a, b = point(a), point(b)
    return haversine_km(a["lng"], a["lat"], b["lng"], b["lat"]) * (1000.0 / LENGTH_UNITS[unit])


def metric_distance(a, b) -> Column:
    return distance(a, b, "m")


def unit_vector(lng: Column, lat: Column) -> list[Column]:
    """Position on the unit sphere; straight-line distances there grow with great-circle distances."""
    lng, lat = F.radians(lng), F.radians(lat)
    return [F.cos(lat) * F.cos(lng), F.cos(lat) * F.sin(lng), F.sin(lat)]


def chord(metres: float) -> float:
    """Straight-line distance on the unit sphere of a great-circle distance."""
    return 2.0 * math.sin(min(metres / (2000.0 * EARTH_RADIUS_KM), math.pi / 2))


def bounding_box(wkt) -> Column:
    """struct<minx, miny, maxx, maxy> of any 2D WKT text, from its numbers; NULL for other texts."""
    wkt = _c(wkt)
    is_wkt = wkt.rlike(r"(?i)^\s*(MULTI)?(POINT|LINESTRING|POLYGON)\s*\(|^\s*GEOMETRYCOLLECTION\s*\(")
    numbers = F.transform(F.regexp_extract_all(wkt, F.lit(f"({_NUMBER})"), F.lit(1)), lambda x: x.cast("double"))

    def box(n: Column) -> Column:
        xs, ys = F.filter(n, lambda _, i: i % 2 == 0), F.filter(n, lambda _, i: i % 2 == 1)
        return F.when((F.size(n) >= 2) & (F.size(n) % 2 == 0), F.struct(
            F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")))

    return F.when(is_wkt, let(numbers, box))


# IRIs of the simple-feature types.
GEOMETRY_TYPES = {
    "POINT": "http://www.opengis.net/ont/sf#Point", "LINESTRING": "http://www.opengis.net/ont/sf#LineString",
    "POLYGON": "http://www.opengis.net/ont/sf#Polygon", "MULTIPOINT": "http://www.opengis.net/ont/sf#MultiPoint",
    "MULTILINESTRING": "http://www.opengis.net/ont/sf#MultiLineString",
    "MULTIPOLYGON": "http://www.opengis.net/ont/sf#MultiPolygon",
    "GEOMETRYCOLLECTION": "http://www.opengis.net/ont/sf#GeometryCollection",
}


def geometry_type(wkt) -> Column:
    name = F.upper(F.regexp_extract(_c(wkt), r"^\s*([A-Za-z]+)\s*\(", 1))
    pairs = [F.lit(x) for item in GEOMETRY_TYPES.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.when(name != "", name))


def length(info, unit: str = "km") -> Column:
    """Length of an enriched geometry in a unit."""
    return _c(info)["length_m"] / LENGTH_UNITS[unit]


def area(info, unit: str = "sqm") -> Column:
    return _c(info)["area_sqm"] / AREA_UNITS[unit]


def metric_length(info) -> Column:
    return _c(info)["length_m"]


def metric_area(info) -> Column:
    return _c(info)["area_sqm"]


def centroid(info) -> Column:
    """POINT text of the centroid."""
    return point_wkt(_c(info)["centroid"]["lng"], _c(info)["centroid"]["lat"])


def envelope(info) -> Column:
    """POLYGON text of the bounding box."""
    b = _c(info)["bbox"]

    def corner(x, y):
        return F.concat(b[x].cast("string"), F.lit(" "), b[y].cast("string"))

    ring = [corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"),
            corner("minx", "miny")]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *ring), F.lit("))"))


def envelope_lower_left(info) -> Column:
    b = _c(info)["bbox"]
    return point_wkt(b["minx"], b["miny"])


def envelope_upper_right(info) -> Column:
    b = _c(info)["bbox"]
    return point_wkt(b["maxx"], b["maxy"])


def min_x(info) -> Column:
    return _c(info)["bbox"]["minx"]


def min_y(info) -> Column:
    return _c(info)["bbox"]["miny"]


def max_x(info) -> Column:
    return _c(info)["bbox"]["maxx"]


def max_y(info) -> Column:
    return _c(info)["bbox"]["maxy"]


def num_geometries(info) -> Column:
    return _c(info)["n_parts"]
