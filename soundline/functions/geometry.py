"""Geometry as Column expressions: projections, distances, predicates on rings, rectangles and segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M, MERCATOR_M, DEGREE_M = 6_371_008.8, 6_378_137.0, 111_320.0


def mercator(lon: Column, lat: Column) -> Column:
    """x and y in metres; beyond a pole, where there is no logarithm, y is not a number, and a null stays null."""
    t = F.tan(F.radians(lat) / 2 + 0.7853981633974483)
    y = F.when(t < 0, F.lit(float("nan"))).when(t == 0, F.lit(float("-inf"))).otherwise(F.log(t))
    return F.struct((F.radians(lon) * MERCATOR_M).alias("x"), (y * MERCATOR_M).alias("y"))


def from_mercator(x: Column, y: Column) -> Column:
    """Places between the poles; one beyond them doesn't come back."""
    return F.struct(F.degrees(x / MERCATOR_M).alias("lon"), F.degrees(F.atan(F.exp(y / MERCATOR_M)) * 2 - 1.5707963267948966).alias("lat"))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(a)) * (2 * EARTH_M)


def unit_xyz(lon: Column, lat: Column) -> Column:
    return F.struct((F.cos(F.radians(lat)) * F.cos(F.radians(lon)) * EARTH_M).alias("x"), (F.cos(F.radians(lat)) * F.sin(F.radians(lon)) * EARTH_M).alias("y"), (F.sin(F.radians(lat)) * EARTH_M).alias("z"))


def arc_of_chord(chord: Column) -> Column:
    return F.asin(F.least(chord / (2 * EARTH_M), F.lit(1.0))) * (2 * EARTH_M)


def chord_of_arc(arc: Column) -> Column:
    return F.sin(arc / (2 * EARTH_M)) * (2 * EARTH_M)


def local_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return F.hypot((lon2 - lon1) * DEGREE_M * F.cos(F.radians((lat1 + lat2) / 2)), (lat2 - lat1) * DEGREE_M)


def utm_zone(lon: Column) -> Column:
    return F.least(F.floor((lon + 180) / 6) + 1, F.lit(60)).cast("int")


def cross(x1: Column, y1: Column, x2: Column, y2: Column, px: Column, py: Column) -> Column:
    """Over 0 if p lies left of the way from 1 to 2."""
    return (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)


def segment_meets_rectangle(x1, y1, x2, y2, minx, miny, maxx, maxy) -> Column:
    """Whether a segment and a closed rectangle share a point."""
    c = [cross(x1, y1, x2, y2, px, py) for px in (minx, maxx) for py in (miny, maxy)]
    return (F.least(x1, x2) <= maxx) & (F.greatest(x1, x2) >= minx) & (F.least(y1, y2) <= maxy) & (F.greatest(y1, y2) >= miny) & (F.least(*c) <= 0) & (F.greatest(*c) >= 0)


def segments_meet(ax, ay, bx, by, cx, cy, dx, dy) -> Column:
    """Whether segments a-b and c-d share a point."""
    s = lambda *p: F.signum(cross(*p))
    d1, d2, d3, d4 = s(ax, ay, bx, by, cx, cy), s(ax, ay, bx, by, dx, dy), s(cx, cy, dx, dy, ax, ay), s(cx, cy, dx, dy, bx, by)
    box = (F.least(ax, bx) <= F.greatest(cx, dx)) & (F.least(cx, dx) <= F.greatest(ax, bx)) & (F.least(ay, by) <= F.greatest(cy, dy)) & (F.least(cy, dy) <= F.greatest(ay, by))
    return box & (d1 * d2 <= 0) & (d3 * d4 <= 0)


def strictly_inside(px, py, minx, miny, maxx, maxy) -> Column:
    return (px > minx) & (px < maxx) & (py > miny) & (py < maxy)


def ring_contains(ring: Column, px: Column, py: Column) -> Column:
    """Whether p lies inside a closed ring, an array of struct(x, y) whose last point repeats the first; edges count as outside."""
    n = F.size(ring)
    def hit(i):
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])
    def on(i):
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return (cross(a["x"], a["y"], b["x"], b["y"], px, py) == 0) & px.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & py.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
    steps = F.sequence(F.lit(1), n - 1)
    return (F.size(F.filter(steps, hit)) % 2 == 1) & ~F.exists(steps, on)


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring: positive if it runs counter-clockwise."""
    steps = F.sequence(F.lit(1), F.size(ring) - 1)
    part = lambda i: F.element_at(ring, i)["x"] * F.element_at(ring, i + 1)["y"] - F.element_at(ring, i + 1)["x"] * F.element_at(ring, i)["y"]
    return F.aggregate(F.transform(steps, part), F.lit(0.0), lambda a, x: a + x) / 2


def bounds(points: Column) -> Column:
    pick = lambda f, c: f(F.transform(points, lambda p: p[c]))
    return F.struct(pick(F.array_min, "x").alias("minx"), pick(F.array_min, "y").alias("miny"), pick(F.array_max, "x").alias("maxx"), pick(F.array_max, "y").alias("maxy"))


def rectangle_ring(minx, miny, maxx, maxy) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(p(minx, miny), p(maxx, miny), p(maxx, maxy), p(minx, maxy), p(minx, miny))


def ring_segments(ring: Column) -> Column:
    """array of struct(seq, x1, y1, x2, y2)."""
    step = lambda i: F.struct(i.alias("seq"), F.element_at(ring, i)["x"].alias("x1"), F.element_at(ring, i)["y"].alias("y1"), F.element_at(ring, i + 1)["x"].alias("x2"), F.element_at(ring, i + 1)["y"].alias("y2"))
    return F.transform(F.sequence(F.lit(1), F.size(ring) - 1), step)


def point_segment_t(px, py, x1, y1, x2, y2) -> Column:
    """Where on the segment, from 0 to 1, the point nearest to p lies."""
    n = F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2)
    t = ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / F.nullif(n, F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))


def to_geojson(kind: Column, coordinates: Column) -> Column:
    return F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))
