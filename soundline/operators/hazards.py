"""Attributes that bridges, locks, fairways, land and obstacles give to edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attributes as A
from ..functions.geometry import point_segment_t, segment_meets_rectangle
from . import shapes
from .components import written
from .spatial import box_join


def meeting(ends: DataFrame, boxes: DataFrame) -> DataFrame:
    """(l, r): edges and the polygons that they meet, or rectangles where the right side has no rings."""
    edge = [F.col(f"l.{c}") for c in ("x1", "y1", "x2", "y2")]
    exact = shapes.meets_segment(F.col("r.rings"), *edge) if "rings" in boxes.columns else segment_meets_rectangle(*edge, *(F.col(f"r.{c}") for c in ("minx", "miny", "maxx", "maxy")))
    return box_join(ends, boxes, exact)


def _per_edge(ends: DataFrame, pairs: DataFrame, *aggs) -> DataFrame:
    return ends.select("u", "v").join(pairs.groupBy("l.u", "l.v").agg(*aggs), ["u", "v"], "left")


def air_draft(ends: DataFrame, bridges: DataFrame) -> DataFrame:
    """Least clearance of the fixed bridges met; 999 without any."""
    own = A.clearance(A.categories(F.col("r.catbrg")), F.col("r.vercop"), F.col("r.verclr"))
    return _per_edge(ends, meeting(ends, bridges), F.min(own).alias("c")).select("u", "v", F.coalesce("c", F.lit(A.NO_LIMIT)).alias("max_air_draft"))


def lock_width(ends: DataFrame, locks: DataFrame) -> DataFrame:
    return _per_edge(ends, meeting(ends, locks), F.min("r.horclr").alias("w")).select("u", "v", F.coalesce("w", F.lit(A.NO_LIMIT)).alias("min_width"))


def inside_locks(ends: DataFrame, locks: DataFrame) -> DataFrame:
    """u, v, lock_id of edges that meet a named lock; the first in order wins."""
    named = locks.filter(A.first_name(F.col("name")).isNotNull())
    return meeting(ends, named).groupBy("l.u", "l.v").agg(F.min("r.lock_id").alias("lock_id"))


def fairway(ends: DataFrame, fairways: DataFrame) -> DataFrame:
    """cost_factor 0.8 in a fairway, else 1.2; traffic_mode of the directions met."""
    per = _per_edge(ends, meeting(ends, fairways), F.collect_set("r.trafic").alias("t"), F.lit(True).alias("any"))
    return per.select("u", "v", F.when(F.col("any"), 0.8).otherwise(1.2).alias("cost_factor"), F.when(F.col("any"), A.traffic_mode(F.col("t"))).otherwise(0).alias("traffic_mode"))


def obstacle_boxes(obstructions: DataFrame, buffer: int) -> DataFrame:
    """Obstructions as boxes with their disposition."""
    d = A.disposition(F.col("valsou"), F.col("watlev"))
    return obstructions.select("obstr_id", d.alias("d"), *((F.col(c) + s * buffer).alias(n) for n, c, s in (("minx", "x", -1), ("miny", "y", -1), ("maxx", "x", 1), ("maxy", "y", 1)))).select("*", "d.is_hard", "d.depth").drop("d")


def crosses_obstacle(ends: DataFrame, boxes: DataFrame, exempt: DataFrame | None = None) -> DataFrame:
    """u, v, crosses_obstacle (0/1) by hard obstacles; exempt edges(u, v) never cross any."""
    own = ends if exempt is None else ends.join(exempt, ["u", "v"], "left_anti")
    hit = meeting(own, boxes.filter("is_hard")).select("l.u", "l.v").distinct().withColumn("crosses_obstacle", F.lit(1))
    return ends.select("u", "v").join(hit, ["u", "v"], "left").withColumn("crosses_obstacle", F.coalesce("crosses_obstacle", F.lit(0)))


def soft_depth(ends: DataFrame, depths: DataFrame, boxes: DataFrame) -> DataFrame:
    """min_depth lowered by soft obstacles: they replace an unknown depth, and else win if shallower."""
    soft = _per_edge(ends, meeting(ends, boxes.filter("not is_hard")), F.min("r.depth").alias("soft"))
    m = F.col("min_depth")
    return depths.join(soft, ["u", "v"]).select("u", "v", F.when(F.col("soft").isNull(), m).when(m == A.UNKNOWN_DEPTH, F.col("soft")).otherwise(F.least(m, F.col("soft"))).alias("min_depth"))


def strip_crossing(ends: DataFrame, land: DataFrame) -> DataFrame:
    """Edges that meet no land, both arcs of a pair alike."""
    hit = meeting(ends, land).select(F.least("l.u", "l.v").alias("a"), F.greatest("l.u", "l.v").alias("b")).distinct()
    return ends.join(hit, (F.least("u", "v") == F.col("a")) & (F.greatest("u", "v") == F.col("b")), "left_anti").select("u", "v")


def classify_water(pieces: DataFrame, bands: DataFrame, fairways: DataFrame, ceiling: float = 6.0, wide: int = 2000) -> DataFrame:
    """band_id, kind: wide and deep water is meshed, water with a fairway is laned, the rest becomes a skeleton."""
    deep = box_join(pieces, bands.filter(F.col("drval1") >= ceiling)).select(F.col("l.band_id").alias("band_id")).distinct().withColumn("deep", F.lit(True))
    laned = box_join(pieces, fairways).select(F.col("l.band_id").alias("band_id")).distinct().withColumn("laned", F.lit(True))
    is_wide = F.least(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) >= wide
    kind = F.when(is_wide & F.coalesce("deep", F.lit(False)), "navmesh").when(F.coalesce("laned", F.lit(False)), "laned").otherwise("skeleton")
    return pieces.join(deep, "band_id", "left").join(laned, "band_id", "left").select("band_id", kind.alias("kind"))


def distance_to_land(ends: DataFrame, land: DataFrame, reach: float = 2000) -> DataFrame:
    """(u, v, distance_to_land) of every edge, to two decimals; 9999 where there is no land at all.

    The reach doubles for those edges alone that haven't land within it; a distance within the reach is exact.
    """
    none = F.lit(9999.0).alias("distance_to_land")
    if land.isEmpty():
        return ends.select("u", "v", none)
    x1, y1, x2, y2 = (F.col(f"l.{c}").cast("double") for c in ("x1", "y1", "x2", "y2"))
    minx, miny, maxx, maxy = (F.col(f"r.{c}").cast("double") for c in ("minx", "miny", "maxx", "maxy"))
    sq = lambda c: c * c

    def corner(x, y):
        t = point_segment_t(x, y, x1, y1, x2, y2)
        return sq(x1 + t * (x2 - x1) - x) + sq(y1 + t * (y2 - y1) - y)

    end = lambda x, y: sq(F.greatest(minx - x, x - maxx, F.lit(0.0))) + sq(F.greatest(miny - y, y - maxy, F.lit(0.0)))
    apart = F.least(*(corner(x, y) for x in (minx, maxx) for y in (miny, maxy)), end(x1, y1), end(x2, y2))
    d2 = F.when(segment_meets_rectangle(x1, y1, x2, y2, minx, miny, maxx, maxy), 0.0).otherwise(apart)
    found, todo = None, ends
    while True:
        pairs = box_join(todo, land, margin=reach, size=reach)
        near = pairs.select(F.col("l.u").alias("u"), F.col("l.v").alias("v"), d2.alias("d2")).groupBy("u", "v").agg(F.min("d2").alias("d2"))
        near = written(near.filter(F.col("d2") <= reach * reach))
        done = near.select("u", "v", F.round(F.sqrt("d2"), 2).alias("distance_to_land"))
        found = done if found is None else found.unionByName(done)
        todo = written(todo.join(near, ["u", "v"], "left_anti"))
        if todo.isEmpty():
            return found
        reach *= 2
