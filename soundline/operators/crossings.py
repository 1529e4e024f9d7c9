"""Where waterway lines cross bridges and locks: one point a bridge, one pair of gates a lock.

A line is the segments that share the value of column line. Rectangles stand for bridges and locks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hazards import meeting


def _within(a: Column, b: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """From where to where along a-b, as shares of it, the coordinate is between low and high."""
    d = (b - a).cast("double")
    one, two = (low - a) / F.nullif(d, F.lit(0.0)), (high - a) / F.nullif(d, F.lit(0.0))
    return F.coalesce(F.least(one, two), F.lit(0.0)), F.coalesce(F.greatest(one, two), F.lit(1.0))


def _clipped(segments: DataFrame, boxes: DataFrame, key: str, line: str) -> DataFrame:
    """The part of each segment inside each rectangle it meets: its ends, and whether they lie on the rectangle's side."""
    l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    (x0, x1), (y0, y1) = _within(l("x1"), l("x2"), r("minx"), r("maxx")), _within(l("y1"), l("y2"), r("miny"), r("maxy"))
    met = meeting(segments, boxes).withColumn("t0", F.greatest(F.lit(0.0), x0, y0)).withColumn("t1", F.least(F.lit(1.0), x1, y1)).filter("t0 <= t1")
    at = lambda t: (l("x1") + F.col(t) * (l("x2") - l("x1")), l("y1") + F.col(t) * (l("y2") - l("y1")))
    side = lambda n: l(f"x{n}").isin(r("minx"), r("maxx")) | l(f"y{n}").isin(r("miny"), r("maxy"))
    (ax, ay), (bx, by) = at("t0"), at("t1")
    return met.select(r(key).alias(key), l(line).alias("line"), ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), ((F.col("t0") > 0) | side(1)).alias("a_side"), ((F.col("t1") < 1) | side(2)).alias("b_side"))


def bridge_crossings(segments: DataFrame, bridges: DataFrame, key: str = "bridge_id", line: str = "u") -> DataFrame:
    """bridge, line, x, y: the centre of the line's part under the bridge, by length; of a mere touch, the point."""
    c = _clipped(segments, bridges, key, line).withColumn("n", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    mid = lambda a, b: (F.sum(F.col("n") * (F.col(a) + F.col(b)) / 2) / F.nullif(F.sum("n"), F.lit(0.0)), F.avg((F.col(a) + F.col(b)) / 2))
    return c.groupBy(key, "line").agg(F.coalesce(*mid("ax", "bx")).alias("x"), F.coalesce(*mid("ay", "by")).alias("y"))


def lock_gates(segments: DataFrame, locks: DataFrame, key: str = "lock_id", line: str = "u") -> DataFrame:
    """lock, line, ax, ay, bx, by, span: of the points where a line crosses a lock's sides, the two farthest apart.

    Points of different lines never make a pair; lines that cross once give none. Of equal spans the smallest points win.
    """
    c = _clipped(segments, locks, key, line)
    at = c.select(key, "line", F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("a_side").alias("side")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"), F.col("b_side").alias("side")))).alias("p"))
    at = at.filter("p.side").select(key, "line", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y")).distinct()
    one, two = at.withColumnsRenamed({"x": "ax", "y": "ay"}), at.withColumnsRenamed({"x": "bx", "y": "by"})
    pairs = one.join(two, [key, "line"]).filter("(ax, ay) < (bx, by)").withColumn("span", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    w = Window.partitionBy(key, "line").orderBy(F.desc(F.round("span", 4)), "ax", "ay", "bx", "by")
    return pairs.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")


def quadrant_links(crossings: DataFrame, nodes: DataFrame, land: DataFrame, reach: int) -> DataFrame:
    """(k, quadrant, near, d2): for each of crossings(k, x, y) the nearest of nodes in each quadrant of the box of half
    width reach around it, among those whose link meets no land."""
    from .hazards import meeting
    from .spatial import box_join

    pairs = box_join(crossings, nodes, margin=reach, left_box=("x", "y", "x", "y"), right_box=("x", "y", "x", "y"))
    dx, dy = F.col("r.x") - F.col("l.x"), F.col("r.y") - F.col("l.y")
    quadrant = F.when(dx >= 0, F.when(dy >= 0, 0).otherwise(3)).otherwise(F.when(dy >= 0, 1).otherwise(2))
    e = pairs.select(F.col("l.k").alias("u"), F.col("r.k").alias("v"), F.col("l.x").alias("x1"), F.col("l.y").alias("y1"), F.col("r.x").alias("x2"), F.col("r.y").alias("y2"), (dx * dx + dy * dy).alias("d2"), quadrant.alias("quadrant"))
    e = e.withColumns({"minx": F.least("x1", "x2"), "miny": F.least("y1", "y2"), "maxx": F.greatest("x1", "x2"), "maxy": F.greatest("y1", "y2")})
    free = e.join(meeting(e, land).select("l.u", "l.v").distinct(), ["u", "v"], "left_anti")
    best = free.groupBy("u", "quadrant").agg(F.min(F.struct("d2", "v")).alias("b"))
    return best.select(F.col("u").alias("k"), "quadrant", F.col("b.v").alias("near"), F.col("b.d2").alias("d2"))
