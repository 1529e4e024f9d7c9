"""Polygons with holes: columns `rings`, arrays of closed rings of struct(x, y), the first the shell and the rest holes.

Whether a point lies inside is a matter of parity over all rings, so holes need no case of their own. With whole
coordinates every predicate is exact. A row without rings, or with null ones, meets nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import cross, segments_meet


def ring(*points) -> Column:
    """A closed ring through points (x, y), columns or numbers; the first is repeated at the end."""
    return F.array(*(F.struct(F.expr(str(x)).cast("long").alias("x"), F.expr(str(y)).cast("long").alias("y")) for x, y in (*points, points[0])))


def steps(rings: Column) -> Column:
    """array of struct(x1, y1, x2, y2): the steps of all rings."""
    one = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(F.element_at(r, i)["x"].alias("x1"), F.element_at(r, i)["y"].alias("y1"), F.element_at(r, i + 1)["x"].alias("x2"), F.element_at(r, i + 1)["y"].alias("y2")))
    return F.flatten(F.transform(rings, one))


def scaled(rings: Column, by: int) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct((p["x"] * by).alias("x"), (p["y"] * by).alias("y"))))


def _on(s, x, y) -> Column:
    """Whether (x, y) lies on the step s."""
    return (cross(s["x1"], s["y1"], s["x2"], s["y2"], x, y) == 0) & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))


def on_boundary(rings: Column, x: Column, y: Column) -> Column:
    return F.exists(steps(rings), lambda s: _on(s, x, y))


def inside(rings: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies in the interior; the rings themselves are outside."""
    past = lambda s: ((s["y1"] > y) != (s["y2"] > y)) & ((cross(s["x1"], s["y1"], s["x2"], s["y2"], x, y) > 0) == (s["y2"] > s["y1"]))
    return (F.size(F.filter(steps(rings), past)) % 2 == 1) & ~on_boundary(rings, x, y)


def _crossed(rings, x1, y1, x2, y2) -> Column:
    return F.exists(steps(rings), lambda s: segments_meet(x1, y1, x2, y2, s["x1"], s["y1"], s["x2"], s["y2"]))


def meets_segment(rings: Column, x1, y1, x2, y2) -> Column:
    """Whether a segment and the closed polygon share a point."""
    return _crossed(rings, x1, y1, x2, y2) | inside(rings, x1, y1)


def holds_segment(rings: Column, x1, y1, x2, y2) -> Column:
    """Whether a whole segment lies in the interior."""
    return inside(rings, x1, y1) & ~_crossed(rings, x1, y1, x2, y2)


def _moments(r: Column) -> Column:
    """struct(a, x, y): twice the signed area, and six times the moments, of one closed ring."""
    def add(m, i):
        p, q = F.element_at(r, i), F.element_at(r, i + 1)
        # relative to the first point, which keeps the products small
        px, py, qx, qy = (a - b for a, b in ((p["x"], r[0]["x"]), (p["y"], r[0]["y"]), (q["x"], r[0]["x"]), (q["y"], r[0]["y"])))
        w = px * qy - qx * py
        return F.struct((m["a"] + w).alias("a"), (m["x"] + (px + qx) * w).alias("x"), (m["y"] + (py + qy) * w).alias("y"))

    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("a", "x", "y")))
    return F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), zero, add)


def measures(df: DataFrame, rings: str = "rings") -> DataFrame:
    """df with area and centroid (x, y) of its polygons: the shell's less the holes', whichever way the rings run."""
    parts = F.transform(F.col(rings), lambda r: F.struct(_moments(r).alias("m"), r[0]["x"].alias("x0"), r[0]["y"].alias("y0")))
    signed = lambda p, i: F.abs(p["m"]["a"]) / 2.0 * F.when(i == 0, 1).otherwise(-1)
    total = lambda f: F.aggregate(F.transform(parts, f), F.lit(0.0), lambda a, v: a + v)
    area = total(signed)
    mid = lambda c: total(lambda p, i: signed(p, i) * (p[f"{c}0"] + p["m"][c] / (3.0 * F.nullif(p["m"]["a"], F.lit(0).cast("long"))))) / F.nullif(area, F.lit(0.0))
    return df.withColumns({"area": area, "x": mid("x"), "y": mid("y")})
