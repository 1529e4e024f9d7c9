"""Multi-scale depth attribution of edges and nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import NO_DEPTH, UNKNOWN_DEPTH
from ..functions.geometry import strictly_inside
from . import shapes
from .spatial import box_join

FAST_DEPTH, COARSE_DEPTH, DRYING_LIMIT = 5.0, 10.0, -20.0


def charted(d1, d2):
    """A band that starts implausibly deep in the drying range counts by its other end."""
    return F.when((d1 < DRYING_LIMIT) & (d2 >= DRYING_LIMIT), d2).otherwise(d1)


def _around(x: str, y: str, bands: DataFrame):
    """Whether a point of the left side lies strictly inside a band: its polygon where there are rings, else its box."""
    if "rings" in bands.columns:
        return shapes.inside(F.col("r.rings"), F.col(f"l.{x}"), F.col(f"l.{y}"))
    return strictly_inside(F.col(f"l.{x}"), F.col(f"l.{y}"), F.col("r.minx"), F.col("r.miny"), F.col("r.maxx"), F.col("r.maxy"))


def with_ends(edges: DataFrame, nodes: DataFrame, x: str = "lon_e5", y: str = "lat_e5") -> DataFrame:
    """edges(u, v) with both ends' places and the box around them."""
    a = nodes.select(F.col("k").alias("u"), F.col(x).alias("x1"), F.col(y).alias("y1"))
    b = nodes.select(F.col("k").alias("v"), F.col(x).alias("x2"), F.col(y).alias("y2"))
    e = edges.join(a.hint("merge"), "u").join(b.hint("merge"), "v")
    return e.select("u", "v", "x1", "y1", "x2", "y2", F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"), F.greatest("y1", "y2").alias("maxy"))


def edge_min_depth(ends: DataFrame, bands: DataFrame) -> DataFrame:
    """u, v, min_depth, drval1.

    If every band whose box meets the edge's is deep, their least depth holds. Else each of five samples takes the
    deepest band around it (ties: by its other end), and the edge the least of the samples; a least of zero or less
    is unknown if all samples that aren't deep lie in coarse bands only.
    """
    pairs = box_join(ends, bands)
    fast = pairs.groupBy("l.u", "l.v").agg(F.min("r.drval1").alias("least"))
    fast = ends.join(fast, ["u", "v"], "left")
    is_fast = F.col("least") >= FAST_DEPTH
    deep = fast.filter(is_fast).select("u", "v", F.col("least").alias("min_depth"), F.col("least").alias("drval1"))
    slow = fast.filter(F.coalesce(~is_fast, F.lit(True)))
    # samples at four times the scale are whole numbers
    at = F.expr("explode(sequence(0, 4))").alias("f")
    samples = slow.select("u", "v", at, "x1", "y1", "x2", "y2").select("u", "v", "f", (F.col("x1") * (4 - F.col("f")) + F.col("x2") * F.col("f")).alias("px"), (F.col("y1") * (4 - F.col("f")) + F.col("y2") * F.col("f")).alias("py"))
    box = ("px", "py", "px", "py")
    rings = [shapes.scaled(F.col("rings"), 4).alias("rings")] if "rings" in bands.columns else []
    grown = bands.select("drval1", "drval2", *((4 * F.col(c)).alias(c) for c in ("minx", "miny", "maxx", "maxy")), *rings)
    hits = box_join(samples, grown.filter("drval1 is not null"), _around("px", "py", grown), size=8000, left_box=box)
    best = hits.groupBy("l.u", "l.v", "l.f").agg(F.max(F.struct(F.col("r.drval1").alias("d1"), F.coalesce("r.drval2", F.lit(-1e9)).alias("d2"))).alias("b"))
    per = samples.join(best, ["u", "v", "f"], "left").select("u", "v", F.coalesce(charted(F.col("b.d1"), F.col("b.d2")), F.lit(NO_DEPTH)).alias("d"), F.col("b.d1").alias("d1"), F.col("b.d2").alias("d2"))
    least = per.groupBy("u", "v").agg(
        F.min("d").alias("least"),
        F.expr(f"coalesce(bool_and(d1 = 0 and d2 >= {COARSE_DEPTH}) filter (where d <= 0), false)").alias("coarse"),
    )
    unknown = (F.col("least") <= 0) & F.col("coarse")
    rest = least.select("u", "v", F.when(unknown, UNKNOWN_DEPTH).otherwise(F.col("least")).alias("min_depth"), F.when(F.col("least") != NO_DEPTH, F.col("least")).alias("drval1"))
    return deep.unionByName(rest)


def node_depth(nodes: DataFrame, bands: DataFrame, x: str = "lon_e5", y: str = "lat_e5") -> DataFrame:
    """k, node_depth: the deepest band around the node; no band: unknown; only bands without a depth: 99."""
    hits = box_join(nodes, bands, _around(x, y, bands), left_box=(x, y, x, y))
    best = hits.groupBy(F.col("l.k").alias("k")).agg(F.max(F.when(F.col("r.drval1").isNotNull(), F.struct(F.col("r.drval1").alias("d1"), F.coalesce("r.drval2", F.lit(-1e9)).alias("d2")))).alias("b"), F.lit(True).alias("any"))
    return nodes.join(best, "k", "left").select("k", F.when(F.col("any").isNull(), UNKNOWN_DEPTH).otherwise(F.coalesce(charted(F.col("b.d1"), F.col("b.d2")), F.lit(NO_DEPTH))).alias("node_depth"))
