"""Registry of shared nodes between regions, points of interest and table mutation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """new wins on all columns; within new the last by seq. Other rows of old stay. Repeating it changes nothing."""
    last = new if seq is None else new.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).filter("_rn = 1").drop("_rn")
    return old.join(last, key, "left_anti").unionByName(last, allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    first = new.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(seq))).filter("_rn = 1").drop("_rn")
    return old.unionByName(first.join(old, key, "left_anti"), allowMissingColumns=True)


def insert_replace(old: DataFrame, new: DataFrame, key: str, seq: str, defaults: dict | None = None) -> DataFrame:
    """As upsert, but columns that new lacks go back to their defaults, or to null."""
    lacking = {c: F.lit((defaults or {}).get(c)).cast(old.schema[c].dataType) for c in old.columns if c not in new.columns}
    return upsert(old, new.withColumns(lacking), key, seq)


def coverage(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.agg(F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy"))


def in_box(x: Column, y: Column, box) -> Column:
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def in_band(x: Column, y: Column, box, band: int) -> Column:
    """Within band of an edge of the box, and not outside the box grown by band."""
    near = F.least(F.abs(x - box[0]), F.abs(x - box[2]), F.abs(y - box[1]), F.abs(y - box[3])) <= band
    return near & x.between(box[0] - band, box[2] + band) & y.between(box[1] - band, box[3] + band)


def adopt(registry: DataFrame, native: DataFrame, box, unknown: float = -999.0) -> DataFrame:
    """Registry rows in the box that the native nodes lack, verbatim; a null depth is unknown."""
    own = registry.filter(in_box(F.col("lon_e5"), F.col("lat_e5"), box))
    return own.join(native.select(F.col("k").alias("node_id")), "node_id", "left_anti").withColumn("node_depth", F.coalesce("node_depth", F.lit(unknown)))


def connect(adopted: DataFrame, native: DataFrame, land: DataFrame, reach: int, most: int = 2) -> DataFrame:
    """(node_id, near, d2, rank, reason) of each adopted(node_id, x, y): links to its nearest native(k, x, y) within reach
    that cross no land, most at a node and never among adopted ones. Where there is none, a row with the reason alone.
    """
    from .hazards import meeting
    from .spatial import radius_join

    pairs = radius_join(adopted.select(F.col("node_id").alias("k"), "x", "y"), native, reach).filter("l.k <> r.k")
    pairs = pairs.select(F.col("l.k").alias("u"), F.col("r.k").alias("v"), "d2", F.col("l.x").alias("x1"), F.col("l.y").alias("y1"), F.col("r.x").alias("x2"), F.col("r.y").alias("y2"))
    pairs = pairs.withColumns({"minx": F.least("x1", "x2"), "miny": F.least("y1", "y2"), "maxx": F.greatest("x1", "x2"), "maxy": F.greatest("y1", "y2")})
    blocked = meeting(pairs, land).select("l.u", "l.v").distinct().withColumn("blocked", F.lit(True))
    asked = pairs.select("u", "v", "d2").join(blocked, ["u", "v"], "left").withColumn("blocked", F.coalesce("blocked", F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d2", "v"))
    links = asked.filter("not blocked").withColumn("rank", rank).filter(F.col("rank") <= most)
    links = links.select(F.col("u").alias("node_id"), F.col("v").alias("near"), "d2", "rank", F.lit("connected").alias("reason"))
    near = asked.groupBy(F.col("u").alias("node_id")).agg(F.count("*").alias("n"))
    rest = adopted.select("node_id").join(links, "node_id", "left_anti").join(near, "node_id", "left")
    rest = rest.select("node_id", F.lit(None).cast("long").alias("near"), F.lit(None).cast("long").alias("d2"), F.lit(None).cast("int").alias("rank"), F.when(F.col("n").isNull(), "no node in reach").otherwise("land in between").alias("reason"))
    return links.unionByName(rest)


def publish(nodes: DataFrame, adopted: DataFrame, box, band: int, apart: int) -> DataFrame:
    """Coastal nodes in the band that lie further than apart from every adopted node."""
    from .spatial import radius_join

    own = nodes.filter((F.col("node_type") == "coastal") & in_band(F.col("x"), F.col("y"), box, band))
    near = radius_join(own, adopted, apart).select(F.col("l.k").alias("k")).distinct()
    return own.join(near, "k", "left_anti")


def snap_pois(pois: DataFrame, nodes: DataFrame, reach: int, snap_beyond: int, snap_types: tuple[str, ...]) -> DataFrame:
    """Each POI(poi, kind, x, y) with its nearest node within reach; those of snap_types move there if further than snap_beyond."""
    from .spatial import radius_join

    near = radius_join(pois, nodes, reach)
    w = Window.partitionBy("l.poi").orderBy("d2", "r.k")
    best = near.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(F.col("l.poi").alias("poi"), F.col("r.k").alias("node"), "d2", F.col("r.x").alias("nx"), F.col("r.y").alias("ny"))
    moves = F.col("kind").isin(*snap_types) & (F.col("d2") > snap_beyond * snap_beyond)
    j = pois.join(best, "poi", "left").withColumn("moved", F.coalesce(moves, F.lit(False)))
    return j.select("poi", "kind", "node", "d2", "moved", F.when(F.col("moved"), F.col("nx")).otherwise(F.col("x")).alias("x"), F.when(F.col("moved"), F.col("ny")).otherwise(F.col("y")).alias("y"))


def reject_reasons(df: DataFrame, reason: Column) -> DataFrame:
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def poi_outcome(name: Column, kind: Column) -> Column:
    """Why a point of interest is skipped, or "kept"."""
    return F.when(F.coalesce(F.trim(name), F.lit("")) == "", "unnamed").when(kind.isNull(), "no geometry").when(~kind.isin("Point", "Polygon", "LineString"), "unsupported").otherwise("kept")
