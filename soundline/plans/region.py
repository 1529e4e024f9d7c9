"""A region from its layers to the published tables: nodes, edges with all attributes, points of interest, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import attributes as A
from ..functions import geometry as G
from ..operators import depth, hazards, seams
from ..operators.components import written

# fixed values: numbers and names of the published schema
ENUMS = {
    "edge_type": ("coastal", "inland"),
    "poi_type": ("harbour", "lock", "bridge", "fairway", "waterway"),
    "edge_kind": ("centerline", "navmesh_boundary", "lane", "macro"),
    "node_kind": ("point", "navmesh_vertex", "supernode"),
}
SOURCES = ("land", "coastal_water", "depth_areas", "bridges", "locks", "fairways", "pois", "restricted_areas", "obstacles", "hulks", "mariculture", "caution_areas", "inland_waterways")
EMPTY = {
    "navmesh_regions": "id long, vertices string, triangles string, neighbours string, source_tier int, source_id long",
    "override_provenance": "id long, table_name string, row_id long, field string, old_value string, new_value string",
}


def edge_table(edges: DataFrame, layers: dict[str, DataFrame], buffer: int = 150) -> DataFrame:
    """One row for each of edges(u, v): all attributes by equi-joins on (u, v).

    layers: nodes(k, lon_e5, lat_e5, node_type), depth_areas, bridges, locks, fairways, obstacles and land, as boxes or
    polygons. crosses_land is 0, as crossing edges are stripped before. Parts are written one by one: a single plan of
    all of them takes more of the driver's memory than their rows do.
    """
    nodes = layers["nodes"]
    e = written(depth.with_ends(edges, nodes))
    boxes = hazards.obstacle_boxes(layers["obstacles"], buffer)
    low = written(depth.edge_min_depth(e, layers["depth_areas"]))
    kind = nodes.select("k", "node_type")
    inland = (F.col("a") == "inland") & (F.col("b") == "inland")
    both = e.join(kind.toDF("u", "a").hint("merge"), "u").join(kind.toDF("v", "b").hint("merge"), "v").select("u", "v", A.edge_type_id(F.when(inland, "inland").otherwise("coastal")).alias("edge_type_id"))
    out = e.select("u", "v", F.round(G.haversine(*(F.col(c) / 100000.0 for c in ("x1", "y1", "x2", "y2"))), 2).alias("distance"))
    for part in (
        low.select("u", "v", "drval1"), hazards.soft_depth(e, low, boxes), hazards.air_draft(e, layers["bridges"]), hazards.lock_width(e, layers["locks"]),
        hazards.fairway(e, layers["fairways"]), hazards.crosses_obstacle(e, boxes), hazards.distance_to_land(e, layers["land"]), both,
    ):
        out = out.join(written(part).hint("merge"), ["u", "v"])
    out = out.join(hazards.inside_locks(e, layers["locks"]), ["u", "v"], "left").withColumn("crosses_land", F.lit(0)).withColumn("buoyage_direction", A.buoyage_direction())
    return out.select("u", "v", "distance", "min_depth", "drval1", "max_air_draft", "min_width", "cost_factor", "traffic_mode", "crosses_obstacle", "crosses_land", "distance_to_land", "lock_id", "edge_type_id", "buoyage_direction")


def node_table(nodes: DataFrame, depth_areas: DataFrame, config: Config = Config()) -> DataFrame:
    """The published columns of nodes(k, lon_e5, lat_e5, node_type), and k."""
    lon, lat = F.col("lon_e5") / 100000.0, F.col("lat_e5") / 100000.0
    ids = nodes.select("k", A.node_id(lon, lat, F.col("node_type") == "inland").alias("id"), lat.alias("lat"), lon.alias("lon"))
    return ids.join(depth.node_depth(nodes, depth_areas), "k").select("k", "id", "lat", "lon", "node_depth", F.lit(None).cast("long").alias("region_id"), F.lit(0).alias("node_kind_id"), F.lit(config.source_tier).alias("source_tier"), F.lit(None).cast("long").alias("source_id"))


def tables(spark: SparkSession, layers: dict[str, DataFrame], name: str, config: Config = Config()) -> dict[str, DataFrame]:
    """The eleven tables of a region. layers as edge_table has them, with edges(u, v), and pois(poi, kind, x, y).

    Edges that meet land go first. Opening bridges never limit air draft. A layer without rows gives the defaults of
    its attributes; sources are numbered by their place.
    """
    nodes = node_table(layers["nodes"], layers["depth_areas"], config)
    kept = hazards.strip_crossing(depth.with_ends(layers["edges"], layers["nodes"]), layers["land"])
    ids = nodes.select("k", "id")
    e = edge_table(kept, layers).join(ids.toDF("u", "source"), "u").join(ids.toDF("v", "target"), "v")
    edges = e.select(
        "source", "target", "distance", "min_depth", "drval1", "max_air_draft", "min_width", "cost_factor", "distance_to_land", "edge_type_id", "traffic_mode", "crosses_land", "crosses_obstacle",
        F.lit(0).alias("edge_kind_id"), F.lit(config.source_tier).alias("source_tier"), F.lit(None).cast("long").alias("source_id"), F.lit(None).cast("string").alias("width_profile"),
        F.col("lock_id").isNotNull().cast("int").alias("requires_lock"), "lock_id",
    )
    snapped = seams.snap_pois(layers["pois"], layers["nodes"].select("k", F.col("lon_e5").alias("x"), F.col("lat_e5").alias("y")), int(config.poi_radius), int(config.poi_snap), ("bridge",))
    number = F.array_position(F.array(*map(F.lit, ENUMS["poi_type"])), F.col("kind")) - 1
    pois = snapped.filter("node is not null").join(ids.toDF("node", "node_id"), "node").select(A.poi_id(F.col("kind"), F.col("y") / 100000.0, F.col("x") / 100000.0).alias("id"), number.alias("poi_type_id"), (F.col("y") / 100000.0).alias("lat"), (F.col("x") / 100000.0).alias("lon"), "node_id")
    box = seams.coverage(nodes, "lon", "lat").select(F.to_json(F.struct("minx", "miny", "maxx", "maxy")).alias("bounding_box"))
    metadata = box.select(F.lit(1).alias("id"), F.lit(name).alias("name"), F.lit(config.schema_version).alias("schema_version"), F.lit(A.UNKNOWN_DEPTH).alias("depth_unknown_sentinel"), "bounding_box", A.utc_now().alias("last_update_date"))
    sources = spark.createDataFrame([(i + 1, s, "ienc" if s == "inland_waterways" else "enc", 1) for i, s in enumerate(SOURCES)], "id long, name string, kind string, tier int")
    enums = {n: spark.createDataFrame(list(enumerate(values)), "id long, name string") for n, values in ENUMS.items()}
    return {"metadata": metadata, "data_sources": sources, **enums, "nodes": nodes.drop("k"), "edges": edges, "pois": pois, **{n: spark.createDataFrame([], s) for n, s in EMPTY.items()}}
