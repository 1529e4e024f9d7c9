import sqlite3

from pyspark.sql import functions as F

from soundline.config import Config
from soundline.plans import region
from soundline.shape_queries import _layers, shaped
from soundline.sources import sqlite
from soundline.sources.fixtures import layer
from soundline.streaming import registry

SF = "/root/testdata/sf0.001"


def test_tables_of_a_region_in_one_file(spark, tmp_path):
    layers = _layers(spark, SF)
    layers["pois"] = layer(spark, SF, "chart_bridges").select(F.col("bridge_id").alias("poi"), F.lit("bridge").alias("kind"), F.col("minx").alias("x"), F.col("miny").alias("y"))
    layers["land"], layers["depth_areas"] = shaped(layers["land"]), shaped(layers["depth_areas"])
    found = region.tables(spark, layers, "pilot", Config(poi_radius=2000.0))
    assert len(found) == 11
    sqlite.write(found, f"{tmp_path}/pilot.db")
    con = sqlite3.connect(f"{tmp_path}/pilot.db")
    count = lambda t: con.execute(f"SELECT count(*) FROM {t}").fetchone()[0]
    assert count("nodes") == layers["nodes"].count() and 0 < count("edges") <= layers["edges"].count() and count("data_sources") == 13 and count("override_provenance") == 0
    assert con.execute("SELECT count(*) FROM edges WHERE source NOT IN (SELECT id FROM nodes) OR target NOT IN (SELECT id FROM nodes) OR crosses_land <> 0").fetchone()[0] == 0
    assert con.execute("SELECT count(*) FROM pois WHERE poi_type_id <> 2 OR node_id NOT IN (SELECT id FROM nodes)").fetchone()[0] == 0 and count("pois") > 0
    assert sqlite.metadata(f"{tmp_path}/pilot.db")["depth_unknown_sentinel"] == -999.0
    assert {r[1] for r in con.execute("SELECT * FROM sqlite_master WHERE type = 'index'")} == {"idx_edges_source", "idx_edges_target", "idx_nodes_lat_lon"}


def test_edges_without_layers_have_defaults(spark):
    layers = {k: v if k in ("nodes", "edges") else v.limit(0) for k, v in _layers(spark, SF).items()}
    row = region.edge_table(layers["edges"], layers).select("min_depth", "drval1", "max_air_draft", "min_width", "cost_factor", "traffic_mode", "crosses_obstacle", "distance_to_land", "lock_id").distinct().collect()
    assert [tuple(r) for r in row] == [(99.0, None, 999.0, 999.0, 1.2, 0, 0, 9999.0, None)]


def test_registry_follows_files(spark, tmp_path):
    rows = layer(spark, SF, "registry_rows").withColumn("batch", F.col("batch").cast("long"))
    arriving, path, checkpoint = (f"{tmp_path}/{n}" for n in ("arriving", "registry", "checkpoint"))
    assert registry.current(spark, path).count() == 0
    for batch in (1, 2):
        rows.filter(F.col("batch") == batch).select("node_id", "lon_e5", "lat_e5", "node_depth", "source_region", "batch").write.mode("append").parquet(arriving)
        registry.follow(spark, arriving, path, checkpoint).awaitTermination()
    best = {}
    for r in rows.orderBy("batch").collect():
        best[r.node_id] = (r.lon_e5, r.lat_e5, r.node_depth, r.source_region, r.batch)
    assert {r.node_id: (r.lon_e5, r.lat_e5, r.node_depth, r.source_region, r.batch) for r in registry.current(spark, path).collect()} == best
    registry.follow(spark, arriving, path, checkpoint).awaitTermination()
    assert registry.current(spark, path).count() == len(best)
