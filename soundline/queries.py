"""All registered queries of the engine and the SQL that a second engine checks them by."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions import attributes as A
from .functions import geometry as G
from .functions import raster as R
from .operators import components, crossings, depth, graph, hazards, seams, spatial
from .sources.fixtures import layer, oracle_text, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = oracle_text(sql)
        return f

    return keep


def ends(spark, d) -> DataFrame:
    return depth.with_ends(layer(spark, d, "chart_edges"), layer(spark, d, "chart_nodes"))


def points(spark, d) -> DataFrame:
    return layer(spark, d, "chart_nodes").select("k", F.col("lon_e5").alias("x"), F.col("lat_e5").alias("y"), "node_type")


_E = """e AS (SELECT g.u, g.v, a.lon_e5 AS x1, a.lat_e5 AS y1, b.lon_e5 AS x2, b.lat_e5 AS y2 FROM {chart_edges} g JOIN {chart_nodes} a ON g.u = a.k JOIN {chart_nodes} b ON g.v = b.k)"""
_MEETS = """least(x1, x2) <= maxx AND greatest(x1, x2) >= minx AND least(y1, y2) <= maxy AND greatest(y1, y2) >= miny
  AND least((x2-x1)*(miny-y1)-(y2-y1)*(minx-x1), (x2-x1)*(maxy-y1)-(y2-y1)*(minx-x1), (x2-x1)*(miny-y1)-(y2-y1)*(maxx-x1), (x2-x1)*(maxy-y1)-(y2-y1)*(maxx-x1)) <= 0
  AND greatest((x2-x1)*(miny-y1)-(y2-y1)*(minx-x1), (x2-x1)*(maxy-y1)-(y2-y1)*(minx-x1), (x2-x1)*(miny-y1)-(y2-y1)*(maxx-x1), (x2-x1)*(maxy-y1)-(y2-y1)*(maxx-x1)) >= 0"""
_DEPTHS = """
  cand AS (SELECT u, v, min(drval1) AS least FROM e JOIN {depth_bands} b ON least(x1, x2) <= maxx AND greatest(x1, x2) >= minx AND least(y1, y2) <= maxy AND greatest(y1, y2) >= miny GROUP BY u, v),
  s AS (SELECT e.u, e.v, f, x1*(4-f)+x2*f AS px, y1*(4-f)+y2*f AS py FROM e CROSS JOIN (SELECT unnest([0,1,2,3,4]) AS f) LEFT JOIN cand c ON e.u = c.u AND e.v = c.v WHERE coalesce(c.least < 5, TRUE)),
  r AS (SELECT u, v, f, drval1, drval2, row_number() OVER (PARTITION BY u, v, f ORDER BY drval1 DESC, drval2 DESC NULLS LAST) AS rn FROM s JOIN {depth_bands} b ON px > 4*minx AND px < 4*maxx AND py > 4*miny AND py < 4*maxy WHERE drval1 IS NOT NULL),
  p AS (SELECT s.u, s.v, drval1 AS d1, drval2 AS d2, coalesce(CASE WHEN drval1 < -20 AND drval2 >= -20 THEN drval2 ELSE drval1 END, 99) AS d FROM s LEFT JOIN r ON s.u = r.u AND s.v = r.v AND s.f = r.f AND rn = 1),
  m AS (SELECT u, v, min(d) AS least, coalesce(bool_and(d1 = 0 AND d2 >= 10) FILTER (WHERE d <= 0), FALSE) AS coarse FROM p GROUP BY u, v),
  depths AS (SELECT u, v, least AS min_depth, least AS drval1 FROM cand WHERE least >= 5
    UNION ALL SELECT u, v, CASE WHEN least <= 0 AND coarse THEN -999 ELSE least END, CASE WHEN least <> 99 THEN least END FROM m)"""


@query(f"WITH {_E}, {_DEPTHS} SELECT u, v, min_depth, drval1 FROM depths")
def edge_min_depth(spark, d):
    return depth.edge_min_depth(ends(spark, d), layer(spark, d, "depth_bands"))


@query("""WITH h AS (SELECT k, drval1, drval2 FROM {chart_nodes} JOIN {depth_bands} b ON lon_e5 > minx AND lon_e5 < maxx AND lat_e5 > miny AND lat_e5 < maxy),
  t AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY drval1 DESC NULLS LAST, drval2 DESC NULLS LAST) AS rn FROM h)
  SELECT n.k, CASE WHEN t.k IS NULL THEN -999.0::DOUBLE WHEN drval1 IS NULL THEN 99.0::DOUBLE WHEN drval1 < -20 AND drval2 >= -20 THEN drval2 ELSE drval1 END AS node_depth
  FROM {chart_nodes} n LEFT JOIN t ON n.k = t.k AND rn = 1""")
def node_depth(spark, d):
    return depth.node_depth(layer(spark, d, "chart_nodes"), layer(spark, d, "depth_bands"))


@query(f"""WITH {_E}, c AS (SELECT *, CASE WHEN len(regexp_extract_all(catbrg, '[0-9]+')) > 0 THEN regexp_extract_all(catbrg, '[0-9]+') ELSE [catbrg] END AS cats FROM {{chart_bridges}}),
  h AS (SELECT u, v, min(CASE WHEN list_has_any(cats, ['3','4','5','6','7']) OR vercop IS NOT NULL OR verclr IS NULL OR verclr = 0 THEN 999.0::DOUBLE ELSE verclr END) AS a FROM e JOIN c ON {_MEETS} GROUP BY u, v)
  SELECT e.u, e.v, coalesce(a, 999.0::DOUBLE) AS max_air_draft FROM e LEFT JOIN h ON e.u = h.u AND e.v = h.v""")
def edge_air_draft(spark, d):
    return hazards.air_draft(ends(spark, d), layer(spark, d, "chart_bridges"))


@query(f"""WITH {_E}, h AS (SELECT u, v, min(horclr) AS w FROM e JOIN {{chart_locks}} b ON {_MEETS} GROUP BY u, v)
  SELECT e.u, e.v, coalesce(w, 999.0::DOUBLE) AS min_width FROM e LEFT JOIN h ON e.u = h.u AND e.v = h.v""")
def edge_lock_width(spark, d):
    return hazards.lock_width(ends(spark, d), layer(spark, d, "chart_locks"))


@query(f"WITH {_E} SELECT u, v, min(lock_id) AS lock_id FROM e JOIN {{chart_locks}} b ON trim(name) <> '' AND {_MEETS} GROUP BY u, v")
def edges_inside_locks(spark, d):
    return hazards.inside_locks(ends(spark, d), layer(spark, d, "chart_locks"))


@query(f"""WITH {_E}, h AS (SELECT u, v, count(DISTINCT trafic) AS n, min(trafic) AS t FROM e JOIN {{chart_fairways}} b ON {_MEETS} GROUP BY u, v)
  SELECT e.u, e.v, CASE WHEN h.u IS NULL THEN 1.2::DOUBLE ELSE 0.8::DOUBLE END AS cost_factor, CASE WHEN n = 1 AND t IN (1, 3) THEN 1 WHEN n = 1 AND t IN (-1, -3) THEN 2 ELSE 0 END AS traffic_mode
  FROM e LEFT JOIN h ON e.u = h.u AND e.v = h.v""")
def edge_fairway_cost_traffic(spark, d):
    return hazards.fairway(ends(spark, d), layer(spark, d, "chart_fairways"))


_HARD = "NOT (TRY_CAST(valsou AS DOUBLE) IS NOT NULL OR coalesce(watlev IN (3, 4), FALSE))"
_OBSTR = "o AS (SELECT x-150 AS minx, x+150 AS maxx, y-150 AS miny, y+150 AS maxy, " + _HARD + " AS is_hard, coalesce(TRY_CAST(valsou AS DOUBLE), 0) AS depth FROM {chart_obstructions})"


@query(f"WITH {_E}, {_OBSTR}, h AS (SELECT DISTINCT u, v FROM e JOIN o ON is_hard AND {_MEETS}) SELECT e.u, e.v, CASE WHEN h.u IS NULL THEN 0 ELSE 1 END AS crosses_obstacle FROM e LEFT JOIN h ON e.u = h.u AND e.v = h.v")
def edge_crosses_obstacle(spark, d):
    return hazards.crosses_obstacle(ends(spark, d), hazards.obstacle_boxes(layer(spark, d, "chart_obstructions"), 150))


@query(f"""WITH {_E}, {_DEPTHS}, {_OBSTR}, h AS (SELECT u, v, min(depth) AS soft FROM e JOIN o ON NOT is_hard AND {_MEETS} GROUP BY u, v)
  SELECT g.u, g.v, CASE WHEN soft IS NULL THEN min_depth WHEN min_depth = -999 THEN soft ELSE least(min_depth, soft) END AS min_depth FROM depths g LEFT JOIN h ON g.u = h.u AND g.v = h.v""")
def edge_soft_obstruction_depth(spark, d):
    e = ends(spark, d)
    return hazards.soft_depth(e, depth.edge_min_depth(e, layer(spark, d, "depth_bands")), hazards.obstacle_boxes(layer(spark, d, "chart_obstructions"), 150))


@query(f"SELECT obstr_id, {_HARD} AS is_hard, CASE WHEN TRY_CAST(valsou AS DOUBLE) IS NOT NULL THEN TRY_CAST(valsou AS DOUBLE) WHEN watlev IN (3, 4) THEN 0 END AS depth FROM {{chart_obstructions}}")
def obstruction_disposition(spark, d):
    return layer(spark, d, "chart_obstructions").select("obstr_id", A.disposition(F.col("valsou"), F.col("watlev")).alias("d")).select("obstr_id", "d.is_hard", "d.depth")


@query("SELECT bridge_id, list_has_any(CASE WHEN len(regexp_extract_all(catbrg, '[0-9]+')) > 0 THEN regexp_extract_all(catbrg, '[0-9]+') ELSE [catbrg] END, ['3','4','5','6','7']) OR vercop IS NOT NULL AS movable FROM {chart_bridges}")
def bridge_movable(spark, d):
    return layer(spark, d, "chart_bridges").select("bridge_id", A.is_movable(A.categories(F.col("catbrg")), F.col("vercop")).alias("movable"))


@query("""SELECT area_id, coalesce(list_contains(list_transform(regexp_extract_all(restrn, '[^,\\[\\]]+'), lambda x: TRY_CAST(x AS INT)), 1), FALSE)
  OR coalesce(lower(objnam) LIKE '%entry prohibited%' OR lower(objnam) LIKE '%entry is prohibited%' OR lower(objnam) LIKE '%verboden toegang%', FALSE) OR coalesce(lower(nobjnm) LIKE '%verboden toegang%', FALSE) AS prohibited FROM {restricted}""")
def entry_prohibited(spark, d):
    r = layer(spark, d, "restricted")
    codes = F.regexp_extract_all("restrn", F.lit(r"([^,\[\]]+)"), F.lit(1))
    return r.select("area_id", A.entry_prohibited(codes, F.col("objnam"), F.col("nobjnm"), F.col("inform")).alias("prohibited"))


@query("""WITH b AS (SELECT b.u, b.v, a.lon_e5/100000.0 AS x1, a.lat_e5/100000.0 AS y1, c.lon_e5/100000.0 AS x2, c.lat_e5/100000.0 AS y2 FROM {chart_edges} b JOIN {chart_nodes} a ON b.u = a.k JOIN {chart_nodes} c ON b.v = c.k)
  SELECT u, v, round(2*6371008.8*asin(sqrt(pow(sin(radians(y2-y1)/2),2)+cos(radians(y1))*cos(radians(y2))*pow(sin(radians(x2-x1)/2),2))), 2) AS metres FROM b""")
def edge_length_sphere(spark, d):
    e = ends(spark, d)
    return e.select("u", "v", F.round(G.haversine(*(F.col(c) / 100000.0 for c in ("x1", "y1", "x2", "y2"))), 2).alias("metres"))


@query("""WITH p AS (SELECT k, lon_e5 AS x, lat_e5 AS y FROM {chart_nodes}), r AS (SELECT k, land_id, pow(greatest(minx-x, x-maxx, 0), 2)+pow(greatest(miny-y, y-maxy, 0), 2) AS d2 FROM p CROSS JOIN {chart_land} l)
  SELECT k, CAST(min(d2) AS BIGINT) AS d2 FROM r WHERE d2 <= 4000000 GROUP BY k""")
def node_distance_to_land(spark, d):
    pairs = spatial.box_join(points(spark, d), layer(spark, d, "chart_land"), margin=2000, left_box=("x", "y", "x", "y"))
    gap = lambda lo, c, hi: F.greatest(F.col(f"r.{lo}") - F.col(f"l.{c}"), F.col(f"l.{c}") - F.col(f"r.{hi}"), F.lit(0))
    d2 = gap("minx", "x", "maxx") * gap("minx", "x", "maxx") + gap("miny", "y", "maxy") * gap("miny", "y", "maxy")
    return pairs.select(F.col("l.k").alias("k"), d2.alias("d2")).filter("d2 <= 4000000").groupBy("k").agg(F.min("d2").alias("d2"))


_CORNER = " ".join(f"least(pow(x1 + t{i}*(x2-x1) - {x}, 2) + pow(y1 + t{i}*(y2-y1) - {y}, 2)," for i, (x, y) in enumerate((x, y) for x in ("minx", "maxx") for y in ("miny", "maxy")))
_T = ", ".join(f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce((({x}-x1)*(x2-x1) + ({y}-y1)*(y2-y1)) / nullif((x2-x1)*(x2-x1) + (y2-y1)*(y2-y1), 0)::DOUBLE, 0))) AS t{i}" for i, (x, y) in enumerate((x, y) for x in ("minx", "maxx") for y in ("miny", "maxy")))
_END = "pow(greatest(minx-x{0}, x{0}-maxx, 0), 2) + pow(greatest(miny-y{0}, y{0}-maxy, 0), 2)"


@query(f"""WITH {_E}, t AS (SELECT *, {_T} FROM e CROSS JOIN {{chart_land}} l),
  r AS (SELECT u, v, min(CASE WHEN {_MEETS} THEN 0 ELSE {_CORNER} least({_END.format(1)}, {_END.format(2)}))))) END) AS d2 FROM t GROUP BY u, v)
  SELECT e.u, e.v, coalesce(round(sqrt(d2), 2), 9999.0::DOUBLE) AS distance_to_land FROM e LEFT JOIN r ON e.u = r.u AND e.v = r.v""")
def edge_distance_to_land(spark, d):
    return hazards.distance_to_land(ends(spark, d), layer(spark, d, "chart_land"))


_NODE_ID = "CASE WHEN node_type = 'inland' THEN 648000000000000 ELSE 0 END + CAST(floor((round(lat_e5/100000.0::DOUBLE, 5) + 90.0::DOUBLE)*100000) AS BIGINT)*36000000 + CAST(floor((round(lon_e5/100000.0::DOUBLE, 5) + 180.0::DOUBLE)*100000) AS BIGINT)"


def _ids(spark, d):
    return layer(spark, d, "chart_nodes").select("k", A.node_id(F.col("lon_e5") / 100000.0, F.col("lat_e5") / 100000.0, F.col("node_type") == "inland").alias("node_id"))


@query(f"SELECT k, {_NODE_ID} AS node_id FROM {{chart_nodes}}")
def node_ids(spark, d):
    return _ids(spark, d)


@query(f"WITH i AS (SELECT k, {_NODE_ID} AS node_id FROM {{chart_nodes}}) SELECT node_id, count(*) AS n FROM i GROUP BY node_id HAVING count(*) > 1")
def node_id_collisions(spark, d):
    return _ids(spark, d).groupBy("node_id").agg(F.count("*").alias("n")).filter("n > 1")


@query("SELECT s_suppkey, ('0x' || substr(md5('harbour_' || CAST(round(51.5 + s_suppkey/8.0::DOUBLE, 5) AS VARCHAR) || '_' || CAST(round(3.25 + s_suppkey/16.0::DOUBLE, 5) AS VARCHAR)), 1, 13))::BIGINT AS poi_id FROM supplier")
def poi_ids(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", A.poi_id(F.lit("harbour"), 51.5 + k / 8.0, 3.25 + k / 16.0).alias("poi_id"))


@query("""WITH m AS (SELECT lon_e5, lat_e5, node_type, 1 AS stage, k AS seq, 0 AS kind FROM {chart_nodes} WHERE node_type = 'inland' UNION ALL SELECT lon_e5, lat_e5, 'coastal', 2, k, 1 FROM {chart_nodes})
  SELECT lon_e5, lat_e5, arg_min(node_type, stage*1000000000 + seq) AS node_type, min(stage) AS stage, arg_max(kind, stage*1000000000 + seq) AS kind FROM m GROUP BY lon_e5, lat_e5""")
def node_dedup_precedence(spark, d):
    n = layer(spark, d, "chart_nodes")
    first = n.filter("node_type = 'inland'").select("lon_e5", "lat_e5", "node_type", F.lit(1).alias("stage"), F.col("k").alias("seq"), F.lit(0).alias("kind"))
    return graph.dedup_nodes(first.unionByName(n.select("lon_e5", "lat_e5", F.lit("coastal").alias("node_type"), F.lit(2).alias("stage"), F.col("k").alias("seq"), F.lit(1).alias("kind"))))


@query("""WITH s AS (SELECT o_custkey AS line_id, o_orderkey % 100 AS u, lead(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS v FROM orders)
  SELECT line_id, u, v FROM s WHERE v IS NOT NULL AND u <> v UNION ALL SELECT line_id, v, u FROM s WHERE v IS NOT NULL AND u <> v""")
def inland_segments(spark, d):
    o = table(spark, d, "orders")
    return graph.polyline_arcs(o.select(F.col("o_custkey").alias("line_id"), F.col("o_orderkey").alias("seq"), (F.col("o_orderkey") % 100).alias("node")))


_CORNERS = "c AS (SELECT band_id AS ring_id, 0 AS seq, minx AS x, miny AS y FROM {depth_bands} UNION ALL SELECT band_id, 1, maxx, miny FROM {depth_bands} UNION ALL SELECT band_id, 2, maxx, maxy FROM {depth_bands} UNION ALL SELECT band_id, 3, minx, maxy FROM {depth_bands})"


@query(f"WITH {_CORNERS} SELECT ring_id, seq, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM c WINDOW w AS (PARTITION BY ring_id ORDER BY seq)")
def ring_edges(spark, d):
    corner = lambda i, x, y: F.struct(F.lit(i).alias("seq"), F.col(x).alias("x"), F.col(y).alias("y"))
    b = layer(spark, d, "depth_bands").select(F.col("band_id").alias("ring_id"), F.explode(F.array(corner(0, "minx", "miny"), corner(1, "maxx", "miny"), corner(2, "maxx", "maxy"), corner(3, "minx", "maxy"))).alias("c"))
    return graph.ring_arcs(b.select("ring_id", "c.*"))


@query("""WITH RECURSIVE s AS (SELECT user_id AS chain_id, event_id AS seq, event_id % 47 AS length, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
  w AS (SELECT chain_id, seq, rn, CASE WHEN length >= 100 THEN 0 ELSE length END AS acc, 0 AS segment, CASE WHEN length >= 100 THEN 1 ELSE 0 END AS nxt FROM s WHERE rn = 1
  UNION ALL SELECT s.chain_id, s.seq, s.rn, CASE WHEN w.acc + s.length >= 100 THEN 0 ELSE w.acc + s.length END, w.nxt, CASE WHEN w.acc + s.length >= 100 THEN w.nxt + 1 ELSE w.nxt END FROM w JOIN s ON s.chain_id = w.chain_id AND s.rn = w.rn + 1)
  SELECT chain_id, seq, segment FROM w""")
def resample_chain(spark, d):
    e = table(spark, d, "events")
    return graph.resample(e.select(F.col("user_id").alias("chain_id"), F.col("event_id").alias("seq"), (F.col("event_id") % 47).cast("double").alias("length")), 100)


@query("""WITH RECURSIVE s AS (SELECT user_id AS line_id, event_id AS hit, (event_id * 7919) % 301 AS x, (event_id * 104729) % 199 AS y, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
  w AS (SELECT line_id, hit, rn, TRUE AS kept, [struct_pack(x := x, y := y)] AS held FROM s WHERE rn = 1
  UNION ALL SELECT s.line_id, s.hit, s.rn, len(list_filter(held, lambda h: (h.x-s.x)*(h.x-s.x) + (h.y-s.y)*(h.y-s.y) < 2500)) = 0,
    CASE WHEN len(list_filter(held, lambda h: (h.x-s.x)*(h.x-s.x) + (h.y-s.y)*(h.y-s.y) < 2500)) = 0 THEN list_append(held, struct_pack(x := s.x, y := s.y)) ELSE held END FROM w JOIN s ON s.line_id = w.line_id AND s.rn = w.rn + 1)
  SELECT line_id, hit FROM w WHERE kept""")
def near_duplicate_suppression(spark, d):
    e = table(spark, d, "events")
    return graph.thin(e.select(F.col("user_id").alias("line_id"), F.col("event_id").alias("hit"), F.expr("(event_id * 7919) % 301").alias("x"), F.expr("(event_id * 104729) % 199").alias("y")), 50, at="hit")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn <= 8")
def cap_per_group(spark, d):
    return graph.first_n(table(spark, d, "events").select("user_id", "event_id"), 8, "user_id", "event_id")


_P = "p AS (SELECT k, lon_e5 AS x, lat_e5 AS y, node_type FROM {chart_nodes})"
_D2 = "(a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)"


@query(f"""WITH {_P}, q AS (SELECT a.k, b.k AS near, {_D2} AS d2, CASE WHEN b.x >= a.x THEN CASE WHEN b.y >= a.y THEN 0 ELSE 3 END ELSE CASE WHEN b.y >= a.y THEN 1 ELSE 2 END END AS quadrant FROM p a JOIN p b ON a.k <> b.k AND abs(a.x-b.x) <= 1500 AND abs(a.y-b.y) <= 1500 AND {_D2} <= 2250000),
  r AS (SELECT *, row_number() OVER (PARTITION BY k, quadrant ORDER BY d2, near) AS rn FROM q) SELECT k, quadrant, near, d2 FROM r WHERE rn = 1""")
def quadrant_nearest(spark, d):
    p = points(spark, d)
    return graph.quadrant_nearest(spatial.radius_join(p, p, 1500))


@query(f"WITH {_P}, r AS (SELECT a.k, b.k AS near, {_D2} AS d2, row_number() OVER (PARTITION BY a.k ORDER BY {_D2}, b.k) AS rank FROM p a JOIN p b ON a.k <> b.k) SELECT k, near, d2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5")
def knn_nodes(spark, d):
    p = points(spark, d)
    return spatial.knn_join(p, p, 5, exclude=F.col("l.k") == F.col("r.k")).select(F.col("l.k").alias("k"), F.col("r.k").alias("near"), "d2", "rank")


@query(f"WITH {_P}, r AS (SELECT a.k, b.k AS near, {_D2} AS d2, row_number() OVER (PARTITION BY a.k ORDER BY {_D2}, b.k) AS rank FROM p a JOIN p b ON a.node_type = 'inland' AND b.node_type = 'coastal') SELECT k, near, d2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3")
def knn_cross_type(spark, d):
    p = points(spark, d)
    return spatial.knn_join(p.filter("node_type = 'inland'"), p.filter("node_type = 'coastal'"), 3).select(F.col("l.k").alias("k"), F.col("r.k").alias("near"), "d2", "rank")


@query(f"WITH {_P} SELECT a.k AS a, b.k AS b, {_D2} AS d2 FROM p a JOIN p b ON a.k < b.k AND abs(a.x-b.x) <= 1100 AND abs(a.y-b.y) <= 1100 AND {_D2} <= 1210000")
def radius_pairs(spark, d):
    p = points(spark, d)
    return spatial.radius_join(p, p, 1100).filter("l.k < r.k").select(F.col("l.k").alias("a"), F.col("r.k").alias("b"), "d2")


@query("""WITH q AS (SELECT a.vec_id AS q, b.vec_id AS near, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6), b.vec_id) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0)
  SELECT q, near, CAST(rank AS INT) AS rank FROM q WHERE rank <= 5""")
def knn_embeddings(spark, d):
    """The queries are the rows whose id is divisible by 100; blocks of them meet chunks of all rows in matrix form."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding").filter("vec_id is not null and embedding is not null")
    return nearest_vectors(e.filter("vec_id % 100 = 0"), e, 5)


def nearest_vectors(asked: DataFrame, rows: DataFrame, k: int, block: int = 512, chunk: int = 2048) -> DataFrame:
    """q, near, rank of the k nearest rows(vec_id, embedding) of each row of asked, itself left out, ties by id.

    Blocks and chunks hold about block and chunk rows whatever the input's size; each pair of them gives k rows a query.
    """

    def dealt(df: DataFrame, size: int, name: str) -> DataFrame:
        n = max(1, -(-df.count() // size))
        return df.groupBy(F.expr(f"pmod(xxhash64(vec_id), {n})").alias(f"{name}_at")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias(name)).drop(f"{name}_at")

    def run(frames):
        for f in frames:
            for qs, own in zip(f["qs"], f["own"], strict=True):
                y, x = (np.array([r["embedding"] for r in side], float) for side in (qs, own))
                ids, near = (np.array([r["vec_id"] for r in side]) for side in (qs, own))
                dist = np.sqrt(np.stack([((x - one) ** 2).sum(1) for one in y]))
                dist[ids[:, None] == near[None, :]] = np.inf
                order = np.argsort(near, kind="stable")
                top = order[np.argsort(np.round(dist[:, order], 6), axis=1, kind="stable")[:, :k]]
                yield pd.DataFrame({"q": np.repeat(ids, top.shape[1]), "near": near[top].ravel(), "dist": np.take_along_axis(dist, top, 1).ravel()})

    pairs = dealt(rows, chunk, "own").crossJoin(dealt(asked, block, "qs"))  # blocks of a stated query set against all rows
    best = pairs.mapInPandas(run, "q long, near long, dist double").filter("dist < double('infinity')")
    w = Window.partitionBy("q").orderBy(F.round("dist", 6), "near")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("q", "near", "rank")


_CC = """WITH RECURSIVE s AS (SELECT u, v FROM {chart_edges} UNION ALL SELECT v, u FROM {chart_edges}), r AS (SELECT k, k AS c FROM {chart_nodes} UNION SELECT s.v, r.c FROM r JOIN s ON s.u = r.k AND r.c < s.v), comp AS (SELECT k, min(c) AS component FROM r GROUP BY k) """
_WALK = """p AS (SELECT k, lon_e5 AS x, lat_e5 AS y, node_type FROM {chart_nodes}), near AS (SELECT a.k AS a, b.k AS b, a.node_type AS s, b.node_type AS t, (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) AS d2 FROM p a JOIN p b ON a.k <> b.k AND abs(a.x-b.x) <= 1500 AND abs(a.y-b.y) <= 1500)"""


@query("WITH RECURSIVE " + _WALK + """, x AS (SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v FROM {chart_edges} g JOIN p a ON u = a.k JOIN p b ON v = b.k WHERE a.node_type <> b.node_type),
  c AS (SELECT a, b, d2, row_number() OVER (ORDER BY d2, a, b) AS rn FROM near WHERE s = 'inland' AND t = 'coastal' AND d2 <= 2250000 AND NOT EXISTS (SELECT 1 FROM x WHERE x.u = least(a, b) AND x.v = greatest(a, b))),
  w AS (SELECT 0::BIGINT AS rn, FALSE AS taken, list(n ORDER BY k) AS used FROM (SELECT k, (SELECT count(*) FROM x WHERE x.u = p.k OR x.v = p.k) AS n FROM p)
  UNION ALL SELECT c.rn, used[a + 1] < 2 AND used[b + 1] < 2, CASE WHEN used[a + 1] < 2 AND used[b + 1] < 2 THEN list_transform(used, lambda n, i: CASE WHEN i = a + 1 OR i = b + 1 THEN n + 1 ELSE n END) ELSE used END FROM w JOIN c ON c.rn = w.rn + 1)
  SELECT a, b, d2 FROM w JOIN c ON w.rn = c.rn WHERE taken""")
def capped_connectors(spark, d):
    """Links from inland to coastal nodes, nearest first, at most two a node with those that the chart has."""
    p, e = points(spark, d), layer(spark, d, "chart_edges")
    pairs = spatial.radius_join(p.filter("node_type = 'inland'"), p.filter("node_type = 'coastal'"), 1500)
    kind = p.select("k", "node_type")
    both = e.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    cross = both.join(kind.toDF("u", "s"), "u").join(kind.toDF("v", "t"), "v").filter("s <> t").select("u", "v")
    return graph.capped_connectors(pairs.select(F.col("l.k").alias("a"), F.col("r.k").alias("b"), "d2"), cross, 2)


@query(_CC.rstrip() + ", " + _WALK + """,
  c AS (SELECT a, b, d2, row_number() OVER (ORDER BY d2, a, b) AS rn FROM near JOIN comp f ON a = f.k JOIN comp g ON b = g.k WHERE a < b AND d2 <= 2250000 AND f.component <> g.component),
  w AS (SELECT 0::BIGINT AS rn, FALSE AS taken, list(component ORDER BY k) AS up FROM comp
  UNION ALL SELECT c.rn, up[a + 1] <> up[b + 1], CASE WHEN up[a + 1] <> up[b + 1] THEN list_transform(up, lambda n: CASE WHEN n = greatest(up[a + 1], up[b + 1]) THEN least(up[a + 1], up[b + 1]) ELSE n END) ELSE up END FROM w JOIN c ON c.rn = w.rn + 1)
  SELECT a, b, d2 FROM w JOIN c ON w.rn = c.rn WHERE taken""")
def stitch_components(spark, d):
    """Links that join separate pieces of the chart, nearest first."""
    p = points(spark, d)
    pairs = spatial.radius_join(p, p, 1500).filter("l.k < r.k")
    return graph.stitch(pairs.select(F.col("l.k").alias("a"), F.col("r.k").alias("b"), "d2"), _components(spark, d))


def _components(spark, d):
    return components.connected_components(layer(spark, d, "chart_edges"), layer(spark, d, "chart_nodes"))


@query(_CC + "SELECT k, component FROM comp")
def connected_components(spark, d):
    return _components(spark, d)


@query(_CC + "SELECT component, count(*) AS n FROM comp GROUP BY component")
def component_sizes(spark, d):
    return _components(spark, d).groupBy("component").agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT u AS k FROM {chart_edges} UNION ALL SELECT v FROM {chart_edges}) SELECT k FROM s GROUP BY k HAVING count(*) = 1")
def dead_end_nodes(spark, d):
    return graph.dead_ends(layer(spark, d, "chart_edges"))


@query("""WITH s AS (SELECT u AS k FROM {chart_edges} UNION ALL SELECT v FROM {chart_edges}), x AS (SELECT k FROM s GROUP BY k HAVING count(*) = 1)
  SELECT u, v, (u * 31 + v) % 100 AS length FROM {chart_edges} WHERE NOT ((u * 31 + v) % 100 < 60 AND (u IN (SELECT k FROM x) OR v IN (SELECT k FROM x)))""")
def prune_spurs_round(spark, d):
    return graph.prune_spurs_once(layer(spark, d, "chart_edges").withColumn("length", F.expr("(u * 31 + v) % 100")), 60)


def _spur_rounds(n: int) -> str:
    """SQL of n rounds; more change nothing once a round has changed nothing."""
    out = ["e0 AS (SELECT u, v, (u * 31 + v) % 100 AS length FROM {chart_edges})"]
    for i in range(n):
        out.append(f"p{i} AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM e{i} WHERE u <> v), x{i} AS (SELECT k FROM (SELECT a AS k FROM p{i} UNION ALL SELECT b FROM p{i}) GROUP BY k HAVING count(*) = 1)")
        out.append(f"e{i + 1} AS MATERIALIZED (SELECT * FROM e{i} WHERE NOT (length < 60 AND (u IN (SELECT k FROM x{i}) OR v IN (SELECT k FROM x{i}))))")
    return f"WITH {', '.join(out)} SELECT u, v, length FROM e{n}"


@query(_spur_rounds(16))
def prune_spurs(spark, d):
    return graph.prune_spurs(layer(spark, d, "chart_edges").withColumn("length", F.expr("(u * 31 + v) % 100")), 60)


@query(f"WITH {_E}, h AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM e JOIN {{chart_land}} l ON {_MEETS}) SELECT u, v FROM e WHERE NOT EXISTS (SELECT 1 FROM h WHERE a = least(u, v) AND b = greatest(u, v))")
def strip_land_crossing_edges(spark, d):
    return hazards.strip_crossing(ends(spark, d), layer(spark, d, "chart_land"))


_OVER = "a.minx <= b.maxx AND a.maxx >= b.minx AND a.miny <= b.maxy AND a.maxy >= b.miny"


@query(f"""SELECT band_id, CASE WHEN least(maxx-minx, maxy-miny) >= 2000 AND EXISTS (SELECT 1 FROM {{depth_bands}} b WHERE drval1 >= 6 AND {_OVER}) THEN 'navmesh'
  WHEN EXISTS (SELECT 1 FROM {{chart_fairways}} b WHERE {_OVER}) THEN 'laned' ELSE 'skeleton' END AS kind FROM {{depth_bands}} a""")
def classify_water(spark, d):
    b = layer(spark, d, "depth_bands")
    return hazards.classify_water(b, b, layer(spark, d, "chart_fairways"))


@query("""SELECT band_id, cx, cy FROM (SELECT *, unnest(range(minx // 1000, maxx // 1000 + 1)) AS cx FROM {depth_bands}) CROSS JOIN LATERAL (SELECT unnest(range(miny // 1000, maxy // 1000 + 1)) AS cy)""")
def tile_cells(spark, d):
    b = layer(spark, d, "depth_bands")
    return b.select("band_id", F.expr("explode(sequence(minx div 1000, maxx div 1000))").alias("cx"), "miny", "maxy").select("band_id", "cx", F.expr("explode(sequence(miny div 1000, maxy div 1000))").alias("cy"))


BOX = (325000, 5121000, 345000, 5139000)


@query("SELECT node_id, lon_e5, lat_e5, coalesce(node_depth, -999) AS node_depth, source_region FROM {registry_rows} r WHERE batch = 2 AND lon_e5 BETWEEN 325000 AND 345000 AND lat_e5 BETWEEN 5121000 AND 5139000 AND NOT EXISTS (SELECT 1 FROM {chart_nodes} n WHERE n.k = r.node_id AND n.node_type = 'inland')")
def seam_adopt(spark, d):
    own = layer(spark, d, "registry_rows").filter("batch = 2").drop("batch")
    return seams.adopt(own, layer(spark, d, "chart_nodes").filter("node_type = 'inland'"), BOX)


@query("""WITH p AS (SELECT k, lon_e5 AS x, lat_e5 AS y FROM {chart_nodes} WHERE node_type = 'coastal'), a AS (SELECT lon_e5 AS x, lat_e5 AS y FROM {chart_nodes} WHERE k % 9 = 0)
  SELECT k, x, y FROM p WHERE least(abs(x-325000), abs(x-345000), abs(y-5121000), abs(y-5139000)) <= 1500 AND x BETWEEN 323500 AND 346500 AND y BETWEEN 5119500 AND 5140500
  AND NOT EXISTS (SELECT 1 FROM a WHERE (a.x-p.x)*(a.x-p.x)+(a.y-p.y)*(a.y-p.y) <= 640000)""")
def seam_publish(spark, d):
    p = points(spark, d)
    return seams.publish(p, p.filter("k % 9 = 0"), BOX, 1500, 800).select("k", "x", "y")


@query("SELECT node_id, lon_e5, lat_e5, node_depth, source_region FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY batch DESC) AS rn FROM {registry_rows}) WHERE rn = 1")
def registry_upsert(spark, d):
    r = layer(spark, d, "registry_rows")
    return seams.upsert(r.filter("batch = 1"), r.filter("batch = 2"), "node_id").drop("batch")


@query("SELECT node_id, lon_e5, lat_e5, node_depth, source_region FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY batch) AS rn FROM {registry_rows}) WHERE rn = 1")
def registry_insert_ignore(spark, d):
    r = layer(spark, d, "registry_rows")
    return seams.insert_ignore(r.filter("batch = 1"), r.filter("batch = 2"), "node_id", "batch").drop("batch")


@query("""WITH p AS (SELECT bridge_id AS poi, CASE WHEN bridge_id % 3 = 0 THEN 'bridge' ELSE 'harbour' END AS kind, minx AS x, miny AS y FROM {chart_bridges}),
  n AS (SELECT p.*, k, lon_e5 AS nx, lat_e5 AS ny, (x-lon_e5)*(x-lon_e5)+(y-lat_e5)*(y-lat_e5) AS d2 FROM p JOIN {chart_nodes} ON abs(x-lon_e5) <= 600 AND abs(y-lat_e5) <= 600),
  b AS (SELECT *, row_number() OVER (PARTITION BY poi ORDER BY d2, k) AS rn FROM n WHERE d2 <= 360000)
  SELECT p.poi, p.kind, b.k AS node, b.d2, coalesce(p.kind = 'bridge' AND b.d2 > 62500, FALSE) AS moved, CASE WHEN p.kind = 'bridge' AND b.d2 > 62500 THEN b.nx ELSE p.x END AS x, CASE WHEN p.kind = 'bridge' AND b.d2 > 62500 THEN b.ny ELSE p.y END AS y
  FROM p LEFT JOIN b ON p.poi = b.poi AND rn = 1""")
def poi_nearest_snap(spark, d):
    p = layer(spark, d, "chart_bridges").select(F.col("bridge_id").alias("poi"), F.expr("if(bridge_id % 3 = 0, 'bridge', 'harbour')").alias("kind"), F.col("minx").alias("x"), F.col("miny").alias("y"))
    return seams.snap_pois(p, points(spark, d), 600, 250, ("bridge",))


@query("SELECT min(lon_e5) AS minx, min(lat_e5) AS miny, max(lon_e5) AS maxx, max(lat_e5) AS maxy FROM {chart_nodes}")
def coverage_bbox(spark, d):
    return seams.coverage(layer(spark, d, "chart_nodes"), "lon_e5", "lat_e5")


@query("""WITH RECURSIVE p AS (SELECT DISTINCT lon_e5 AS x, lat_e5 AS y FROM {chart_nodes}), f AS (SELECT min(struct_pack(x := x, y := y)) AS c FROM p),
  h AS (SELECT c, c AS first_one, 0 AS n FROM f
  UNION ALL SELECT (SELECT first(struct_pack(x := q.x, y := q.y) ORDER BY (q.x-h.c.x)**2 + (q.y-h.c.y)**2 DESC) FROM p q WHERE NOT (q.x = h.c.x AND q.y = h.c.y)
    AND NOT EXISTS (SELECT 1 FROM p r WHERE (q.x - h.c.x) * (r.y - h.c.y) - (q.y - h.c.y) * (r.x - h.c.x) < 0)), first_one, n + 1 FROM h WHERE n = 0 OR c <> first_one)
  SELECT DISTINCT c.x::DOUBLE AS x, c.y::DOUBLE AS y FROM h""")
def convex_hull(spark, d):
    """Corners of all nodes' hull: hulls of partitions first, then the hull of their few corners."""
    def hull(frames):
        pts = np.empty((0, 2))
        for f in frames:
            pts = R.convex_hull(np.vstack([pts, f[["x", "y"]].to_numpy(float)]))
        yield pd.DataFrame(pts, columns=["x", "y"])

    return points(spark, d).select("x", "y").mapInPandas(hull, "x double, y double").repartition(1).mapInPandas(hull, "x double, y double")


@query("SELECT n_name AS state FROM nation WHERE n_nationkey % 4 = 0")
def manifest_todo(spark, d):
    n = table(spark, d, "nation")
    done = n.filter("n_nationkey % 4 <> 0").select(F.col("n_name").alias("state"))
    return n.select(F.col("n_name").alias("state")).join(done, "state", "left_anti")


@query("SELECT p_partkey, CAST(nullif(regexp_extract(f, '^[A-Za-z]{{2}}([1-6])', 1), '') AS INT) AS band FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 9 THEN 'foo.000' ELSE 'US' || CAST(p_partkey % 8 AS VARCHAR) || 'NY1A.000' END AS f FROM part) WHERE coalesce(CAST(nullif(regexp_extract(f, '^[A-Za-z]{{2}}([1-6])', 1), '') AS INT) NOT IN (1, 2), TRUE)")
def scale_band_prune(spark, d):
    name = F.expr("if(p_partkey % 10 = 9, 'foo.000', concat('US', p_partkey % 8, 'NY1A.000'))")
    return table(spark, d, "part").select("p_partkey", A.usage_band(name).alias("band")).filter(F.coalesce(~F.col("band").isin(1, 2), F.lit(True)))


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer")
def layer_union_schema_evolution(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT CASE WHEN o_totalprice IS NULL THEN 'missing' WHEN o_orderstatus <> 'F' THEN 'open' WHEN o_totalprice > 200000 THEN 'large' ELSE 'kept' END AS reason, count(*) AS n FROM orders GROUP BY 1")
def reject_reason_histogram(spark, d):
    r = F.when(F.col("o_totalprice").isNull(), "missing").when(F.col("o_orderstatus") != "F", "open").when(F.col("o_totalprice") > 200000, "large").otherwise("kept")
    return seams.reject_reasons(table(spark, d, "orders"), r)


@query("SELECT event_type, count(*) AS read, count(*) FILTER (WHERE user_id % 3 = 0) AS connected, count(*) FILTER (WHERE user_id % 3 <> 0) AS unconnected FROM events GROUP BY event_type")
def poi_stats(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("read"), F.count_if(F.expr("user_id % 3 = 0")).alias("connected"), F.count_if(F.expr("user_id % 3 <> 0")).alias("unconnected"))


_PX = "px AS (SELECT DISTINCT p_partkey % 50 AS x, p_partkey * 7 % 43 AS y FROM part WHERE p_size > 20)"


@query(f"WITH {_PX} SELECT a.x, a.y, count(b.x) AS degree FROM px a LEFT JOIN px b ON abs(a.x-b.x) <= 1 AND abs(a.y-b.y) <= 1 AND NOT (a.x = b.x AND a.y = b.y) GROUP BY a.x, a.y")
def skeleton_pixels_degree(spark, d):
    px = table(spark, d, "part").filter("p_size > 20").select((F.col("p_partkey") % 50).alias("x"), (F.col("p_partkey") * 7 % 43).alias("y")).distinct()
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))
    near = px.select("x", "y", F.explode(steps).alias("s")).select((F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y")).groupBy("x", "y").agg(F.count("*").alias("degree"))
    return px.join(near, ["x", "y"], "left").select("x", "y", F.coalesce("degree", F.lit(0)).alias("degree"))


@query(f"""WITH {_PX}, box AS (SELECT unnest(range(-1, 51)) AS x), boy AS (SELECT unnest(range(-1, 44)) AS y), free AS (SELECT x, y FROM box CROSS JOIN boy EXCEPT SELECT x, y FROM px)
  SELECT a.x, a.y, min((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) AS d2 FROM px a CROSS JOIN free b GROUP BY a.x, a.y""")
def raster_distance_transform(spark, d):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((50, 43), bool)
        mask[f["x"], f["y"]] = True
        return pd.DataFrame({"x": f["x"], "y": f["y"], "d2": R.distance2(mask)[f["x"], f["y"]]})

    px = table(spark, d, "part").filter("p_size > 20").select((F.col("p_partkey") % 50).alias("x"), (F.col("p_partkey") * 7 % 43).alias("y")).distinct()
    return px.groupBy(F.lit(1).alias("piece")).applyInPandas(run, "x long, y long, d2 long")


@query()
def navmesh_triangulate(spark, d):
    """Triangles and their neighbours over the nodes of each tile."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("k", ignore_index=True).drop_duplicates(["x", "y"], ignore_index=True)
        t = R.triangulate(f[["x", "y"]].to_numpy()) if len(f) >= 3 else np.empty((0, 3), int)
        k, n = f["k"].to_numpy(), R.neighbours(t)
        return pd.DataFrame({"cx": f["cx"].iloc[0], "cy": f["cy"].iloc[0], "triangle": range(len(t)), "corners": [k[x].tolist() for x in t], "across": n.tolist()})

    p = points(spark, d).select(F.expr("x div 10000").alias("cx"), F.expr("y div 10000").alias("cy"), "k", "x", "y")
    return p.groupBy("cx", "cy").applyInPandas(run, "cx long, cy long, triangle long, corners array<long>, across array<int>")


SHORTEST_SPUR, LONGEST_SEGMENT = 60.0, 100.0


@query()
def skeleton_network(spark, d):
    """Segments of the skeleton of each band without the land it meets, with the water's width along them."""
    return skeletons(layer(spark, d, "depth_bands"), layer(spark, d, "chart_land"))


_SEGMENT = {"band_id": np.int64, "chain": np.int64, "segment": np.int64, "pixels": np.int64, "length": float, "min_width": float}


def raster_segments(frames, size: float | None, shortest: float, longest: float):
    """Frames of segments for frames of (band_id, box, land); a raster equal to the last one is not computed again."""
    def segments(mask, px):
        width = 2 * px * np.sqrt(R.distance2(mask))
        found = R.prune(R.chains(R.medial_axis(mask)), px, shortest)
        out = [(i, j, len(part), R.chain_length(part, px), float(min(width[p] for p in part))) for i, chain in enumerate(found) for j, part in enumerate(R.resample(chain, px, longest))]
        return pd.DataFrame(out, columns=[*_SEGMENT][1:]).astype({c: t for c, t in _SEGMENT.items() if c != "band_id"})

    last, held = None, None
    for f in frames:
        out, rows = [], 0
        for band, box, lands in zip(f["band_id"], f[[*spatial.BOX]].to_numpy(), f["land"], strict=True):
            px = size or R.pixel_size(box[2] - box[0], box[3] - box[1])
            mask = R.water(tuple(box), [] if lands is None else [tuple(x[n] for n in spatial.BOX) for x in lands], px)
            this = px, mask.shape, np.packbits(mask).tobytes()
            if this != last:
                last, held = this, segments(mask, px)
            out.append(held.assign(band_id=band))
            rows += len(held)
            if rows > 50_000:
                yield pd.concat(out)[[*_SEGMENT]]
                out, rows = [], 0
        if out:
            yield pd.concat(out)[[*_SEGMENT]]


def skeletons(bands: DataFrame, land: DataFrame, size: float | None = None, shortest: float = SHORTEST_SPUR, longest: float = LONGEST_SEGMENT) -> DataFrame:
    """Of each of bands(band_id, box): chains of its raster's skeleton, pruned and cut into segments of about longest.

    Pixels are as R.pixel_size says, or of the given size. Bands of one form, box and land alike wherever they lie,
    meet in four tasks at most, one after the other, so that their raster is thinned once a task.
    """
    bands = bands.select("band_id", *spatial.BOX)
    met = spatial.box_join(bands, land.select(*spatial.BOX)).groupBy(F.col("l.band_id").alias("band_id")).agg(F.collect_list("r").alias("land"))
    there = F.transform(F.array_sort("land"), lambda x: F.array(*(x[n] - F.col(o) for n, o in zip(spatial.BOX, spatial.BOX[:2] * 2, strict=True))))
    dealt = bands.join(met, "band_id", "left").withColumn("form", F.xxhash64(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"), there))
    dealt = dealt.repartition("form", F.pmod(F.xxhash64("band_id"), F.lit(4))).sortWithinPartitions("form")
    run = lambda frames: raster_segments(frames, size, shortest, longest)
    return dealt.mapInPandas(run, "band_id long, chain long, segment long, pixels long, length double, min_width double")


# Not operators of the chart engine, but of Spark: they come with the same entry points.


@query("SELECT o_custkey, o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS dr, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)")
def extra_window_ranks(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("dr"), F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("before"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def extra_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def extra_set_difference(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).exceptAll(table(spark, d, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k")).distinct()).distinct()


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def extra_hourly_events(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"))


_CLIP = """m AS (SELECT *, greatest(0, least((minx-x1)/nullif(x2-x1, 0)::DOUBLE, (maxx-x1)/nullif(x2-x1, 0)::DOUBLE), least((miny-y1)/nullif(y2-y1, 0)::DOUBLE, (maxy-y1)/nullif(y2-y1, 0)::DOUBLE)) AS t0,
    least(1, greatest((minx-x1)/nullif(x2-x1, 0)::DOUBLE, (maxx-x1)/nullif(x2-x1, 0)::DOUBLE), greatest((miny-y1)/nullif(y2-y1, 0)::DOUBLE, (maxy-y1)/nullif(y2-y1, 0)::DOUBLE)) AS t1
    FROM e JOIN {%s} ON """ + _MEETS + """),
  c AS (SELECT *, x1 + t0*(x2-x1) AS ax, y1 + t0*(y2-y1) AS ay, x1 + t1*(x2-x1) AS bx, y1 + t1*(y2-y1) AS b_y FROM m WHERE t0 <= t1)"""


@query(f"""WITH {_E}, {_CLIP % "chart_bridges"}
  SELECT bridge_id, u AS line, round(coalesce(sum(n*(ax+bx)/2)/nullif(sum(n), 0), avg((ax+bx)/2)), 2) AS x, round(coalesce(sum(n*(ay+b_y)/2)/nullif(sum(n), 0), avg((ay+b_y)/2)), 2) AS y
  FROM (SELECT *, sqrt((bx-ax)**2 + (b_y-ay)**2) AS n FROM c) GROUP BY bridge_id, u""")
def bridge_crossing_points(spark, d):
    out = crossings.bridge_crossings(ends(spark, d), layer(spark, d, "chart_bridges"))
    return out.select("bridge_id", "line", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query(f"""WITH {_E}, {_CLIP % "chart_locks"},
  p AS (SELECT lock_id, u, round(ax, 6) AS x, round(ay, 6) AS y FROM c WHERE t0 > 0 OR x1 IN (minx, maxx) OR y1 IN (miny, maxy) UNION SELECT lock_id, u, round(bx, 6), round(b_y, 6) FROM c WHERE t1 < 1 OR x2 IN (minx, maxx) OR y2 IN (miny, maxy))
  SELECT a.lock_id, a.u AS line, round(max(sqrt((b.x-a.x)**2 + (b.y-a.y)**2)), 2) AS span FROM p a JOIN p b ON a.lock_id = b.lock_id AND a.u = b.u AND (a.x < b.x OR a.x = b.x AND a.y < b.y) GROUP BY a.lock_id, a.u""")
def lock_gate_pairs(spark, d):
    out = crossings.lock_gates(ends(spark, d), layer(spark, d, "chart_locks"))
    return out.select("lock_id", "line", F.round("span", 2).alias("span"))


from . import shape_queries as _shape_queries  # noqa: E402, F401  registers its queries
