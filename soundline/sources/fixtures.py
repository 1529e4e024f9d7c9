"""Chart layers derived from the star tables, as SQL that Spark and a second engine read alike.

Coordinates are whole numbers of 1e-5 degree and rectangles have whole corners, so predicates are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RECT = "minx + 300 + 60 * {w} AS maxx, miny + 300 + 60 * {h} AS maxy"

SQL = {
    "chart_nodes": """
        SELECT CAST(c_custkey AS BIGINT) AS k, CAST(320000 + (c_custkey % 40) * 1000 + (c_custkey * 7919 % 401) AS BIGINT) AS lon_e5,
          CAST(5120000 + CAST(floor(c_custkey / 40.0) AS BIGINT) * 1000 + (c_custkey * 104729 % 401) AS BIGINT) AS lat_e5,
          CASE WHEN c_nationkey % 5 = 0 THEN 'inland' ELSE 'coastal' END AS node_type
        FROM {customer}""",
    "chart_edges": """
        SELECT DISTINCT o.u, o.v FROM (
          SELECT CAST(o_custkey AS BIGINT) AS u, CAST(o_custkey + CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 40 ELSE 41 END AS BIGINT) AS v
          FROM {orders} WHERE o_orderkey % 11 = 0) o
        JOIN {customer} c ON o.v = c.c_custkey""",
    "depth_bands": f"""
        SELECT band_id, minx, miny, {_RECT.format(w="size", h="size")}, drval1, drval2 FROM (
          SELECT CAST(p_partkey AS BIGINT) AS band_id, CAST(319500 + (7 * p_partkey % 40) * 1000 AS BIGINT) AS minx,
            CAST(5119500 + CAST(floor(p_partkey / 53.0) AS BIGINT) * 1000 AS BIGINT) AS miny, CAST(p_size AS BIGINT) AS size,
            CAST(CASE p_partkey % 10 WHEN 0 THEN -50 WHEN 1 THEN -2 WHEN 4 THEN 2 WHEN 5 THEN 5 WHEN 6 THEN 10 WHEN 7 THEN 20 WHEN 8 THEN NULL ELSE 0 END AS DOUBLE) AS drval1,
            CAST(CASE p_partkey % 10 WHEN 0 THEN -4 WHEN 1 THEN 0 WHEN 2 THEN 2 WHEN 4 THEN 5 WHEN 5 THEN 10 WHEN 6 THEN 20 WHEN 7 THEN 30 WHEN 8 THEN NULL ELSE 18.2 END AS DOUBLE) AS drval2
          FROM {{part}}) p""",
    "chart_bridges": f"""
        SELECT bridge_id, minx, miny, {_RECT.format(w="(bridge_id % 9)", h="(bridge_id % 7)")}, catbrg, vercop, verclr FROM (
          SELECT CAST(s_suppkey AS BIGINT) AS bridge_id, CAST(319700 + (11 * s_suppkey % 40) * 1000 AS BIGINT) AS minx,
            CAST(5119700 + CAST(floor(s_suppkey / 4.0) AS BIGINT) * 1000 AS BIGINT) AS miny,
            CASE WHEN s_suppkey % 6 = 0 THEN '(1:' || CAST(s_nationkey % 9 AS VARCHAR(9)) || ')' ELSE CAST(s_nationkey % 9 AS VARCHAR(9)) END AS catbrg,
            CASE WHEN s_suppkey % 13 = 0 THEN CAST(12 AS DOUBLE) END AS vercop,
            CAST(CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 4 + s_suppkey % 20 END AS DOUBLE) AS verclr
          FROM {{supplier}}) s""",
    "chart_locks": f"""
        SELECT lock_id, minx, miny, {_RECT.format(w="10", h="10")}, horclr, name FROM (
          SELECT CAST(s_suppkey AS BIGINT) + 1 AS lock_id, CAST(319900 + (3 * s_suppkey % 40) * 1000 AS BIGINT) AS minx,
            CAST(5119900 + CAST(floor(s_suppkey / 4.0) AS BIGINT) * 1000 AS BIGINT) AS miny, CAST(6 + s_suppkey % 18 AS DOUBLE) AS horclr,
            CASE WHEN s_suppkey % 10 = 5 THEN '  ' ELSE s_name END AS name
          FROM {{supplier}} WHERE s_suppkey % 5 = 0) s""",
    "chart_fairways": f"""
        SELECT fairway_id, minx, miny, {_RECT.format(w="80", h="5")}, trafic FROM (
          SELECT CAST(n_nationkey AS BIGINT) AS fairway_id, CAST(319800 + (5 * n_nationkey % 40) * 1000 AS BIGINT) AS minx,
            CAST(5119800 + n_nationkey * 1500 AS BIGINT) AS miny,
            CASE n_nationkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN -1 END AS trafic
          FROM {{nation}}) n""",
    "chart_obstructions": """
        SELECT CAST(p_partkey AS BIGINT) AS obstr_id, CAST(320000 + (13 * p_partkey % 40) * 1000 + p_partkey % 300 AS BIGINT) AS x,
          CAST(5120000 + CAST(floor(p_partkey / 53.0) AS BIGINT) * 1000 + p_partkey % 211 AS BIGINT) AS y,
          CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 5 AS VARCHAR(9)) WHEN p_partkey % 7 = 0 THEN 'x' END AS valsou,
          CASE WHEN p_partkey % 8 > 0 THEN CAST(p_partkey % 8 AS INT) END AS watlev
        FROM {part} WHERE p_size <= 10""",
    "chart_land": """
        SELECT CAST(p_partkey AS BIGINT) AS land_id, CAST(319300 + (17 * p_partkey % 40) * 1000 AS BIGINT) AS minx, CAST(5119300 + CAST(floor(p_partkey / 53.0) AS BIGINT) * 1000 AS BIGINT) AS miny,
          CAST(319300 + (17 * p_partkey % 40) * 1000 + 350 AS BIGINT) AS maxx, CAST(5119300 + CAST(floor(p_partkey / 53.0) AS BIGINT) * 1000 + 350 AS BIGINT) AS maxy
        FROM {part} WHERE p_partkey % 4 = 1""",
    "registry_rows": """
        SELECT CAST(c_custkey AS BIGINT) AS node_id, b.batch, CAST(320000 + (c_custkey % 40) * 1000 + (c_custkey * 7919 % 401) AS BIGINT) AS lon_e5,
          CAST(5120000 + CAST(floor(c_custkey / 40.0) AS BIGINT) * 1000 + (c_custkey * 104729 % 401) AS BIGINT) AS lat_e5,
          CAST(CASE WHEN b.batch = 1 THEN c_custkey % 12 ELSE c_custkey % 7 END AS DOUBLE) AS node_depth, CASE WHEN b.batch = 1 THEN 'north' ELSE 'south' END AS source_region
        FROM {customer} c CROSS JOIN (SELECT 1 AS batch UNION ALL SELECT 2 AS batch) b
        WHERE (b.batch = 1 AND c_custkey % 3 = 0) OR (b.batch = 2 AND c_custkey % 5 = 0)""",
    "restricted": """
        SELECT CAST(p_partkey AS BIGINT) AS area_id, CASE p_partkey % 5 WHEN 0 THEN '[1]' WHEN 1 THEN '7,1' WHEN 2 THEN 'abc' WHEN 3 THEN '14' END AS restrn,
          CASE WHEN p_partkey % 11 = 0 THEN 'Entry PROHIBITED here' ELSE p_name END AS objnam,
          CASE WHEN p_partkey % 13 = 0 THEN 'Verboden Toegang' END AS nobjnm, CAST(NULL AS VARCHAR(9)) AS inform
        FROM {part}""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def oracle_text(sql: str) -> str:
    """sql, which names layers and tables as {name}, for an engine in which the tables are views."""
    used = [n for n in SQL if "{" + n + "}" in sql]
    plain = {t: t for t in TABLES}
    with_ = ", ".join(f"{n} AS ({SQL[n].format(**plain)})" for n in used)
    body = sql.format(**plain, **{n: n for n in SQL})
    if not with_:
        return body
    return body.replace("WITH RECURSIVE ", f"WITH RECURSIVE {with_}, ", 1) if body.lstrip().startswith("WITH RECURSIVE ") else body.replace("WITH ", f"WITH {with_}, ", 1) if body.lstrip().startswith("WITH ") else f"WITH {with_} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived chart layer over the tables in sf_dir."""
    text = SQL[name]
    return spark.sql(text.replace("VARCHAR(9)", "STRING"), **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})
