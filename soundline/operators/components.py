"""Connected components by alternating star contractions over written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; an own one only in local mode, where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='soundline-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, component) of every node of nodes(k): the smallest node it reaches over edges(u, v)."""
    e = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := e.agg(F.count(F.lit(1)), F.sum(F.expr("cast(xxhash64(u, v) as decimal(38, 0))"))).first()) != before:
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.expr("filter(array(struct(u, m as v), struct(v as u, m as v)), x -> x.u <> x.v)")).alias("x")).select("x.u", "x.v").distinct()
        e = written(e)
    return nodes.select("k").join(e.select(F.col("u").alias("k"), F.col("v").alias("component")), "k", "left").select("k", F.coalesce("component", "k").alias("component"))
