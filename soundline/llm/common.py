"""Shared pieces: durable intermediate tables, word splitting and connected components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LINKS = "a long, b long"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; an own one only in local mode, where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='soundline-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def release() -> None:
    """Give memory that a partition no longer needs back to the system: Python workers are kept and used again."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends here and lost executors lose nothing."""
    spark = df.sparkSession
    schema = StructType([f for f in df.schema])
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and \\t \\n \\v \\f \\r, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the links a-b that isn't its own root; the root is the smallest node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label != (up := label[label])).any():
            label = up
        if (label == before).all():
            break
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for f in frames:
        a, b = forest(np.concatenate([a, f["a"].to_numpy(np.int64)]), np.concatenate([b, f["b"].to_numpy(np.int64)]))
    yield pd.DataFrame({"a": a, "b": b})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links(a, b); component is the smallest node reachable.

    Each partition first shrinks to a spanning forest, then large-star and small-star rounds run as joins on written
    tables until nothing changes, so no component ever has to fit into one task. Links from a node to itself and
    repeated links do no harm. An empty table gives an empty result.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    edges = edges.mapInPandas(_contract, LINKS).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = store(edges, "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.expr("cast(xxhash64(u, v) as decimal(38, 0))"))).first()
        if now[0] == 0 or now == state:
            break
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.expr("if(v = m, array(struct(u, m as v)), array(struct(u, m as v), struct(v as u, m as v)))")).alias("e")).select("e.u", "e.v").distinct()
        edges = store(small, "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
