"""The registry of shared nodes kept up to date from files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.seams import upsert

SCHEMA = "node_id long, lon_e5 long, lat_e5 long, node_depth double, source_region string, batch long"


def current(spark: SparkSession, path: str) -> DataFrame:
    """The registry under path: its last whole version; without any, an empty table (open or create)."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(base)] if fs.exists(base) else []
    done = [n for n in names if n.startswith("v") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.schema(SCHEMA).parquet(f"{path}/{max(done)}") if done else spark.createDataFrame([], SCHEMA)


def follow(spark: SparkSession, arriving: str, path: str, checkpoint: str) -> StreamingQuery:
    """Reads all parquet files in arriving that were not read before and upserts their rows; the last batch of a node wins.

    Every micro-batch writes a new version under its own number, so one that runs again after a failure replaces its
    own version from the same state and changes nothing else.
    """
    def apply(rows: DataFrame, number: int) -> None:
        before = current(spark, path).filter(F.lit(True))
        upsert(before, rows, "node_id", "batch").write.mode("overwrite").parquet(f"{path}/v{number:020d}")

    return spark.readStream.schema(SCHEMA).parquet(arriving).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
