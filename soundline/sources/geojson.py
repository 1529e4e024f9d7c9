"""GeoJSON layers as DataFrames: scan, box filter with hard trim, and sink.

A layer is (kind, coordinates, properties): the geometry's type, its coordinates as JSON text, and the properties as a
map of texts, since layers differ in both. Everything but the sink's brackets is Column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, coordinates string, properties map<string,string>"
_FEATURE = "struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>"
_POINT = "array<double>"
DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether path, which may hold wildcards, names anything in the store it belongs to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame:
    """Features of all files. Paths that are missing give no rows.

    lines: one feature a line, a form that Spark can split; else each file is a FeatureCollection and is read whole by
    one task, so large layers belong in many files or in lines. Features without geometry have null kind and coordinates.
    """
    there = [p for p in paths if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], SCHEMA)
    if lines:
        f = spark.read.text(there).select(F.from_json("value", _FEATURE).alias("f"))
    else:
        f = spark.read.schema(f"features array<{_FEATURE}>").json(there, multiLine=True).select(F.explode("features").alias("f"))
    return f.filter("f is not null").select(F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"), F.coalesce("f.properties", F.from_json(F.lit("{}"), "map<string,string>")).alias("properties"))


def _parsed(text: Column, depth: int) -> Column:
    return F.from_json(text, "array<" * depth + _POINT + ">" * depth)


def vertices(kind: Column, coordinates: Column) -> Column:
    """All vertices of a geometry as arrays of longitude and latitude; null for other kinds."""
    out = F.lit(None).cast(f"array<{_POINT}>")
    for name, depth in DEPTH.items():
        p = _parsed(coordinates, depth)
        for _ in range(depth - 1):
            p = F.flatten(p)
        out = F.when(kind == name, F.array(p) if depth == 0 else p).otherwise(out)
    return out


def with_box(layer: DataFrame) -> DataFrame:
    """The layer with minx, miny, maxx, maxy of each feature."""
    def end(least, i: int) -> Column:
        return least(F.transform("_vertices", lambda p: p[i]))

    put = {"minx": end(F.array_min, 0), "miny": end(F.array_min, 1), "maxx": end(F.array_max, 0), "maxy": end(F.array_max, 1)}
    return layer.withColumn("_vertices", vertices(F.col("kind"), F.col("coordinates"))).withColumns(put).drop("_vertices")


def _half(ring: Column, axis: int, at: float, sign: int) -> Column:
    """The part of a closed ring with sign * coordinate >= sign * at; a closed ring or an empty array."""
    inside = lambda p: sign * p[axis] >= F.lit(float(sign * at))

    def cut(p: Column, q: Column) -> Column:
        t = (F.lit(float(at)) - p[axis]) / (q[axis] - p[axis])
        other = p[1 - axis] + t * (q[1 - axis] - p[1 - axis])
        return F.array(F.lit(float(at)), other) if axis == 0 else F.array(other, F.lit(float(at)))

    def step(i: Column) -> Column:
        p, q = F.element_at(ring, i), F.element_at(ring, i + 1)
        crossing = F.when(inside(p) != inside(q), F.array(cut(p, q))).otherwise(F.array().cast(f"array<{_POINT}>"))
        return F.concat(F.when(inside(p), F.array(p)).otherwise(F.array().cast(f"array<{_POINT}>")), crossing)

    kept = F.when(F.size(ring) > 1, F.flatten(F.transform(F.sequence(F.lit(1), F.size(ring) - 1), step))).otherwise(F.array().cast(f"array<{_POINT}>"))
    return F.when(F.size(kept) > 0, F.concat(kept, F.slice(kept, 1, 1))).otherwise(kept)


def _trimmed(side: tuple[int, float, int]) -> Column:
    return F.transform("_parts", lambda part: F.transform(part, lambda ring: _half(ring, *side)))


def clip(layer: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Features that meet the box; polygons that reach beyond it are trimmed to it, other kinds stay whole.

    A trimmed ring of a shape that enters the box several times stays one ring that runs along the box's sides.
    """
    met = with_box(layer).filter((F.col("maxx") >= minx) & (F.col("minx") <= maxx) & (F.col("maxy") >= miny) & (F.col("miny") <= maxy))
    whole = (F.col("minx") >= minx) & (F.col("maxx") <= maxx) & (F.col("miny") >= miny) & (F.col("maxy") <= maxy) | ~F.col("kind").isin("Polygon", "MultiPolygon")
    inner, cut = met.filter(whole), met.filter(~whole)
    rings = F.when(F.col("kind") == "Polygon", F.array(_parsed(F.col("coordinates"), 2))).otherwise(_parsed(F.col("coordinates"), 3))
    cut = cut.withColumn("_parts", rings)
    for side in ((0, minx, 1), (0, maxx, -1), (1, miny, 1), (1, maxy, -1)):
        cut = cut.withColumn("_parts", _trimmed(side))
    cut = cut.withColumn("_parts", F.filter(F.transform("_parts", lambda part: F.filter(part, lambda r: F.size(r) > 3)), lambda part: F.size(part) > 0)).filter("size(_parts) > 0")
    cut = cut.withColumn("coordinates", F.when(F.col("kind") == "Polygon", F.to_json(F.element_at("_parts", 1))).otherwise(F.to_json("_parts")))
    return inner.unionByName(cut.drop("_parts")).drop("minx", "miny", "maxx", "maxy")


def features(layer: DataFrame) -> DataFrame:
    """One feature a row as JSON text; property values are texts."""
    geometry = F.when(F.col("kind").isNotNull(), F.concat(F.lit('{"type":'), F.to_json(F.array("kind")).substr(F.lit(2), F.length(F.to_json(F.array("kind"))) - 2), F.lit(',"coordinates":'), "coordinates", F.lit("}"))).otherwise(F.lit("null"))
    return layer.select(F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce(F.to_json("properties"), F.lit("{}")), F.lit(',"geometry":'), geometry, F.lit("}")).alias("value"))


def _collection(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": [json.dumps({"type": "FeatureCollection"})[:-1] + ', "features": [']})
    first = True
    for f in frames:
        if len(f):
            value = "," + f["value"]
            if first:
                value.iloc[0] = value.iloc[0][1:]
            first = False
            yield pd.DataFrame({"value": value})
    yield pd.DataFrame({"value": ["]}"]})


def write(layer: DataFrame, path: str, lines: bool = False) -> None:
    """Replace the folder path: a FeatureCollection in each part file, or a feature a line. Errors are raised."""
    text = features(layer)
    (text if lines else text.mapInPandas(_collection, "value string")).write.mode("overwrite").text(path)
