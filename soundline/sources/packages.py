"""Chart files and packages: discovery with scale pruning, unpacking of archives, and publishing of a built file."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import shutil
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import usage_band
from .sqlite import metadata


def chart_files(spark: SparkSession, root: str, coarse: bool = False) -> DataFrame:
    """path, band, length of every *.000 file below root; bands 1 and 2 only if coarse. Names without a band stay.

    Contents aren't read: a later join by path, or binaryFile on the paths, does that for the files that are kept.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.000").load(root)
    found = found.select("path", usage_band(F.element_at(F.split("path", "/"), -1)).alias("band"), "length")
    return found if coarse else found.filter(F.coalesce(~F.col("band").isin(1, 2), F.lit(True)))


def members(spark: SparkSession, root: str) -> DataFrame:
    """archive, ok, member, content of every *.zip file below root; a bad archive is one row with ok false.

    Spark hands an archive over whole, so one of over 2 GB can't be read; its members are given one at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in (n for n in z.namelist() if not n.endswith("/")):
                            yield pd.DataFrame({"archive": [path], "ok": True, "member": [name], "content": [z.read(name)]})
                except zipfile.BadZipFile:
                    yield pd.DataFrame({"archive": [path], "ok": False, "member": [None], "content": [None]})

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(root)
    return found.select("path", "content").mapInPandas(run, "archive string, ok boolean, member string, content binary")


def _sha256(stream) -> str:
    digest = hashlib.sha256()
    while block := stream.read(1 << 20):
        digest.update(block)
    return digest.hexdigest()


def publish(path: str, folder: str, name: str) -> dict:
    """Pack a built SQLite file as folder/name.sqlite.gz beside name.metadata.json; returns sizes and the package's SHA-256.

    The package counts only if it unpacks to the very bytes it was made of; else it goes and ValueError is raised, as
    for a file without metadata.
    """
    told = metadata(path)
    if told is None:
        raise ValueError(f"no metadata in {path}")
    os.makedirs(folder, exist_ok=True)
    packed = os.path.join(folder, f"{name}.sqlite.gz")
    with open(path, "rb") as source, gzip.open(packed, "wb", compresslevel=9) as out:
        shutil.copyfileobj(source, out)
    with open(path, "rb") as source, gzip.open(packed, "rb") as back:
        same = _sha256(source) == _sha256(back)
    if not same:
        os.remove(packed)
        raise ValueError(f"{packed} doesn't unpack to {path}")
    with open(os.path.join(folder, f"{name}.metadata.json"), "w") as f:
        json.dump({k: told.get(k, d) for k, d in (("country", None), ("name", None), ("description", ""), ("schema_version", 1))}, f, indent=2)
    with open(packed, "rb") as f:
        return {"package": packed, "bytes_in": os.path.getsize(path), "bytes_out": os.path.getsize(packed), "sha256": _sha256(f)}
