"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by tiled exact comparison.

Distinct fingerprints are dealt into tiles by the population counts of their four 16-bit quarters. Two
fingerprints within the radius have quarter counts whose absolute differences add up to the radius at most, so
only tile pairs within that distance meet; their fingerprints are compared by exclusive-or and bit counts in numpy.
Tile pairs are joined by cell and slot, so that a cell with a third of all fingerprints is as many keys as it has tiles.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LINKS, components, forest, store, words_of

BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(words: list[bytes], size: int, seed: int) -> int:
    """A bit is 1 if set in over half of the shingles' XXH64; no words: 0; fewer than size: one shingle of all."""
    import xxhash

    if not words:
        return 0
    text = b" ".join(words)
    n = len(words)
    if n <= size:
        return xxhash.xxh64_intdigest(text, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: n - size + 1].tolist()
    hash64 = xxhash.xxh64_intdigest
    h = np.array([hash64(text[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        count += np.unpackbits(h[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(BITS[2 * count > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """docs with a column fp (the 64 bits as a signed long). Letters A-Z are lower-cased; null and empty texts have 0."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        found = [fingerprint([*map(bytes.lower, words_of(t))], size, seed) for t in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return docs.withColumn("fp", fp(F.col("text").cast("string")))


def _offsets(radius: int) -> list[int]:
    near = (d for d in itertools.product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius)
    return sorted(x for d in near if (x := sum(v * 64**i for i, v in enumerate(d))) >= 0)


def _compare(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out_a, out_b = [], []
            for same, one, two in zip(f["same"], f["one"], f["two"], strict=True):
                one, two = np.asarray(one, np.int64), np.asarray(two, np.int64)
                x, y = one.view(np.uint64), two.view(np.uint64)
                a, b = [], []
                for i in range(0, len(x), 256):
                    p, q = np.nonzero(np.bitwise_count(x[i : i + 256, None] ^ y[None, :]) <= radius)
                    a.append(one[p + i])
                    b.append(two[q])
                a, b = np.concatenate(a), np.concatenate(b)
                if len(a) > len(one) + len(two):  # a spanning forest says the same about components
                    a, b = forest(a, b)
                keep = a != b
                out_a.append(a[keep])
                out_b.append(b[keep])
            if out_a:
                yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def link(fps: DataFrame, radius: int = 3, tile: int = 2048) -> DataFrame:
    """(a, b): links between the distinct fingerprints of fps(fp), enough to join all that are within radius."""
    key = " + ".join(f"({radius} + bit_count(shiftrightunsigned(fp, {16 * i}) & 65535)) * {64**i}L" for i in range(4))
    cells = fps.select("fp").distinct().withColumn("cell", F.expr(key))
    # at most 17 to the fourth cells, whatever the input: 83,521 counts
    slots = store(cells.groupBy("cell").agg(F.expr(f"int(ceil(count(*) / {tile}))").alias("slots")), "slots")
    tiles = cells.join(F.broadcast(slots), "cell").withColumn("slot", F.expr("int(pmod(xxhash64(fp), slots))"))
    tiles = store(tiles.groupBy("cell", "slot").agg(F.collect_list("fp").alias("fps")), "tiles")
    ask = tiles.select(F.col("cell").alias("from"), F.col("slot").alias("own"), F.explode(F.array([F.lit(x).cast("long") for x in _offsets(radius)])).alias("by"), F.col("fps").alias("one"))
    ask = ask.withColumn("cell", F.expr("`from` + by")).join(F.broadcast(slots), "cell")
    ask = ask.select("cell", F.explode(F.expr("sequence(if(by = 0, own, 0), slots - 1)")).alias("slot"), "own", "by", "one")  # a row a pair of tiles
    pairs = ask.join(tiles.withColumnRenamed("fps", "two"), ["cell", "slot"])
    return pairs.select(F.expr("by = 0 and own = slot").alias("same"), "one", "two").mapInPandas(_compare(radius), LINKS)


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links of fingerprints) of each row of docs.

    Copies share a fingerprint and stand for one node, however many they are. Null and empty texts have the
    fingerprint zero and are linked like any other. A null doc_id keeps its row and never names a component unless
    the whole component has none. Repeated rows repeat in the result. An empty table gives an empty result.
    """
    fps = store(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), size, seed).select("doc_id", "fp"), "fps")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comp = components(link(fps, radius))
    by = least.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    by = store(by, "classes")
    name = by.groupBy("component").agg(F.min("least").alias("component_id"))
    named = by.join(name, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups that three bits link."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.expr("lpad(lower(hex(fp)), 16, '0')").alias("fingerprint"), "component_id")
