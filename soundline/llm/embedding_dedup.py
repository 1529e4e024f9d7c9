"""Embedding near-duplicates by lattice hashing: random projections decoded to E8 points in several tables.

Each table turns unit vectors by random orthonormal directions into eight dimensions and finds the nearest point of
the E8 lattice, a vector's home cell. Vectors also show up in the neighbouring cells nearest to them. Within a cell,
whoever is at home meets everyone; cosines in double precision decide. Cells are cut into tiles, whose pairs are joined by
cell and slot, so that a cell with a third of all vectors is many keys, and a pair is counted in one canonical cell however often it meets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, store

TABLES, PROBES, SCALE, TILE = 4, 4, 0.22, 512


@lru_cache(1)
def roots() -> np.ndarray:
    """The 240 least vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out, float)


def _even(y: np.ndarray) -> np.ndarray:
    """Nearest point with whole coordinates of even sum."""
    r = np.rint(y)
    off = y - r
    k = np.abs(off).argmax(1)
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    r[odd, k[odd]] += np.where(off[odd, k[odd]] >= 0, 1, -1)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    a, b = _even(y), _even(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(4)
def _directions(dim: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng(20 + dim)
    return np.stack([np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim] for _ in range(tables)])


def _key(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    h = np.full(points.shape[:-1], (table << 20) + dim, np.uint64)
    for i in range(8):
        h = (h ^ np.rint(2 * points[..., i]).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """[vector, table, 1 + probes]: keys of the home cell and of the neighbouring cells nearest to the vector."""
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t, d in enumerate(_directions(unit.shape[1], tables)):
        y = unit @ d / scale
        c = nearest_e8(y)
        near = np.argsort(-((y - c) @ roots().T), axis=1, kind="stable")[:, :probes]
        out[:, t, 0] = _key(c, t, unit.shape[1])
        out[:, t, 1:] = _key(c[:, None, :] + roots()[near], t, unit.shape[1])
    return out


def _units(bodies: list, kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(b, kind) for b in bodies]).astype(float)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _deal(tables: int, probes: int, scale: float, kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            by: dict[int, list[int]] = {}
            for i, v in enumerate(f["v"]):
                by.setdefault(len(v), []).append(i)
            for rows in by.values():
                c = cells(_units([f["v"].iloc[i].astype(kind) for i in rows], kind), tables, probes, scale)
                node, mult = f["node"].to_numpy()[rows], f["mult"].to_numpy()[rows]
                yield pd.DataFrame({"node": node, "mult": mult, "body": [f["v"].iloc[i].astype(kind).tobytes() for i in rows], "at": [k.ravel() for k in c]})

    return run


def _meet(least: float, tables: int, probes: int, scale: float, kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out: list[pd.DataFrame] = []
            for cell, same, one, two in zip(f["cell"], f["same"], f["one"], f["two"], strict=True):
                a, b = ({k: [r[k] for r in side] for k in ("node", "mult", "body")} for side in (one, two))
                ua, ub = _units(a["body"], kind), _units(b["body"], kind)
                na, nb, ma, mb = (np.array(x, np.int64) for x in (a["node"], b["node"], a["mult"], b["mult"]))
                i, j = np.nonzero(ua @ ub.T >= least)
                keep = (na[i] < nb[j]) if same else (na[i] != nb[j])
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                ca, cb = cells(ua, tables, probes, scale), cells(ub, tables, probes, scale)
                first = np.full(len(i), -1, np.int64)
                cell_at = np.zeros(len(i), np.int64)
                for t in range(tables):
                    ha, hb = ca[i, t, 0], cb[j, t, 0]
                    by_a, by_b = (ca[i, t] == hb[:, None]).any(1), (cb[j, t] == ha[:, None]).any(1)
                    new = (first < 0) & (by_a | by_b)
                    first[new] = t
                    cell_at[new] = np.where(by_a & by_b, np.minimum(ha, hb), np.where(by_a, hb, ha))[new]
                keep = cell_at == cell
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                for own, w in ((na, np.bincount(i, mb[j], len(na))), (nb, np.bincount(j, ma[i], len(nb)))):
                    at = np.flatnonzero(w)
                    out.append(pd.DataFrame({"a": own[at], "b": own[at], "n": w[at].astype(np.int64)}))
                x, y = na[i], nb[j]
                if len(x) > len(na) + len(nb):
                    x, y = forest(x, y)
                out.append(pd.DataFrame({"a": x, "b": y, "n": 0}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.95, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors(vec_id, embedding).

    n_links counts the other rows found at cosine least or more; component_id is the smallest vec_id reachable, itself
    included; kept marks the row that names its component. Rows whose vector is null, empty, zero or holds null or
    non-finite components, and rows without vec_id, link with nothing. Equal vectors stand for one node that counts
    them all; of rows that repeat a vec_id each counts. An empty table gives an empty result, other columns are not read.
    Vectors of different lengths never link. Links below least are never given; of the others, recall is
    measured against brute force in the tests.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.withColumn("ok", F.coalesce(fine, F.lit(False)))
    classes = v.filter("ok").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("mult"))
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")  # vec_ids may repeat
    dealt = store(classes.select("node", "mult", "v").mapInPandas(_deal(tables, probes, scale, kind), "node long, mult long, body binary, at array<long>"), "dealt")
    seen = dealt.select("node", "mult", "body", F.posexplode("at").alias("i", "cell")).withColumn("home", F.col("i") % (1 + probes) == 0).drop("i")
    counts = dealt.select(F.explode("at").alias("cell")).groupBy("cell").agg(F.expr(f"int(ceil(count(*) / {tile}))").alias("slots")).filter("slots > 1")
    seen = seen.join(counts, "cell", "left").withColumn("slot", F.expr("int(pmod(xxhash64(node), coalesce(slots, 1)))"))
    row = F.struct("node", "mult", "body")
    tiles = seen.groupBy("cell", "slot").agg(F.collect_list(row).alias("all"), F.expr("bool_or(home)").alias("home"), F.expr("max(coalesce(slots, 1))").alias("slots"))
    tiles = store(tiles, "cells")
    a = tiles.select("cell", F.col("slot").alias("s1"), F.col("home").alias("h1"), F.col("all").alias("one"), F.explode(F.expr("sequence(slot, slots - 1)")).alias("slot"))  # a row a pair of tiles
    b = tiles.select("cell", "slot", F.col("home").alias("h2"), F.col("all").alias("two"))
    pairs = a.join(b, ["cell", "slot"]).filter("(h1 or h2) and (s1 < slot or size(one) > 1)").select("cell", F.expr("s1 = slot").alias("same"), "one", "two")
    found = store(pairs.mapInPandas(_meet(least, tables, probes, scale, kind), "a long, b long, n long"), "links")
    linked = found.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    comp = components(found.filter("a <> b"))
    told = classes.join(linked, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = told.groupBy("component").agg(F.min("least").alias("component_id"))
    told = told.join(name, "component").select("v", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id")
    good = v.filter("ok").join(told, "v").select("vec_id", "n_links", "component_id")
    rest = v.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at cosine 0.95."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
