"""License scans with DataFrame functions alone: MinHash bands over overlapping windows, then exact containment.

A window has as many shingles as the template it is held against. Each of BANDS hash functions is a band of one row:
a window whose shingles are a share J of both sets' union collides in some band with probability 1 - (1 - J)^BANDS,
over 0.999 where 0.8 of a template's shingles are in place. A window can only collide in a band if it holds the
template's least shingle of that band, so windows are cut around those shingles alone and their minima taken there;
texts without any are left after one pass over their shingle hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .url_filter import LOWER, UPPER

BANDS, SHINGLE, LEAST = 8, 5, 0.8

# fixed values: well-known license notices
TEMPLATES = [
    ("mit-line", "Released under the MIT License."),
    ("apache-2-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4-line", "Licensed under CC BY-NC 4.0."),
    ("all-rights", "All rights reserved."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
]


def words(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing A-Z; null gives none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[^a-z0-9]+")
    return F.filter(cut, lambda w: w != "")


def _let(value: Column, f) -> Column:
    """f of value, which is computed once: columns used in a lambda would otherwise be computed for each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _shingle_hashes(hashes: Column, size: int) -> Column:
    def of(h):
        n = F.size(h) - size + 1
        at = lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size)))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<long>"))

    return _let(hashes, of)


def _shingle_texts(ws: Column, size: Column) -> Column:
    return _let(ws, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " ")))


def templates_of(spark: SparkSession, given: list[tuple[str, str]]) -> DataFrame:
    """license, size (words a shingle), m (shingles), texts (distinct shingles), hashes, least (per band)."""
    rows = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(a).alias("license"), F.lit(b).alias("text")) for a, b in given))))
    t = rows.select("license", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0).withColumn("size", F.least(F.size("ws"), F.lit(SHINGLE)))
    sizes = range(1, SHINGLE + 1)
    wh = F.transform("ws", lambda w: F.xxhash64(w))
    t = t.withColumn("wh", wh)
    hashes = F.coalesce(*(F.when(F.col("size") == n, _shingle_hashes(F.col("wh"), n)) for n in sizes))
    t = t.select("license", "size", hashes.alias("hashes"), F.array_distinct(_shingle_texts(F.col("ws"), F.col("size"))).alias("texts"))
    least = F.array(*(F.array_min(F.transform("hashes", _mixed(b))) for b in range(BANDS)))
    return t.select("license", "size", F.size("hashes").alias("m"), "texts", least.alias("least"))


def _is_in(hashes: list[int]):
    return lambda h: h["x"].isin(*hashes)


def _mixed(band: int):
    return lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("v"), x.alias("x"))


def scan(docs: DataFrame, given: list[tuple[str, str]] = TEMPLATES, most: int = 2000) -> DataFrame:
    """doc_id, license, containment: templates of which LEAST of the distinct shingles or more stand in one window.

    given: (license, text); each scan of docs takes `most` of them, so that the plan stays bounded. Shingles are SHINGLE words, or the whole template where that is shorter.
    containment is the best window's share, rounded to four digits. One row for each doc_id and license, whatever the
    number of copies in the text and of rows with that doc_id; null ids count as one id. Texts that are null, empty
    or hold no template have no row; an empty table gives none. Very long texts are read whole; columns but doc_id and
    text are not read.
    """
    if len(given) > most:
        return scan(docs, given[:most], most).unionByName(scan(docs, given[most:], most))
    t = templates_of(docs.sparkSession, given)
    # at most BANDS entries a template, so their number is bounded by `most`
    known = t.select("license", "size", "m", "texts", F.posexplode("least").alias("band", "l")).select("license", "size", "m", "texts", "band", "l.v", "l.x").collect()
    by_size: dict[int, list] = {}
    for r in known:
        by_size.setdefault(r["size"], []).append(r)
    base = docs.select("doc_id", words(F.col("text")).alias("ws"))
    base = base.withColumn("wh", F.transform("ws", lambda w: F.xxhash64(w)))
    found = None
    for size, rows in sorted(by_size.items()):
        hashes = sorted({r["x"] for r in rows})
        own = base.withColumn("sh", _shingle_hashes(F.col("wh"), size)).filter(F.arrays_overlap("sh", F.array(*map(F.lit, hashes))))
        hits = F.filter(F.transform("sh", lambda x, i: F.struct(x.alias("x"), i.alias("at"))), _is_in(hashes))
        own = own.select("doc_id", "ws", "sh", F.explode(hits).alias("h")).select("doc_id", "ws", "sh", "h.x", "h.at")
        side = docs.sparkSession.range(1).select(F.inline(F.array(*(F.struct(F.lit(r["license"]).alias("license"), F.lit(r["m"]).alias("m"), F.array(*map(F.lit, r["texts"])).alias("texts"), F.lit(r["band"]).alias("band"), F.lit(r["v"]).alias("v"), F.lit(r["x"]).alias("x")) for r in rows))))
        pairs = own.join(F.broadcast(side), "x")
        low, high = F.greatest(F.lit(0), F.col("at") - F.col("m") + 1), F.greatest(F.lit(0), F.least(F.col("at"), F.size("sh") - F.col("m")))
        pairs = pairs.select("doc_id", "ws", "sh", "license", "m", "texts", "band", "v", F.explode(F.sequence(F.least(low, high), high)).alias("start"))
        window = F.slice("sh", F.col("start") + 1, F.col("m"))
        collides = F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.col("band")))) == F.col("v")
        texts = _shingle_texts(F.slice("ws", F.col("start") + 1, F.least(F.col("m") + (size - 1), F.size("ws") - F.col("start"))), F.lit(size))
        share = F.size(F.array_intersect("texts", texts)) / F.size("texts")
        part = pairs.filter(collides).select("doc_id", "license", share.alias("share")).filter(F.col("share") >= LEAST)
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "license").agg(F.round(F.max("share"), 4).alias("containment"))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licenses in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEMPLATES)
    low = f"translate({{}}, '{UPPER}', '{LOWER}')"
    cut = lambda c: f"list_filter(string_split_regex({low.format(c)}, '[^a-z0-9]+'), lambda w: w <> '')"
    sh = lambda ws, n: f"list_transform(range(1, len({ws}) - {n} + 2), lambda i: list_aggregate({ws}[i:i + {n} - 1], 'string_agg', ' '))"
    return f"""WITH t0 AS (SELECT license, {cut("text")} AS ws FROM (VALUES {values}) v(license, text)),
      t1 AS (SELECT license, least(len(ws), {SHINGLE}) AS n, ws FROM t0), t AS (SELECT license, n, {sh("ws", "n")} AS all_, list_distinct({sh("ws", "n")}) AS texts FROM t1),
      d AS (SELECT doc_id, {cut("coalesce(text, '')")} AS ws FROM documents), s AS (SELECT doc_id, k.n, {sh("ws", "k.n")} AS sh FROM d CROSS JOIN (SELECT DISTINCT n FROM t) k WHERE len(ws) >= k.n),
      p AS (SELECT doc_id, license, texts, len(all_) AS m, sh FROM s JOIN t ON s.n = t.n WHERE list_has_any(sh, texts)),
      w AS (SELECT doc_id, license, texts, sh[i:i + m - 1] AS win FROM (SELECT *, unnest(range(1, greatest(len(sh) - m + 1, 1) + 1)) AS i FROM p)),
      c AS (SELECT doc_id, license, max(len(list_intersect(texts, win)) / len(texts)) AS share FROM w GROUP BY doc_id, license)
      SELECT doc_id, license, round(share, 4) AS containment FROM c WHERE share >= {LEAST}"""


ORACLE_SQL = _sql()
