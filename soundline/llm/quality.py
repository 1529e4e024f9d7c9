"""Quality rules: base rules on document statistics, then gradient-boosted trees with monotonic constraints.

Statistics are counted over whole texts. Trees are grown on binned statistics of a bounded labelled sample and
flattened into node arrays, so that scoring steps all rows of a batch down one level at a time in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "bang_share", "bar_share", "line_words", "stop_share", "distinct_share"]
#: Direction in which a feature may move the score.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "bang_share": -1, "bar_share": -1}
WINDOW = 8
_KIND = np.zeros(256, np.uint8)  # 1 space, 2 symbol, 3 upper case, 4 digit, 5 end mark
for _k, _chars in ((1, b" \t\n\v\f\r"), (2, b"#*$%&|<>"), (3, bytes(range(65, 91))), (4, b"0123456789"), (5, b".,;:?")):
    _KIND[np.frombuffer(_chars, np.uint8)] = _k
_MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 2**64) for i in range(WINDOW)], np.uint64)


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def repeated(ids: np.ndarray, size: int = WINDOW) -> int:
    """Positions covered by windows of size that occur twice or more; overlaps count once, first ones included."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    x = ids.astype(np.uint64)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)
    x ^= x >> np.uint64(32)
    h = sum(x[i : n + i] * _MIX[i] for i in range(size))
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of a whole text; null counts as a text without words."""
    text = text if isinstance(text, str) else ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=6)
    words = words_of(text)
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if words_of(x)]
    n, chars = len(words), len(text) - int(kinds[1])
    dup, again = len(lines) - len(set(lines)), repeated(ids)
    counts = [n, chars, int(kinds[2]), dup, again]
    short = int(sum(c for w, c in zip(numbers, np.bincount(ids, minlength=len(numbers)).tolist(), strict=True) if len(w) <= 3))
    m, k, c = max(n, 1), max(len(lines), 1), max(len(raw), 1)
    return counts, [
        float(np.log1p(n)), chars / m, int(kinds[2]) / m, dup / k, again / m, int(kinds[3]) / c, int(kinds[4]) / c,
        text.count("!") / m, text.count("|") / m, n / k, short / m, len(numbers) / m,
    ]


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 10, ridge: float = 1.0) -> dict:
    """Boosted trees for the log-odds of y, as node arrays [tree, node] with children 2i+1 and 2i+2.

    A node's value stays within bounds that its constrained ancestors set at the middle of their children's values,
    so the sum is monotonic in every feature of MONOTONE.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    b = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # bin k: over cut k-1, up to cut k
    sign = [MONOTONE.get(f, 0) for f in FEATURES[:m]]
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    z = np.full(n, base)
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.full((trees, size), -1, np.int32), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for node in range(size):
            if node not in bounds:
                continue
            lo, hi = bounds[node]
            own = np.flatnonzero(at == node)
            value[t, node] = np.clip(g[own].sum() / (h[own].sum() + ridge), lo, hi)
            if node >= size // 2 or len(own) < 2 * least:
                continue
            best = (1e-6, None)
            for j in range(m):
                k = len(cuts[j]) + 1
                if k < 2:
                    continue
                gs, hs, ns = (np.cumsum(np.bincount(b[own, j], w, k))[:-1] for w in (g[own], h[own], np.ones(len(own))))
                gr, hr = g[own].sum() - gs, h[own].sum() - hs
                vl, vr = np.clip(gs / (hs + ridge), lo, hi), np.clip(gr / (hr + ridge), lo, hi)
                gain = (gs * vl - (hs + ridge) * vl**2 / 2) + (gr * vr - (hr + ridge) * vr**2 / 2)
                v = value[t, node]
                gain -= g[own].sum() * v - (h[own].sum() + ridge) * v**2 / 2
                gain[(ns < least) | (len(own) - ns < least) | (sign[j] * (vr - vl) < 0)] = 0
                if gain.max(initial=0) > best[0]:
                    i = int(gain.argmax())
                    best = (gain[i], (j, i, vl[i], vr[i]))
            if best[1] is None:
                continue
            j, i, vl, vr = best[1]
            feature[t, node], cut[t, node] = j, cuts[j][i]
            left = b[own, j] <= i
            at[own[left]], at[own[~left]] = 2 * node + 1, 2 * node + 2
            mid = (vl + vr) / 2
            bounds[2 * node + 1] = (lo, min(hi, mid)) if sign[j] > 0 else (max(lo, mid), hi) if sign[j] < 0 else (lo, hi)
            bounds[2 * node + 2] = (max(lo, mid), hi) if sign[j] > 0 else (lo, min(hi, mid)) if sign[j] < 0 else (lo, hi)
        value[t] *= rate
        z += value[t, at]
    return {"feature": feature, "cut": cut, "value": value, "base": base, "depth": depth}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of good quality of each row of x."""
    rows, z = np.arange(len(x)), np.full(len(x), model["base"])
    for f, c, v in zip(model["feature"], model["cut"], model["value"], strict=True):
        at = np.zeros(len(x), np.int64)
        for _ in range(model["depth"]):
            j = f[at]
            at = np.where(j < 0, at, 2 * at + 1 + (x[rows, j] > c[at]))
        z += v[at]
    return 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 10_000) -> dict | None:
    """Train on at most `most` labelled rows of each label, taken in an order fixed by a hash of the id; None without both labels."""
    told = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"), F.xxhash64(F.col("doc_id").cast("string")).alias("turn"))
    good, bad = (told.filter(F.col("y") == y).orderBy("turn", "doc_id").limit(most) for y in (1, 0))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"turn": f["turn"], "y": f["y"], "x": [statistics(t)[1] for t in f["text"]]})

    told = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(good.union(bad)), "doc_id")  # 2 x most ids at most
    rows = told.select("turn", "y", "text").mapInPandas(run, "turn long, y int, x array<double>").collect()
    rows.sort(key=lambda r: (r["turn"], r["y"], r["x"]))
    y = np.array([r["y"] for r in rows], float)
    return grow(np.array([r["x"] for r in rows]), y) if len(y) and 0 < y.mean() < 1 else None


def judge(docs: DataFrame, model: dict | None, least_words: int = 20, most_repeated: int = 30, least_score: float = 0.5) -> DataFrame:
    """docs with COUNTS, base_failed, quality_score and kept.

    base_failed: fewer than least_words words, or over most_repeated percent of them in repeated windows. kept: not
    base_failed and scored at least_score or more; without a model the score is 1. Null and empty texts have no words
    and fail. The new columns replace input columns of the same names. Very long texts are counted whole, repeated rows
    are judged alike and all stay, an empty table stays empty.
    """
    kind = "struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ", quality_score: double>"

    def run(texts: pd.Series) -> pd.DataFrame:
        found = [statistics(t) for t in texts]
        out = pd.DataFrame(np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS)), columns=COUNTS)
        x = np.array([f for _, f in found], float).reshape(-1, len(FEATURES))
        out["quality_score"] = predict(model, x) if model else 1.0
        return out

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    new = [*COUNTS, "quality_score", "base_failed", "kept"]
    old = [c for c in docs.columns if c.lower() not in new]
    found = docs.select(*(F.col(f"`{c}`") for c in old), F.pandas_udf(run, kind)(F.col("text").cast("string")).alias("_stats"))
    out = found.select(*(F.col(f"`{c}`") for c in old), "_stats.*")
    out = out.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= least_score))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents, with a model of their quality labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, fit(docs, labels)).select("doc_id", *COUNTS, "base_failed", "kept")
