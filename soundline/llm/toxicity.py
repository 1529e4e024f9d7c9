"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text compete for each window.

Both dictionaries are trained by zstandard, on toxic and on ordinary texts of the labelled rows. Grams that toxic
texts hold at a much higher rate than ordinary ones are cut out of the ordinary dictionary, all others out of the
toxic one; what is left of it makes a strong and a mild toxic dictionary by that contrast, each in front of the
ordinary one. A window is some consecutive words; its distance is the number of bytes that a toxic dictionary saves
over the ordinary one, and windows past a threshold are strong or mild hits. A text's evidence is the log likelihood
of its hits among its windows at the rates of toxic texts against those of ordinary ones: a long text needs more hits
than a short one. Isotonic regression turns evidence into a probability. Thresholds, rates and calibration come from
cross-validation within the labelled rows: each of them is judged by dictionaries of the other folds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

_SPACED = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORDS, STEP, LONGEST = 4, 3, 256  # words of a window, words from one window to the next, bytes of a window
LEVEL, GRAM, ALIGN, HEAD = 3, 5, 24, 6
SIZE, PIECE = 131_072, 256  # bytes of a dictionary, of a training sample
STRONG, MILD, LEAST, AROUND = 20.0, 6.0, 4, 3  # contrasts of grams; texts that must hold one; grams kept beside one
FOLDS = 3
NOTHING = -1e6


def plain(text: str | None) -> bytes:
    """Runs of letters between single spaces; bytes beyond ASCII count as letters. Without letters: empty.

    The letters a-z are upper case among a word's first HEAD bytes and lower case after, so that how words begin is
    not taken for what lies within other words.
    """
    words = text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split() if isinstance(text, str) else []
    if not words:
        return b""
    x = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    spaces = np.flatnonzero(x == 32)
    near = np.zeros(len(x) + HEAD + 1, bool)
    for i in range(1, HEAD + 1):
        near[spaces + i] = True
    return (x - 32 * (near[: len(x)] & (x >= 97) & (x <= 122)).astype(np.uint8)).tobytes()


def windows(raw: bytes) -> np.ndarray:
    """[window, (from, length)]: WORDS words and the spaces around them, every STEP words; longer ones in pieces of LONGEST."""
    spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    n = len(spaces) - 1
    if n < 1:
        return np.empty((0, 2), np.uint64)
    first = np.arange(0, max(1, n - WORDS + STEP), STEP)
    start, end = spaces[first], spaces[np.minimum(first + WORDS, n)] + 1
    pieces = -(-(end - start) // LONGEST)
    if pieces.max() > 1:
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, end = np.repeat(start, pieces) + turn * LONGEST, np.repeat(end, pieces)
        end = np.minimum(end, start + LONGEST)
    return np.stack([start, end - start], 1).astype(np.uint64)


def _grams(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = max(len(x) - GRAM + 1, 0)
    return sum((x[i : i + n] << np.uint64(8 * i) for i in range(GRAM)), np.zeros(n, np.uint64))


def _held(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, texts that hold it), sorted."""
    own = [np.unique(_grams(t)) for t in texts]
    return np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_counts=True)


def _number(held: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> np.ndarray:
    keys, counts = held
    if not len(keys):
        return np.zeros(len(grams), np.int64)
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    return np.where(keys[at] == grams, counts[at], 0)


def _trained(texts: list[bytes]) -> bytes:
    """A zstandard dictionary of the texts; their own bytes where they are too few to train on."""
    import zstandard as Z

    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return Z.train_dictionary(SIZE, [p for p in pieces if len(p) >= 32]).as_bytes()
    except Z.ZstdError:
        return b"".join(pieces)[-SIZE:]


def _runs(body: bytes, kept: np.ndarray, around: int = 0) -> list[bytes]:
    """Maximal runs of bytes whose grams are all kept, or lie within AROUND of one that is, each once."""
    kept = np.convolve(kept, np.ones(2 * around + 1), "same") > 0 if around and len(kept) > 2 * around else kept
    edge = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
    return list(dict.fromkeys(body[a : b + GRAM - 1] for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))


def _padded(body: bytes) -> bytes:
    """Whole multiples of ALIGN: what follows lies where it would lie alone, so that it is found alike."""
    return b" " * (-len(body) % ALIGN) + body


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The ordinary dictionary, and the strong and the mild toxic one with the ordinary one behind."""
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    held = _held(toxic), _held(ordinary)
    total = [max(int(h[1].sum()), 1) for h in held]

    def contrast(body):
        grams = _grams(body)
        a, b = _number(held[0], grams), _number(held[1], grams)
        return np.where(a >= LEAST, (a / total[0]) / ((b + 0.5) / total[1]), 0.0)

    mine, theirs = _trained(toxic), _trained(ordinary)
    base = _padded(b"".join(_runs(theirs, contrast(theirs) < MILD)))
    found = contrast(mine)
    return [base, *(_padded(b"".join(_runs(mine, side, AROUND))) + base for side in (found >= STRONG, (found >= MILD) & (found < STRONG)))]


class Distance:
    """Bytes that the strong and the mild toxic dictionary save over the ordinary one, for each window of a text."""

    def __init__(self, bodies: list[bytes]):
        import zstandard as Z

        how = Z.ZstdCompressionParameters.from_level(LEVEL, min_match=GRAM, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.compress, self.segments = [], Z.BufferWithSegments
        for body in bodies:
            words = Z.ZstdCompressionDict(body or b" " * ALIGN, dict_type=Z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=how)
            self.compress.append(Z.ZstdCompressor(dict_data=words, compression_params=how).multi_compress_to_buffer)

    def __call__(self, raw: bytes) -> np.ndarray:
        at = windows(raw)
        if not len(at):
            return np.empty((0, 2), np.int64)
        sizes = []
        for i in range(0, len(at), 50_000):
            own = self.segments(raw, at[i : i + 50_000].tobytes())
            sizes.append(np.stack([np.fromiter(map(len, c(own)), np.int64) for c in self.compress], 1))
        sizes = np.concatenate(sizes)
        return sizes[:, :1] - sizes[:, 1:]


def tally(far: np.ndarray, thresholds: tuple[int, int]) -> tuple[int, int, int]:
    """(strong hits, mild hits, windows) of a text's distances."""
    strong = far[:, 0] >= thresholds[0]
    return int(strong.sum()), int(((far[:, 1] >= thresholds[1]) & ~strong).sum()), len(far)


def evidence(counts: np.ndarray, toxic_rates: np.ndarray, ordinary_rates: np.ndarray) -> np.ndarray:
    """Poisson log likelihood ratio of the hits among the windows; texts without words have the least."""
    hits, n = counts[:, :2], counts[:, 2]
    return np.where(n > 0, hits @ np.log(toxic_rates / ordinary_rates) - (toxic_rates - ordinary_rates).sum() * n, NOTHING)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best non-decreasing fit of y on x (pool adjacent violators): a knot at the mean of each block."""
    xs, inv = np.unique(x, return_inverse=True)
    blocks: list[list[float]] = []
    for w, s, at in zip(np.bincount(inv), np.bincount(inv, y), xs, strict=True):
        blocks.append([s, w, at * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, total = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + total]
    return np.array([total / w for _, w, total in blocks]), np.array([s / w for s, w, _ in blocks])


def train(texts: list[str], labels: list[int]) -> dict:
    """Dictionaries of all texts; thresholds, rates and calibration from distances by dictionaries of other folds.

    The fold of a text is a hash of it, so copies share one. The thresholds are those whose calibrated scores are
    likeliest. The order of texts decides nothing. Without labels of both kinds every score is 0 or, with toxic ones
    alone, 1.
    """
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    raws, y = [plain(texts[i]) for i in order], np.array([labels[i] for i in order], int)
    folds = np.array([zlib.crc32(r) % FOLDS for r in raws], int)
    sides = lambda at: [[raws[i] for i in np.flatnonzero(at & (y == k))] for k in (1, 0)]
    model = {"bodies": [b""] * 3, "thresholds": (1, 1), "rates": (np.ones(2), np.ones(2)), "x": np.array([0.0]), "y": np.array([float(len(y) > 0 and y.min())])}
    if not len(y) or y.all() or not y.any():
        return model
    far: list[np.ndarray] = [np.empty((0, 2))] * len(y)
    for k in range(FOLDS):
        distance = Distance(dictionaries(*sides(folds != k)))
        for i in np.flatnonzero(folds == k):
            far[i] = distance(raws[i])
    best = -np.inf
    for thresholds in ((a, b) for a in range(1, 9) for b in range(1, 9)):
        counts = np.array([tally(d, thresholds) for d in far])
        rates = [(counts[y == k, :2].sum(0) + 0.5) / (counts[y == k, 2].sum() + 1) for k in (1, 0)]
        rates[0] = np.maximum(*rates)
        found = evidence(counts, *rates)
        knots = isotonic(found, y.astype(float))
        p = np.clip(np.interp(found, *knots), 1e-3, 1 - 1e-3)
        if (fit := (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()) > best:
            best = fit
            model |= {"thresholds": thresholds, "rates": tuple(rates), "x": knots[0], "y": knots[1]}
    return model | {"bodies": dictionaries(*sides(np.ones(len(y), bool)))}


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, max_chars: int) -> list:
    """(text, label) of most rows of each label at most, in an order fixed by a hash of the id.

    The bound makes this the only read that does not cover all rows; longer texts than max_chars teach nothing.
    """
    told = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"), F.xxhash64(F.col("doc_id").cast("string")).alias("turn"))
    picked = None
    for y in (0, 1):
        own = told.filter(F.col("y") == y).orderBy("turn", "doc_id").limit(most)
        picked = own if picked is None else picked.union(own)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    rows = texts.join(F.broadcast(picked), "doc_id").select("turn", "doc_id", "text", "y").collect()  # at most 2 x most rows
    return sorted(rows, key=lambda r: (r["turn"], r["doc_id"], r["text"]))


def fit(docs: DataFrame, labels: DataFrame, most: int = 3000, max_chars: int = 50_000) -> dict:
    """Train on a bounded sample: at most `most` labelled texts of either label, each of at most max_chars characters."""
    rows = training_rows(docs, labels, "toxic", most, max_chars)
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def probabilities(texts: list, model: dict, distance: Distance) -> np.ndarray:
    counts = np.array([tally(distance(plain(t)), model["thresholds"]) for t in texts], float).reshape(-1, 3)
    return np.interp(evidence(counts, *model["rates"]), model["x"], model["y"])


def score(docs: DataFrame, model: dict, to: str = "score") -> DataFrame:
    """docs with each whole text's probability of being toxic, as a column that replaces one of that name.

    Null and empty texts, and those without letters, get the lowest. Very long texts are read in windows like any
    other, in batches. Repeated rows get the same score; an empty table stays empty; other columns stay as they are.
    """
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distance = Distance(model["bodies"])
        for texts in parts:
            yield pd.Series(probabilities(texts.tolist(), model, distance))
        release()

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(to, F.pandas_udf(run, "double")(F.col("text").cast("string")))


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; a third of the labels, by the crc32 of doc_id, is never learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
