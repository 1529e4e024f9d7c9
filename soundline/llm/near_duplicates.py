"""Near-duplicates by SimHash, verified exactly by the Jaccard similarity of word shingles.

Texts with the same set of shingles are one node. A node's fingerprint has 256 bits, and nodes within a radius of 80
are candidates: a pair of similarity 0.8 differs in 39 bits on average, of few shingles in up to 48, and unrelated
ones in 128, with deviations of 6 to 8. Fingerprints are compared in tiles, by exclusive-or and bit counts in numpy;
tiles meet where their nodes' numbers of shingles allow the similarity. Candidates are verified on the shingles: each
node with its least one, then what is left between components. Of groups with many candidates a node all nodes meet in
tiles instead, whose shared shingles are counted as matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LINKS, components, forest, store, words_of

LARGE, RADIUS, HALF = 4, 80, 47
_MUL = np.random.default_rng(7).integers(0, 2**64, 4, np.uint64) | np.uint64(1)
WORDS = ("f0", "f1", "f2", "f3")


def shingles(text: str | None, size: int) -> np.ndarray:
    """Distinct XXH64 of the runs of size words, ascending; fewer words: one of all; A-Z are lower-cased."""
    import xxhash

    words = [*map(bytes.lower, words_of(text))]
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    hash64 = xxhash.xxh64_intdigest
    return np.unique(np.array([hash64(joined[a:b]) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64))


def fingerprint(found: np.ndarray) -> np.ndarray:
    """256 bits as four words: a bit is 1 if set in over half of the shingles' hashes, each mixed in four ways."""
    count = np.zeros(256, np.int64)
    for i in range(0, len(found), 4096):
        h = found[i : i + 4096, None] * _MUL
        h = (h ^ (h >> np.uint64(32))) * _MUL[::-1]
        h ^= h >> np.uint64(29)
        count += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * count > len(found)).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """docs with node (names the set of shingles), n (their number) and the words of the fingerprint; without words: node 0."""
    @F.pandas_udf("node long, n long, f0 long, f1 long, f2 long, f3 long")
    def sign(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        node, n, words = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.int64), np.zeros((len(texts), 4), np.int64)
        for i, t in enumerate(texts):
            s = shingles(t, size)
            n[i] = len(s)
            if len(s):
                node[i] = xxhash.xxh64_intdigest(s.tobytes())
                words[i] = fingerprint(s)
        return pd.DataFrame({"node": node.view(np.int64), "n": n} | {w: words[:, i] for i, w in enumerate(WORDS)})

    return docs.withColumn("_s", sign(F.col("text").cast("string"))).select(*docs.columns, "_s.*")


def _close(x: np.ndarray, y: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of x and of y [node, n, words] that lie within the radius and whose n allow the similarity."""
    p, q = x[:, 2:].copy().view(np.uint64), y[:, 2:].copy().view(np.uint64)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for i in range(0, len(x), 128):
        apart = np.bitwise_count(p[i : i + 128, :1] ^ q[:, 0]) + np.bitwise_count(p[i : i + 128, 1:2] ^ q[:, 1])
        j, k = np.nonzero(apart <= HALF)
        j += i
        keep = np.bitwise_count(p[j] ^ q[k]).sum(1, dtype=np.int64) <= RADIUS
        keep &= whole * np.minimum(x[j, 1], y[k, 1]) >= part * np.maximum(x[j, 1], y[k, 1])
        found.append((j[keep], k[keep]))
    j, k = (np.concatenate(c) for c in zip(*found, strict=True))
    return j, k


def _root(of: np.ndarray, nodes: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """The root of each of `of` in a forest of (nodes, roots), nodes ascending; those it doesn't have are their own."""
    if not len(nodes):
        return of
    at = np.minimum(np.searchsorted(nodes, of), len(nodes) - 1)
    return np.where(nodes[at] == of, roots[at], of)


def _near(part: int, whole: int, large: int):
    """Pairs (a, b) of two tiles' nodes within the radius; where a group has too many, links enough to join it, marked as dense.

    Two different tiles then link only what each doesn't join by itself, which the tile says when it meets itself.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for same, one, two in zip(f["same"], f["one"], f["two"], strict=True):
                x, y = (np.asarray(t, np.int64).reshape(-1, 6) for t in (one, two))
                j, k = _close(x, y, part, whole)
                if same:
                    j, k = j[x[j, 0] < y[k, 0]], k[x[j, 0] < y[k, 0]]
                a, b = x[j, 0], y[k, 0]
                nodes, roots = forest(a, b)
                group = _root(a, nodes, roots)
                names, members = np.unique(roots, return_counts=True)
                links = np.zeros(len(names), np.int64)
                np.add.at(links, np.searchsorted(names, group), 1)
                dense = (links > large * (members + 1))[np.searchsorted(names, group)]
                yield pd.DataFrame({"a": np.minimum(a, b)[~dense], "b": np.maximum(a, b)[~dense], "dense": False})
                if not dense.any():
                    continue
                a, b = a[dense], b[dense]
                if not same:
                    for t, rows in ((x, j), (y, k)):
                        own = t[np.unique(rows[dense])]
                        p, q = _close(own, own, part, whole)
                        held = forest(own[p, 0], own[q, 0])
                        a, b = _root(a, *held), _root(b, *held)
                a, b = forest(a, b)
                yield pd.DataFrame({"a": a, "b": b, "dense": True})

    return run


def candidates(signed: DataFrame, part: int, whole: int, tile: int = 4096) -> DataFrame:
    """(a, b, dense): pairs of nodes of signed(node, n, words) within the radius, and links that join groups with many.

    Nodes lie in cells by the logarithm of n, so that those of the similarity are in one cell or in two that follow.
    """
    base = 1.01 * whole / part
    own = signed.filter(f"{whole} * n >= {part} * (n + 1)")  # a smaller set is similar to itself alone
    nodes = store(own.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", *WORDS))).withColumn("cell", F.floor(F.log("n") / F.log(F.lit(base)))), "nodes")
    slots = nodes.groupBy("cell").agg(F.expr(f"int(ceil(count(*) / {tile}))").alias("slots"))
    slots = F.broadcast(store(slots, "slots"))  # a cell for each factor of 1.26 in n
    tiles = nodes.join(slots, "cell").withColumn("slot", F.expr("int(pmod(xxhash64(node), slots))"))
    tiles = store(tiles.groupBy("cell", "slot").agg(F.flatten(F.collect_list(F.array("node", "n", *WORDS))).alias("nodes")), "tiles")
    ask = tiles.select(F.col("cell").alias("from"), F.col("slot").alias("own"), F.explode(F.expr("array(0L, 1L)")).alias("by"), F.col("nodes").alias("one"))
    ask = ask.withColumn("cell", F.expr("`from` + by")).join(slots, "cell")
    ask = ask.select("cell", F.explode(F.expr("sequence(if(by = 0, own, 0), slots - 1)")).alias("slot"), "own", "by", "one")  # a row a pair of tiles
    pairs = ask.hint("merge").join(tiles.withColumnRenamed("nodes", "two"), ["cell", "slot"])
    pairs = pairs.select(F.expr("by = 0 and own = slot").alias("same"), "one", "two")
    return pairs.mapInPandas(_near(part, whole, LARGE), LINKS + ", dense boolean")


def verify(pairs: DataFrame, texts: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """Those of pairs(a, b) whose shingles in texts(node, text) have a similarity of part / whole or more."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for f in frames:
            keep = np.zeros(len(f), bool)
            for i, (a, x, y) in enumerate(zip(f["a"], f["x"], f["y"], strict=True)):
                if a != last:
                    last, held = a, shingles(x, size)
                other = shingles(y, size)
                both = len(np.intersect1d(held, other, assume_unique=True))
                keep[i] = whole * both >= part * (len(held) + len(other) - both)
            yield f.loc[keep, ["a", "b"]]

    with_y = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return with_y.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y").mapInPandas(run, LINKS)


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the sets, one of left and one of right each, that are similar."""
    n = np.array([len(s) for s in sets])
    names, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), n), held[column] > 1
    row, column = row[shared], (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        i, j = np.searchsorted(column, [lo, lo + 4096])
        has = np.zeros((len(sets), 4096), np.float32)
        has[row[i:j], column[i:j] - lo] = 1
        both += has[left] @ has[right].T
    p, q = np.nonzero(whole * both >= part * (n[left][:, None] + n[right][None, :] - both))
    return left[p], right[q]


def tiled(large: DataFrame, texts: DataFrame, size: int, part: int, whole: int, tile: int = 512) -> DataFrame:
    """(a, b): links enough to join all similar nodes of those that large(lead, node) connects; all of them are compared."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        one, two = f["one"].iloc[0], f["two"].iloc[0]
        left, right = (np.flatnonzero(f["slot"] == x) for x in (one, two))
        a, b = _similar([shingles(t, size) for t in f["text"]], left, right, part, whole)
        node = f["node"].to_numpy(np.int64)
        a, b = forest(node[a], node[b]) if len(a) else (node[:0], node[:0])
        return pd.DataFrame({"a": a, "b": b})

    comp = components(large.select(F.col("lead").alias("a"), F.col("node").alias("b")))
    slots = comp.groupBy("component").agg(F.expr(f"int(ceil(count(*) / {tile}))").alias("slots"))
    dealt = comp.join(slots, "component").withColumn("slot", F.expr("int(pmod(xxhash64(node), slots))")).join(texts, "node")
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, slots - 1)")))
    pairs = dealt.select("component", "node", "text", "slot", F.least("slot", "other").alias("one"), F.greatest("slot", "other").alias("two"))
    return pairs.groupBy("component", "one", "two").applyInPandas(run, LINKS)


def link(signed: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """(a, b): verified links between nodes of signed(node, n, words, text), enough to join all candidates that are similar."""
    cand = store(candidates(signed, part, whole), "candidates").filter("a <> b")
    member = cand.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = store(signed.select("node", "text").join(member, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "texts")

    # groups in which a tile has many candidates a node are compared whole
    comp = store(components(cand.select("a", "b")), "groups")
    dense = comp.join(cand.filter("dense").select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("component").distinct()
    large = store(tiled(comp.join(dense, "component", "left_semi").select(F.col("component").alias("lead"), "node"), texts, size, part, whole), "large")
    cand = cand.join(comp.join(dense, "component", "left_anti").select(F.col("node").alias("a")), "a", "left_semi").select("a", "b").distinct()

    ask = store(cand.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "asked")
    links = store(large.unionByName(verify(ask, texts, size, part, whole)), "verified")

    # candidates that aren't in one component by now
    comp = components(links)
    at = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"{c}c"))
    rest = cand.join(at("a"), "a", "left").join(at("b"), "b", "left").filter("coalesce(ac, a) <> coalesce(bc, b)").select("a", "b")
    rest = store(rest.join(ask, ["a", "b"], "left_anti"), "rest")
    return links.unionByName(verify(rest, texts, size, part, whole))


def near_duplicates(docs: DataFrame, size: int = 5, part: int = 4, whole: int = 5) -> DataFrame:
    """doc_id, node and component_id (smallest doc_id reachable over links) of each row of docs.

    A link joins texts whose sets of shingles of size words have a Jaccard similarity of part / whole or more. Texts
    without words are one node and have no links. A null doc_id keeps its row and never names a component unless the
    whole component has none. Repeated rows repeat in the result. An empty table gives an empty result.
    """
    signed = store(signatures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), size), "signed")
    least = signed.groupBy("node").agg(F.min("doc_id").alias("least"))
    comp = components(link(signed, size, part, whole))
    by = store(least.join(comp, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")), "classes")
    name = by.groupBy("component").agg(F.min("least").alias("component_id"))
    return signed.select("doc_id", "node").join(by.join(name, "component").select("node", "component_id"), "node")
