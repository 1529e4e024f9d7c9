"""Token-id files coded by an adaptive context-mixing range coder.

A segment holds the ids of consecutive texts in blocks of BLOCK ids; the last block may be shorter. Every block starts
from a fresh model and carries a checksum, so each can be read alone. The model predicts the next id three ways: what
followed the last two ids (order 2), what followed the last one (order 1), and the frequencies of all ids of the block
so far (order 0), counted anew each time that the block has grown by an eighth. Which of the three is right is a symbol of
its own; its frequencies are a mixture of counts by the confidence of the order-2 prediction, by that of the order-1
prediction and by both. An id that none holds is spelt: its number of bits by adaptive frequencies, then its bits.
All blocks of a segment are coded in step, as lanes of numpy arrays.

Segment: magic, counts of texts, ids, blocks and ids a block; doc_ids, null marks and id counts, and their crc32; each
block's length and crc32; blocks. Segments are rows of a table that Spark writes, in order of shard and segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, store
from .tokens import portions, shared

MAGIC = b"SLTK\x02\0\0\0"
HEAD = struct.Struct("<8sqqqq")
LANES, BLOCK = 1024, 4096  # blocks coded in step; ids a block
_T1, _T2 = 10, 11  # log2 of the tables' sizes
_SCALE, _ZERO = 11, 14  # log2 of the sums of frequencies: of symbols, and of ids or classes within a symbol
_TOTAL = _SCALE + _ZERO
_CHUNK, _GROW, _LIMIT = 64, 8, 4096  # steps between mixtures; order 0 is counted at growth by 1 / _GROW; counts are halved at the limit
U = np.uint64
_PRIOR = np.array([[1, 1, 4, 12]] + [[2 * k, 2 * k, 4, 4] for k in range(1, 8)], np.int64)


def _bounds(counts: np.ndarray, scale: int, least: int) -> np.ndarray:
    """Lower bounds of the symbols along the last axis, and 2**scale: every symbol gets `least` at least."""
    n = counts.shape[-1]
    up = np.cumsum(counts, -1).astype(float)
    room = float((1 << scale) - least * n)
    out = np.zeros((*counts.shape[:-1], n + 1), np.int64)
    out[..., 1:] = np.floor(up * (room / up[..., -1:])).astype(np.int64) + least * np.arange(1, n + 1)
    out[..., -1] = 1 << scale
    return out


def _bits(ids: np.ndarray) -> np.ndarray:
    """Numbers of bits, 0 for 0."""
    return np.frexp(ids.astype(float))[1].astype(np.int64)


class _Model:
    """Predictions and frequencies of all lanes. A table entry is an id and, in the lowest three bits, its confidence."""

    def __init__(self, lanes: int):
        self.lanes, self.lane, self.at, self.fresh = lanes, np.arange(lanes), 0, 0
        self.t1, self.t2 = np.zeros(lanes << _T1, U), np.zeros(lanes << _T2, U)
        self.base1, self.base2, self.base = self.lane.astype(U) << U(_T1), self.lane.astype(U) << U(_T2), self.lane.astype(U) << U(6)
        self.f1, self.f2 = (np.tile(_PRIOR, (lanes, 1, 1)) for _ in range(2))
        self.f12 = np.ones((lanes, 64, 4), np.int64)
        self.classes = np.ones((lanes, 33), np.int64)
        self.m, self.m2 = np.zeros(lanes, U), np.zeros(lanes, U)
        self.seen: list[np.ndarray] = []  # ids that the order-0 frequencies don't hold yet
        self.keys, self.counts = np.empty(0, U), np.empty(0, np.int64)
        self.low = self.high = self.keys
        self.mix()

    def mix(self) -> None:
        mixed = 4 * self.f12.reshape(self.lanes, 8, 8, 4) + self.f2[:, :, None] + self.f1[:, None]
        self.ends = _bounds(mixed, _SCALE, 2).reshape(-1, 5).astype(U)
        self.class_ends = _bounds(self.classes, _ZERO, 4).astype(U)

    def count(self, slots: bool) -> None:
        """Order-0 frequencies of each lane anew, from the counts so far: they add up to 2**_ZERO in every lane."""
        own, n = np.unique(((self.lane.astype(U) << U(32)) | np.concatenate(self.seen)).ravel(), return_counts=True)
        keys = np.concatenate([self.keys, own])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([self.counts, n])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts, self.seen = keys[first], np.add.reduceat(counts, first), []
        lane = (self.keys >> U(32)).astype(np.int64)
        start = np.searchsorted(lane, self.lane)
        up = np.concatenate([[0], np.cumsum(self.counts)])
        base, total = up[start][lane], np.add.reduceat(self.counts, start)[lane]
        room = (1 << _ZERO) - np.bincount(lane, minlength=self.lanes)[lane]  # a slot for every id of the lane; the rest by counts
        rank = np.arange(len(lane)) - start[lane]
        low, high = (up[:-1] - base) * room // total + rank, (up[1:] - base) * room // total + rank + 1
        self.low, self.high = low.astype(U), high.astype(U)
        if slots:
            self.start, self.slots = start, np.repeat(rank.astype(np.uint16), high - low)  # at most 2**_ZERO ids a lane

    def learn(self, x: np.ndarray, symbol: np.ndarray, ids: np.ndarray, slots: bool) -> None:
        """At the end of a chunk: counts of symbols and classes; order-0 frequencies when the block has grown enough."""
        n = np.bincount((x.astype(np.int64) * 4 + symbol).ravel(), minlength=self.lanes * 256).reshape(self.lanes, 8, 8, 4)
        for f, own in ((self.f12, n.reshape(self.lanes, 64, 4)), (self.f2, n.sum(2)), (self.f1, n.sum(1))):
            f += own
            if f.max() > _LIMIT // 4:
                f[...] = np.where(f.sum(-1, keepdims=True) > _LIMIT, (f + 1) >> 1, f)
        step, lane = np.nonzero(symbol == 3)
        self.classes += 4 * np.bincount(lane * 33 + _bits(ids[step, lane]), minlength=33 * self.lanes).reshape(self.lanes, 33)
        self.seen.append(ids.astype(U))
        self.at += len(ids)
        if self.at - self.fresh >= self.fresh // _GROW:
            self.fresh = self.at
            self.count(slots)
        self.mix()

    def predict(self) -> np.ndarray:
        """Contexts of the mixture; p1 and p2 are the predictions."""
        self.h1 = self.base1 + (self.m >> U(64 - _T1))
        self.h2 = self.base2 + (((self.m ^ self.m2) * U(0xD6E8FEB86659FD93)) >> U(64 - _T2))
        self.v1, self.v2 = self.t1[self.h1], self.t2[self.h2]
        self.k1, self.k2 = self.v1 & U(7), self.v2 & U(7)
        self.p1, self.p2 = self.v1 >> U(3), self.v2 >> U(3)
        return self.base + (self.k2 << U(3)) + self.k1

    def update(self, ids: np.ndarray) -> None:
        new = ids << U(3)
        for table, h, v, p, k in ((self.t1, self.h1, self.v1, self.p1, self.k1), (self.t2, self.h2, self.v2, self.p2, self.k2)):
            table[h] = np.where(ids == p, v + (k < U(7)), np.where(k > U(1), v - k + (k >> U(1)), new))
        self.m2 = self.m * U(0xBF58476D1CE4E5B9)
        self.m = (ids + U(1)) * U(0x9E3779B97F4A7C15)

    def held(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the order-0 keys, whether it is there) of ids [steps, lanes]."""
        if not len(self.keys):
            return np.zeros(ids.shape, np.int64), np.zeros(ids.shape, bool)
        key = (self.lane.astype(U) << U(32)) | ids
        at = np.minimum(np.searchsorted(self.keys, key.T.ravel()), len(self.keys) - 1).reshape(key.T.shape).T  # lane by lane: near each other
        return at, self.keys[at] == key


def _chunks(steps: int):
    """(from, to): chunks that grow to _CHUNK steps."""
    at, size = 0, 16
    while at < steps:
        yield at, min(steps, at + size)
        at, size = at + size, min(_CHUNK, size * 2)


def encode_lanes(ids: np.ndarray) -> list[bytes]:
    """ids: [steps, lanes], unsigned below 2**32, to one payload a lane."""
    steps, lanes = ids.shape
    m = _Model(lanes)
    low, width = np.zeros(lanes, U), np.full(lanes, (1 << 48) - 1, U)
    out, size = np.zeros((steps + 64, lanes), np.uint32), np.zeros(lanes, np.int64)
    mask, b16, b32, total = U(0xFFFFFFFF), U(16), U(32), U(_TOTAL)

    def shift():
        thin = np.flatnonzero(width < U(1 << 32))
        rest = low[thin]
        out[size[thin], thin] = rest >> b32  # bit 16 is a carry, added to the digit before at the end
        size[thin] += 1
        low[thin] = (rest & mask) << b16
        width[thin] <<= b16

    for a, b in _chunks(steps):
        now = ids[a:b].astype(U)
        x, p1, p2 = (np.empty(now.shape, U) for _ in range(3))
        for i, row in enumerate(now):
            x[i] = m.predict()
            p1[i], p2[i] = m.p1, m.p2
            m.update(row)
        place, there = m.held(now)
        symbol = np.where(there, 2, 3)
        symbol[now == p1] = 1
        symbol[now == p2] = 0
        start, end = m.ends[x, symbol], m.ends[x, symbol + 1]
        first, part = start << U(_ZERO), end - start
        share = part << U(_ZERO)
        at = symbol == 2
        first[at] += part[at] * m.low[place[at]]
        share[at] = part[at] * (m.high[place[at]] - m.low[place[at]])
        step, lane = np.nonzero(symbol == 3)
        kind = _bits(now[step, lane])
        first[step, lane] += part[step, lane] * m.class_ends[lane, kind]
        share[step, lane] = part[step, lane] * (m.class_ends[lane, kind + 1] - m.class_ends[lane, kind])
        more = np.maximum(kind - 1, 0)
        rest = now[step, lane] & ((U(1) << more.astype(U)) - U(1))
        cuts = np.searchsorted(step, np.arange(b - a + 1))
        for i in range(b - a):
            own = width >> total
            np.add(low, own * first[i], out=low)
            np.multiply(own, share[i], out=width)
            shift()
            if cuts[i] < cuts[i + 1]:
                spelt = slice(cuts[i], cuts[i + 1])
                k, bits, value = lane[spelt], more[spelt], rest[spelt]
                for by in (b16, U(0)):  # 16 bits at most go into one interval
                    n = np.clip(bits - int(by), 0, 16).astype(U)
                    if n.any():
                        own = width[k] >> n
                        low[k] += own * ((value >> by) & ((U(1) << n) - U(1)))
                        width[k] = own
                        shift()
            if size.max() + 8 > len(out):
                out = np.concatenate([out, np.zeros((steps // 2 + 64, lanes), np.uint32)])
        m.learn(x, symbol, now, False)
    for k in (32, 16, 0):
        out[size, m.lane] = (low >> U(k)) & U(0x1FFFF if k == 32 else 0xFFFF)
        size += 1
    payloads = []
    for lane in range(lanes):
        d = out[: size[lane], lane].astype(np.int64)
        while len(at := np.flatnonzero(d > 0xFFFF)):
            d[at] -= 0x10000
            d[at - 1] += 1
        payloads.append(d.astype("<u2").tobytes())
    return payloads


def decode_lanes(payloads: list[bytes], steps: int) -> np.ndarray:
    """The ids, [steps, lanes], of payloads that encode_lanes made."""
    lanes = len(payloads)
    m = _Model(lanes)
    digits = np.zeros((max(map(len, payloads), default=0) // 2 + 16, lanes), np.uint16)
    for lane, p in enumerate(payloads):
        digits[: len(p) // 2, lane] = np.frombuffer(p, "<u2")
    value = (digits[0].astype(U) << U(32)) | (digits[1].astype(U) << U(16)) | digits[2].astype(U)
    width, size, out = np.full(lanes, (1 << 48) - 1, U), np.full(lanes, 3), np.zeros((steps, lanes), np.uint32)
    zero, total, b16 = U(_ZERO), U(_TOTAL), U(16)

    def shift():
        thin = np.flatnonzero(width < U(1 << 32))
        value[thin] = (value[thin] << b16) | digits[size[thin], thin]
        size[thin] += 1
        width[thin] <<= b16

    for a, b in _chunks(steps):
        x, now = (np.empty((b - a, lanes), U) for _ in range(2))
        symbols = np.empty((b - a, lanes), np.int64)
        for i in range(b - a):
            x[i] = context = m.predict()
            ends = m.ends[context]
            part = width >> total
            point = value // part
            symbol = (point[:, None] >> zero >= ends[:, 1:4]).sum(1)
            start = ends[m.lane, symbol]
            share = ends[m.lane, symbol + 1] - start
            first, whole = start << zero, share << zero
            own = np.where(symbol == 0, m.p2, m.p1)
            if len(at := np.flatnonzero(symbol == 2)):
                slot = (point[at] - first[at]) // share[at]
                place = m.start[at] + m.slots[(at << _ZERO) + slot.astype(np.int64)]
                own[at] = m.keys[place] & U(0xFFFFFFFF)
                first[at] += share[at] * m.low[place]
                whole[at] = share[at] * (m.high[place] - m.low[place])
            if len(spelt := np.flatnonzero(symbol == 3)):
                slot = (point[spelt] - first[spelt]) // share[spelt]
                own_ends, row = m.class_ends[spelt], np.arange(len(spelt))
                kind = (slot[:, None] >= own_ends[:, 1:-1]).sum(1)
                first[spelt] += share[spelt] * own_ends[row, kind]
                whole[spelt] = share[spelt] * (own_ends[row, kind + 1] - own_ends[row, kind])
            value -= part * first
            np.multiply(part, whole, out=width)
            shift()
            if len(spelt):
                bits = np.maximum(kind - 1, 0)
                found = np.where(kind > 0, U(1) << bits.astype(U), U(0))
                for by in (16, 0):
                    n = np.clip(bits - by, 0, 16).astype(U)
                    if n.any():
                        piece = width[spelt] >> n
                        got = np.minimum(value[spelt] // piece, (U(1) << n) - U(1))
                        value[spelt] -= piece * got
                        width[spelt] = piece
                        found |= got << U(by)
                        shift()
                own[spelt] = found
            m.update(own)
            now[i], symbols[i] = own, symbol
        m.learn(x, symbols, now, True)
        out[a:b] = now
    return out


def write_segment(doc_ids: list, texts: list[np.ndarray]) -> bytes:
    """One segment of the texts' ids, in the order given. doc_ids may hold nulls."""
    ids = np.concatenate(texts).astype(np.uint32) if texts else np.empty(0, np.uint32)
    blocks = -(-len(ids) // BLOCK)
    steps = min(BLOCK, len(ids))  # a single short block
    head = HEAD.pack(MAGIC, len(texts), len(ids), blocks, steps)
    index = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes() + np.array([len(t) for t in texts], "<i8").tobytes()
    payloads = []
    for i in range(0, blocks, LANES):
        own = ids[i * BLOCK : (i + LANES) * BLOCK]
        k = -(-len(own) // steps)
        lanes = np.zeros(k * steps, np.uint32)
        lanes[: len(own)] = own
        payloads += encode_lanes(np.ascontiguousarray(lanes.reshape(k, steps).T))
    sums = [zlib.crc32(p) for p in payloads]
    table = np.array([x for p, s in zip(payloads, sums, strict=True) for x in (len(p), s)], "<u4").tobytes()
    return head + index + struct.pack("<I", zlib.crc32(head + index + table)) + table + b"".join(payloads)


def read_segment(body: bytes) -> tuple[list, Iterator[np.ndarray]]:
    """(doc_ids, ids of one text after another) of a segment; ValueError if a checksum or a length is wrong.

    Blocks are decoded in groups of LANES as the texts are asked for.
    """
    if len(body) < HEAD.size:
        raise ValueError("the segment is cut short")
    magic, docs, n, blocks, steps = HEAD.unpack_from(body)
    at = HEAD.size + 17 * docs
    if magic != MAGIC:
        raise ValueError("not a token segment")
    if docs < 0 or blocks < 0 or len(body) < at + 4 + 8 * blocks:
        raise ValueError("the segment is cut short")
    if struct.unpack_from("<I", body, at)[0] != zlib.crc32(body[:at] + body[at + 4 : at + 4 + 8 * blocks]):
        raise ValueError("the head is damaged")
    ids, null, counts = np.frombuffer(body, "<i8", docs, HEAD.size), np.frombuffer(body, np.uint8, docs, HEAD.size + 8 * docs), np.frombuffer(body, "<i8", docs, HEAD.size + 9 * docs)
    table, at = np.frombuffer(body, "<u4", 2 * blocks, at + 4).reshape(-1, 2).tolist(), at + 4 + 8 * blocks
    payloads = []
    for i, (size, crc) in enumerate(table):
        payloads.append(body[at : at + size])
        at += size
        if zlib.crc32(payloads[-1]) != crc:
            raise ValueError(f"block {i} is damaged")

    def texts():
        held, left = np.empty(0, np.uint32), n
        groups = (decode_lanes(payloads[i : i + LANES], steps).T.ravel() for i in range(0, blocks, LANES))
        for size in counts.tolist():
            while len(held) < size:
                held = np.concatenate([held, next(groups)[:left]])
            yield held[:size]
            held, left = held[size:], left - size

    return [None if z else d for d, z in zip(ids.tolist(), null.tolist(), strict=True)], texts()


def write(docs: DataFrame, path: str, kind: str = "spaces", end_id: int = 0, shards: int | None = None, segment_ids: int = LANES * BLOCK, shard_chars: int = 32_000_000) -> DataFrame:
    """The table of segments (shard, segment, start, n_ids, body) of docs(doc_id, text), ids ascending by doc_id.

    Each text is its ids, then end_id. Null ids come first; among equal ids the order is that of the texts' hashes, so
    that rows of one id, or without one, may fill many shards. Null and empty texts are end_id alone. Shards are ranges
    of (doc_id, hash), as many as the texts' characters make at shard_chars each. A segment closes at segment_ids; a
    longer text is a segment of its own. Repeated rows stay. An empty table gives no segments. Other columns are not
    read. start counts the ids before the segment in its shard.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if shards is None:
        shards = max(1, -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // shard_chars))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, k, start, held, doc_ids, texts = TaskContext.get().partitionId(), 0, 0, 0, [], []

        def row():
            return pd.DataFrame({"shard": [shard], "segment": [k], "start": [start], "n_ids": [held], "body": [write_segment(doc_ids, texts)]})

        with shared(path, kind) as chunked:
            for f in frames:
                own = [t if isinstance(t, str) else None for t in f["text"]]
                names = f["doc_id"].astype("Int64")
                for a, b in portions(own):
                    for doc, ids in zip(names.iloc[a:b], chunked.encode(own[a:b]), strict=True):
                        if texts and held + len(ids) + 1 > segment_ids:
                            yield row()
                            k, start, held, doc_ids, texts = k + 1, start + held, 0, [], []
                        doc_ids.append(None if doc is pd.NA else int(doc))
                        texts.append(np.append(ids, np.uint32(end_id)))
                        held += len(ids) + 1
            if texts:
                yield row()

    dealt = docs.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return store(dealt.mapInPandas(run, "shard int, segment int, start long, n_ids long, body binary"), "tokens")


def read(files: DataFrame, most: int = 1_000_000) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of each text in files, as write returns them.

    start counts the ids of all texts before it. The running sum is over shards, a row each. Up to most shards it is
    sent to all tasks; beyond, segments are joined with it by shard. A damaged segment raises ValueError.
    """
    n = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = n.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))  # a row a shard
    base = store(base, "shards")
    base = F.broadcast(base) if base.count() <= most else base

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at, body in zip(f["at"], f["body"], strict=True):
                doc_ids, texts = read_segment(body)
                rows, size, at = [], 0, int(at)
                for doc, ids in zip(doc_ids, texts, strict=True):
                    rows.append((doc, at, len(ids), ids.astype("<u4").tobytes()))
                    at, size = at + len(ids), size + len(ids)
                    if size > 1_000_000:
                        yield _rows(rows)
                        rows, size = [], 0
                yield _rows(rows)
        release()

    return files.join(base, "shard").select((F.col("base") + F.col("start")).alias("at"), "body").mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def _rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    """documents as token files, read back: place, size and crc32 of each text's ids."""
    import public_tokenizers as P

    files = write(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.json"))
    return read(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
