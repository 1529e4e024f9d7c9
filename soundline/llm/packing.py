"""Best-fit packing by hierarchical residuals.

Pieces are dealt evenly into groups; each group packs its own by best-fit decreasing and closes the bins that are
nearly full. The least loaded of the others go up a tree of groups as items of their own and are packed again, until
one group is left. Bins stay whole, so each round moves only what is underfull.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .tokens import portions, shared

BIN = "done boolean, load int, uids array<long>, lengths array<int>"


def best_fit(loads: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items in falling order, each into the fullest bin that still takes it."""
    free: dict[int, list[int]] = {}
    mask, bins = 0, []  # bit r of mask: some bin has r free
    for i in sorted(range(len(loads)), key=lambda i: -loads[i]):
        fits = mask >> loads[i]
        if fits:
            room = loads[i] + (fits & -fits).bit_length() - 1
            k = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        room -= loads[i]
        if room:
            free.setdefault(room, []).append(k)
            mask |= 1 << room
    return bins


def _packer(capacity: int, slack: int, carry: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        loads = group["load"].tolist()
        uids, lengths = group["uids"].tolist(), group["lengths"].tolist()
        bins = best_fit(loads, capacity)
        total = [sum(loads[i] for i in b) for b in bins]
        under = sorted((k for k in range(len(bins)) if capacity - total[k] > slack), key=lambda k: (total[k], k))
        least = total[under[0]] if under else 0
        # a bin goes up if it may take or join another: the least loaded ones, carry of them at most
        up = {k for k in under[:carry] if capacity - total[k] >= min(least, slack * 8)}
        return pd.DataFrame({
            "done": [k not in up for k in range(len(bins))],
            "load": total,
            "uids": [np.concatenate([uids[i] for i in b]) for b in bins],
            "lengths": [np.concatenate([lengths[i] for i in b]) for b in bins],
        })

    return run


def pack(pieces: DataFrame, capacity: int = 2048, group: int = 20_000, fan_in: int = 8, slack: int = 16) -> DataFrame:
    """(uid, sequence_id, offset) for each row of pieces(uid, length): uid unique, 1 <= length <= capacity.

    A sequence's pieces lie one after another from offset 0 and fill capacity at most. sequence_id is the uid of its
    first piece. Bins that no round can fill further stay as they are: no piece is dropped. A group sends up at most
    group / fan_in bins, the least loaded; fuller ones close. An empty table gives an empty result.
    """
    full = pieces.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bins = pieces.filter(F.col("length") < capacity).select(F.lit(False).alias("done"), F.col("length").cast("int").alias("load"), F.array("uid").alias("uids"), F.array(F.col("length").cast("int")).alias("lengths"))
    n, closed = pieces.count(), None
    groups = max(1, -(-n // group))
    while True:
        key = F.pmod(F.xxhash64(F.element_at("uids", 1), F.lit(groups)), F.lit(groups))
        packed = store(bins.groupBy(key.alias("g")).applyInPandas(_packer(capacity, slack, group // fan_in if groups > 1 else 0), BIN), "bins")
        own = packed.filter("done")
        closed = own if closed is None else closed.union(own)
        if groups == 1:
            break
        bins, groups = packed.filter("not done"), max(1, groups // fan_in)
    at = F.expr("transform(uids, (u, i) -> struct(u as uid, aggregate(slice(lengths, 1, i), 0L, (a, x) -> a + x) as offset))")
    placed = closed.select(F.element_at("uids", 1).alias("sequence_id"), F.explode(at).alias("p")).select("p.uid", "sequence_id", "p.offset")
    return full.unionByName(placed)


def pieces_of(docs: DataFrame, path: str, kind: str = "words", capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, most: int = 200_000, most_chars: int = 1_000_000) -> DataFrame:
    """uid, doc_id, piece, start, length, ids (little-endian unsigned 32-bit) and their crc32 of every text's pieces.

    A text is its ids, then end_id. Only longer ones are cut, into pieces of capacity; the last may be shorter. A null
    or empty text is end_id alone. Rows stay apart whatever their doc_id. Without keep_ids the ids are left out. A worker
    remembers twice `most` chunks and encodes most_chars characters at a time: more of both takes memory and saves time.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uid = TaskContext.get().partitionId() << 40
        with shared(path, kind, most) as chunked:
            for f in frames:
                texts = [t if isinstance(t, str) else None for t in f["text"]]
                for a, b in portions(texts, most_chars):
                    rows = []
                    for doc, ids in zip(f["doc_id"].iloc[a:b], chunked.encode(texts[a:b]), strict=True):
                        raw = ids.tobytes() + np.array([end_id], "<u4").tobytes()
                        for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                            part = raw[at : at + 4 * capacity]
                            rows.append((uid, None if pd.isna(doc) else int(doc), i, at // 4, len(part) // 4, part if keep_ids else None, zlib.crc32(part)))
                            uid += 1
                    out = pd.DataFrame(rows, columns=["uid", "doc_id", "piece", "start", "length", "ids", "ids_crc32"])
                    out["doc_id"] = out["doc_id"].astype("Int64")
                    yield out

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(run, "uid long, doc_id long, piece int, start long, length long, ids binary, ids_crc32 long")


def pack_texts(docs: DataFrame, path: str, kind: str = "words", capacity: int = 2048, end_id: int = 0, keep_ids: bool = False, most: int = 200_000, most_chars: int = 1_000_000) -> DataFrame:
    """pieces_of with the sequence_id and offset of each piece; columns but doc_id and text are not read.

    Repeated rows, null ids and null texts each give pieces of their own; very long texts give as many as they need; an
    empty table gives an empty result.
    """
    pieces = store(pieces_of(docs, path, kind, capacity, end_id, keep_ids, most, most_chars), "pieces")
    return pieces.join(pack(pieces.select("uid", "length"), capacity), "uid").drop("uid", *([] if keep_ids else ["ids"]))


def op5_best_fit(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers as P

    return pack_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("word_bpe_49k.json"), most=600_000, most_chars=3_000_000)
