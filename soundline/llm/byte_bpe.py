"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Every text is split into pre-tokens. A block of texts keeps its pre-tokens as positions in a word list of its own
and ships each distinct word of that list, once, to the bucket that the word hashes to. A bucket encodes each
distinct word of the whole corpus once and sends the ids back to the blocks, which put the ids together by position.
A word occurs once a block however often it is used, so frequent words make no hot key.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

ENCODED = "doc_id long, n_tokens long, ids binary"
_ROW = "block string, bucket int, body binary"


@lru_cache(1)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(1)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes in a row, each token's start, each token's length."""
    with open(path, "rb") as f:
        by_id = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that read runs of the given starts and lengths one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([len(arrays), *(x for a in arrays for x in (a.nbytes, a.itemsize))], np.int64).tobytes()
    planes = [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]  # bytes of like weight together
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(body: bytes, kinds: tuple) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head, at, out = np.frombuffer(raw, np.int64, 2 * n, 8), 8 * (1 + 2 * n), []
    for size, item, kind in zip(head[::2], head[1::2], kinds, strict=True):
        plane = np.frombuffer(raw, np.uint8, int(size), at).reshape(int(item), -1)
        out.append(np.ascontiguousarray(plane.T).reshape(-1).view(kind))
        at += int(size)
    return out


def _blocks(frames: Iterator[pd.DataFrame], pattern: str, block_chars: int):
    """(name, doc_ids, null flags, words a text, words' numbers, word list) of each block of texts of a partition."""
    import regex

    split = regex.compile(pattern).findall
    part, k = TaskContext.get().partitionId(), 0
    docs, counts, numbers, words, chars = [], [], [], _Numbers(), 0

    def block():
        return f"{part}.{k}", docs, np.array(counts, np.int64), np.array(numbers, np.uint32), list(words)

    for f in frames:
        for doc, text in zip(f["doc_id"], f["text"], strict=True):
            found = split(text) if isinstance(text, str) else []
            docs.append(None if pd.isna(doc) else int(doc))
            counts.append(len(found))
            numbers.extend(map(words.__getitem__, found))
            chars += len(text) if isinstance(text, str) else 0
            if chars >= block_chars:
                yield block()
                k += 1
                docs, counts, numbers, words, chars = [], [], [], _Numbers(), 0
    if docs:
        yield block()


def encode(docs: DataFrame, path: str, pattern: str, block_chars: int = 3_000_000, buckets: int | None = None, bucket_chars: int = 8_000_000) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit, one after another) of each row of docs(doc_id, text).

    A null or empty text has no ids. Rows stay as they are: repeated ids, null ids and repeated texts each give
    a row. docs must give the same rows in the same partitions when it is read twice, as tables do. Words that
    more than one block uses are encoded once. A block of texts closes at block_chars; one longer text is a block. There
    is a bucket for bucket_chars of text, so that the words in one stay as many however large docs is. An empty table
    gives an empty result; columns but doc_id and text are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = buckets or max(8, -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // bucket_chars))

    def out_words(frames):
        for name, _, _, _, words in _blocks(frames, pattern, block_chars):
            raw = [w.encode("utf-8", "surrogatepass") for w in words]
            bucket = np.fromiter((zlib.crc32(w) % n for w in raw), np.int64, len(raw))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[b] : cuts[b + 1]]
                texts = [raw[i] for i in own]
                rows.append((name, int(b), _pack(own.astype(np.uint32), np.fromiter(map(len, texts), np.uint32, len(texts)), np.frombuffer(b"".join(texts), np.uint8))))
            yield pd.DataFrame(rows, columns=["block", "bucket", "body"])
        release()

    def out_positions(frames):
        for name, ids, counts, numbers, words in _blocks(frames, pattern, block_chars):
            null = np.array([i is None for i in ids], np.uint8)
            body = _pack(np.array([i or 0 for i in ids], np.int64), null, counts, numbers, np.array([len(words)], np.int64))
            yield pd.DataFrame({"block": [name], "bucket": [-1], "body": [body]})
        release()

    def encode_bucket(group: pd.DataFrame) -> pd.DataFrame:
        enc, known, rows = _encoding(path, pattern), {}, []
        for name, body in zip(group["block"], group["body"], strict=True):
            own, sizes, raw = _unpack(body, (np.uint32, np.uint32, np.uint8))
            raw, ends, ids = raw.tobytes(), np.cumsum(sizes, dtype=np.int64), []
            for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                if (got := known.get(w := raw[a:b])) is None:
                    known[w] = got = np.array(enc.encode_ordinary(w.decode("utf-8", "surrogatepass")), np.uint32)
                ids.append(got)
            rows.append((name, -2, _pack(own, np.fromiter(map(len, ids), np.uint32, len(ids)), np.concatenate(ids))))
        return pd.DataFrame(rows, columns=["block", "bucket", "body"])

    def reassemble(group: pd.DataFrame) -> pd.DataFrame:
        (body,) = group.loc[group["bucket"] == -1, "body"]
        doc, null, counts, numbers, (n_words,) = _unpack(body, (np.int64, np.uint8, np.int64, np.uint32, np.int64))
        size, at, flat, base = np.full(n_words, -1, np.int64), np.zeros(n_words, np.int64), [], 0
        for body in group.loc[group["bucket"] == -2, "body"]:
            own, sizes, ids = _unpack(body, (np.uint32, np.uint32, np.uint32))
            size[own], at[own] = sizes, base + np.cumsum(sizes, dtype=np.int64) - sizes
            flat.append(ids)
            base += len(ids)
        if n_words and size.min() < 0:
            raise RuntimeError("the texts were read in other blocks the second time; store the table first")
        ids = np.concatenate(flat)[gather(at[numbers], size[numbers])] if flat else np.empty(0, np.uint32)
        ends = np.concatenate([[0], np.cumsum(size[numbers])])[np.concatenate([[0], np.cumsum(counts)])] if n_words else np.zeros(len(doc) + 1, np.int64)
        raw = ids.astype("<u4").tobytes()
        return pd.DataFrame({
            "doc_id": pd.array(np.where(null, 0, doc), "Int64") if not null.any() else pd.array([None if z else int(d) for d, z in zip(doc, null, strict=True)], "Int64"),
            "n_tokens": np.diff(ends),
            "ids": [raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)],
        })

    # partitions by their number, not by the session's setting: tasks stay as large however large docs is
    words = docs.mapInPandas(out_words, _ROW).repartition(2 * n, "bucket").groupBy("bucket").applyInPandas(encode_bucket, _ROW)
    return docs.mapInPandas(out_positions, _ROW).unionByName(words).repartition(2 * n, "block").groupBy("block").applyInPandas(reassemble, ENCODED)


def decode(encoded: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """encoded with the bytes of its ids as a further column, joined in the task from the token-byte table.

    The table has one row a vocabulary entry, so its size is fixed by the tokenizer. Null ids give null; no ids, no bytes.
    """
    def run(raw: pd.Series) -> pd.Series:
        table, start, length = _token_bytes(path)
        out = []
        for one in raw:
            x = np.frombuffer(one, "<u4") if one is not None else None
            out.append(None if x is None else table[gather(start[x], length[x])].tobytes())
        return pd.Series(out, dtype=object)

    return encoded.withColumn(to, F.pandas_udf(run, "binary")(ids))


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents and the bytes that they decode to, as counts and digests."""
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, P.PATTERN), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
