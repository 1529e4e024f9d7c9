"""Repeated passages by distributed prefix doubling over sampled positions.

A byte goes if a string of `length` bytes that covers it also starts anywhere else. Ranking every byte position in
rounds would move many times the input, so positions are sampled first: of every `WINDOW` consecutive 8-byte grams
the least by hash is a position, which depends on the text around it alone. Rounds at growing lengths then rank the
strings that start at positions still in question, drop the unique ones and pass on the rest:

1. the run of phrases between positions that fits into half the length (a necessary condition for any repeat),
2. the run that covers all strings of `length` that start before the next position (a sufficient one),
3. the single strings of `length` around the ends of repeats, and those of one representative of each longer repeat.

In each round a block of texts sends every distinct rank once to the bucket that the rank falls in; buckets sort what
they get, and answer one bit a rank. So a passage that a third of all texts share costs a row a block, not a text.
A rank is a 64-bit hash of an exact string, and a second hash with another base confirms that strings of equal rank are
equal: 80 bits have to agree before a byte goes.

Passages of a number of words go through the same rounds beside them: a text's words are hashed, their sequence takes
the place of the bytes, and of every WORD_WINDOW pairs of words the least by hash is a position. White space between
words doesn't count there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, store

U = np.uint64
GRAM, WINDOW = 8, 64
WORD_GRAM, WORD_WINDOW = 2, 10
FINAL = 1_000_000_000  # added to the buckets of the last round
_ROW = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("body", pa.binary())])
_ROW_SQL = "block string, bucket int, body binary"
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_CODES = np.random.default_rng(7).integers(1, 2**63, (2, 256), dtype=np.uint64)
_IN_WORD = np.ones(256, np.int8)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = 0
NO_RANKS = np.empty((0, 2), U)


def _mix(a: np.ndarray) -> np.ndarray:
    a = a ^ (a >> U(31))
    a *= U(0xBF58476D1CE4E5B9)
    a ^= a >> U(29)
    a *= U(0x94D049BB133111EB)
    a ^= a >> U(32)
    return a


@lru_cache(2)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, U), np.full(n, pow(base, -1, 2**64), U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sampled(grams: Callable[[int, int], np.ndarray], n: int, window: int) -> np.ndarray:
    """The last least one of every `window` consecutive of n grams; grams(a, b) are the hashes of those from a to b."""
    if n < window:
        return np.empty(0, np.int64)
    out, start = [], 0
    while start + window <= n:  # in stretches, so that positions fit into 20 bits
        a = grams(start, min(n, start + (1 << 19)))
        a = (a & ~U(0xFFFFF)) | (U(0xFFFFF) - np.arange(len(a), dtype=U))
        k = 1
        while 2 * k <= window:
            a = np.minimum(a[:-k], a[k:])
            k *= 2
        if k < window:
            a = np.minimum(a[: len(a) - (window - k)], a[window - k :])
        p = (U(0xFFFFF) - (a & U(0xFFFFF))).astype(np.int64)
        out.append(p[np.concatenate([[True], p[1:] != p[:-1]])] + start)
        start += len(p)
    return out[0] if len(out) == 1 else np.unique(np.concatenate(out))


def positions(x: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sampled positions of the bytes x: the last least gram of every `window` consecutive ones."""

    def grams(start, end):
        part = x[start : end + GRAM - 1].astype(U)
        a = part[:-1] | (part[1:] << U(8))
        a = a[:-2] | (a[2:] << U(16))
        return _mix(a[:-4] | (a[4:] << U(32)))

    return _sampled(grams, len(x) - GRAM + 1, window)


def _sums(codes: Iterable[np.ndarray], n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Running sums of a sequence's n codes times the powers of each base, and the inverse powers."""
    sums, downs = [], []
    for base, code in zip(_BASES, codes, strict=True):
        up, down = _powers(1 << max(17, (n + 1).bit_length()), base)
        total = np.zeros(n + 1, U)
        np.cumsum(code * up[:n], out=total[1:])
        sums.append(total)
        downs.append(down)
    return sums, downs


def _hashes(sums: tuple[list[np.ndarray], list[np.ndarray]], a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
    """For each base, the hashes of what lies from a to b."""
    size = np.asarray(b - a).astype(U) * U(0xD6E8FEB86659FD93)
    return (_mix((total[b] - total[a]) * down[a] + size) for total, down in zip(*sums, strict=True))


class _Runs:
    """Positions and ranks of one sequence of n items, for strings of `length` of them."""

    gram, window, salt = GRAM, WINDOW, U(0)

    def __init__(self, n: int, length: int, p: Callable[[], np.ndarray], codes: Callable[[], Iterable[np.ndarray]]):
        self.n, self.length, self.last = n, length, n - length  # last: of the starts of whole strings
        self.p = p = p() if self.last >= 0 else np.empty(0, np.int64)
        self.sums = None
        if not len(p):
            return
        self.sums = _sums(codes(), n)
        reach = length - self.gram - 3 * self.window + 3
        end = np.searchsorted(p, p + reach, side="right") - 1
        self.half_at = np.flatnonzero(end > np.arange(len(p)))
        self.half = self.rank(p[self.half_at], p[end[self.half_at]]) ^ U(0x5555)
        need = np.searchsorted(p, p[1:] - 1 + length, side="left")
        self.whole_at = np.flatnonzero(need < len(p))
        self.whole = self.rank(p[self.whole_at], p[need[self.whole_at]])

    def rank(self, a: np.ndarray, b) -> np.ndarray:
        """[string, (rank, confirming hash of 16 bits)] of the items from a to b."""
        rank, more = _hashes(self.sums, a, b)
        return np.stack([rank ^ self.salt, more >> U(48)], 1)

    def asked(self, half: np.ndarray, whole: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(covered, ends, shown): starts of strings known to repeat, of those to ask for, of those to show to others."""
        none = np.empty(0, np.int64)
        if not len(self.p):
            return none, none, none
        alive, repeated, mine = np.zeros(len(self.p), bool), np.zeros(len(self.p) + 1, bool), np.zeros(len(self.p) + 1, bool)
        alive[self.half_at] = half
        repeated[self.whole_at + 1], mine[self.whole_at + 1] = whole, whole & first
        if not alive.any():
            return none, none, none
        # positions up to each item: those up to a start, and up to the last one before the end of its window
        upto = np.repeat(np.arange(len(self.p) + 1), np.diff(self.p, prepend=0, append=self.n))
        q = upto[self.window - 2 : self.window - 1 + self.last]
        live = alive[np.minimum(q, len(self.p) - 1)] & (q < len(self.p))
        span = upto[: self.last + 1]
        known = repeated[span]
        return np.flatnonzero(known), np.flatnonzero(live & ~known), np.flatnonzero(known & mine[span])

    def strings(self, s: np.ndarray) -> np.ndarray:
        return self.rank(s, s + self.length) if len(s) else NO_RANKS

    def span(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes (from, to) of the strings that start at s."""
        return s, s + self.length


class _Text(_Runs):
    """The bytes of one text."""

    def __init__(self, raw: bytes, length: int):
        x = np.frombuffer(raw, np.uint8)
        super().__init__(len(x), length, lambda: positions(x), lambda: (code.take(x) for code in _CODES))


class _Words(_Runs):
    """The words of one text, by their hashes; its sums over bytes serve again where it has them."""

    gram, window, salt = WORD_GRAM, WORD_WINDOW, U(0x3C6EF372FE94F82B)

    def __init__(self, raw: bytes, length: int, text: _Text):
        x = np.frombuffer(raw, np.uint8)
        edge = np.flatnonzero(np.diff(_IN_WORD.take(x), prepend=0, append=0))
        self.starts, self.ends = edge[::2], edge[1::2]
        n = len(self.starts)
        words = list(_hashes(text.sums or _sums((code.take(x) for code in _CODES), len(x)), self.starts, self.ends)) if n >= length else []
        grams = lambda a, b: _mix(words[0][a:b] * U(_BASES[0]) + words[0][a + 1 : b + 1])
        super().__init__(n, length, lambda: _sampled(grams, n - WORD_GRAM + 1, WORD_WINDOW), lambda: words)

    def span(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[s], self.ends[s + self.length - 1]


def _sequences(texts: list[bytes], length: int, words: int | None) -> list[_Runs]:
    """The bytes of each text and, where asked for, its words after them."""
    found = []
    for raw in texts:
        found.append(_Text(raw, length))
        if words is not None:
            found.append(_Words(raw, words, found[-1]))
    return found


def _texts(table: pa.Table) -> list[bytes]:
    return [b"" if t is None else t for t in table["_text"].to_pylist()]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, pa.Table]]:
    part, k, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        lengths = np.array([len(t) if t is not None else 0 for t in batch.column("_text").to_pylist()], np.int64) if batch.num_rows else np.empty(0, np.int64)
        at = 0
        for i, n in enumerate(lengths.tolist()):
            size += n + 64
            if size >= block_bytes:
                held.append(batch.slice(at, i + 1 - at))
                yield f"{part}.{k}", pa.Table.from_batches(held)
                k, held, size, at = k + 1, [], 0, i + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield f"{part}.{k}", pa.Table.from_batches(held)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, _ROW.types, strict=True)], schema=_ROW)


def _distinct(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ranks in order; for each the place where it first occurs; each rank's place among them; their counts."""
    order = np.argsort(ranks[:, 0], kind="stable")
    own = ranks[order]
    new = np.concatenate([[True], own[1:, 0] != own[:-1, 0]])[: len(own)]
    if (~new[1:] & (own[1:, 1] != own[:-1, 1])).any():  # strings that differ share a rank
        order = np.lexsort((ranks[:, 1], ranks[:, 0]))
        own = ranks[order]
        new = np.concatenate([[True], (own[1:] != own[:-1]).any(1)])
    at = np.flatnonzero(new)
    inverse = np.empty(len(own), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return own[at], order[at], inverse, np.diff(np.append(at, len(own)))


def _dealt(own: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by bucket, where each bucket starts in it) of distinct ranks."""
    bucket = (own[:, 0] % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _send(name: str, ranks: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of the distinct ranks for their buckets, sorted."""
    own = _distinct(ranks)[0]
    order, cuts = _dealt(own, buckets)
    parts = ((int(b), own[order[cuts[b] : cuts[b + 1]]]) for b in np.flatnonzero(np.diff(cuts)))
    return [(name, b, p[:, 0].astype("<u8").tobytes() + p[:, 1].astype("<u2").tobytes()) for b, p in parts]


def _told(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each rank of the bodies that _send made: whether it is there twice, and whether it is the first such."""
    sizes = [len(b) // 10 for b in bodies]
    keys = np.concatenate([np.empty(0, U), *(np.frombuffer(b, "<u8", n) for b, n in zip(bodies, sizes, strict=True))])
    more = np.concatenate([np.empty(0, np.uint16), *(np.frombuffer(b, "<u2", n, 8 * n) for b, n in zip(bodies, sizes, strict=True))])
    order = np.argsort(keys, kind="stable")
    own, check = keys[order], more[order]
    same, agree = own[1:] == own[:-1], check[1:] == check[:-1]
    if (same & ~agree).any():  # strings that differ share a rank
        order = np.lexsort((more, keys))
        own, check = keys[order], more[order]
        same, agree = own[1:] == own[:-1], check[1:] == check[:-1]
    del own, check
    same &= agree
    shared, first = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    first[order[1:]] = ~same
    return shared, first


def _answers(table: pa.Table) -> pa.Table:
    names, bodies = table["block"].to_pylist(), table["body"].to_pylist()
    bucket = table["bucket"][0].as_py()
    turns = sorted(range(len(names)), key=names.__getitem__)
    shared, first = _told([bodies[i] for i in turns])
    out, at = [], 0
    for i in turns:
        n = len(bodies[i]) // 10
        out.append((names[i], -2 - bucket, np.packbits(np.concatenate([shared[at : at + n], first[at : at + n]])).tobytes()))
        at += n
    return pa.Table.from_batches([_rows(out)])


def _answer(table: pa.Table) -> pa.Table:
    """For each block's ranks: whether another block has the rank too, and whether this block is to represent it."""
    out = _answers(table)
    release()
    return out


def _read(ranks: np.ndarray, answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(repeated, represented here) for each of ranks, which _send sent."""
    if not len(ranks):
        return np.empty(0, bool), np.empty(0, bool)
    own, where, inverse, count = _distinct(ranks)
    order, cuts = _dealt(own, buckets)
    shared, first = np.zeros(len(own), bool), np.zeros(len(own), bool)
    for b in np.flatnonzero(np.diff(cuts)):
        n = cuts[b + 1] - cuts[b]
        bits = np.unpackbits(np.frombuffer(answers[int(b)], np.uint8), count=2 * n).astype(bool)
        shared[order[cuts[b] : cuts[b + 1]]], first[order[cuts[b] : cuts[b + 1]]] = bits[:n], bits[n:]
    here = np.zeros(len(ranks), bool)
    here[where] = first
    return (shared | (count > 1))[inverse], here


def _split(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []


def remove_repeats(docs: DataFrame, length: int = 400, buckets: int | None = None, block_bytes: int = 4_000_000, bucket_bytes: int = 32_000_000, words: int | None = None) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans (maximal runs removed) and kept (the bytes that stay, as binary).

    Texts are judged as UTF-8 bytes and never across their ends; null and empty texts have no bytes. Repeated rows
    count as texts of their own, so both lose what they share. Overlaps within a text count. Where `words` is given,
    bytes go as well that a passage of that many words covers which starts anywhere else, from its first word to its
    last, however short in bytes and whatever white space separates them; words lie between spaces and ASCII controls 9
    to 13. Columns of docs that have the new names are replaced; others stay. docs must give the same rows in the same
    partitions whenever it is read, as tables do. length is 8 + 4 * 64 bytes at least, words 2 + 4 * 10. A very long
    text is a block of its own; an empty table stays empty. There is a bucket for bucket_bytes of text, half of that
    with words, so that the ranks in one stay as many however large docs is: a block sends about half a byte of ranks
    for each byte of text, with words about a whole one (the latter by calculation).
    """
    if length < GRAM + 4 * WINDOW:
        raise ValueError(f"length must be {GRAM + 4 * WINDOW} or more")
    if words is not None and words < WORD_GRAM + 4 * WORD_WINDOW:
        raise ValueError(f"words must be {WORD_GRAM + 4 * WORD_WINDOW} or more")
    import zstandard

    new = ("n_bytes", "n_removed", "n_spans", "kept", "_text")
    cols = [c for c in docs.columns if c.lower() not in new]
    plain = docs.select(*(F.col(f"`{c}`") for c in cols), F.col("text").cast("string").cast("binary").alias("_text"))
    kinds = 1 if words is None else 2  # of sequences in a text
    n = buckets or max(8, -(-(plain.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) * kinds // bucket_bytes))

    def first_round(batches):
        for name, table in _blocks(batches, block_bytes):
            own = (t for raw in _texts(table.select(["_text"])) for t in _sequences([raw], length, words))  # one text at a time
            yield _rows(_send(name, np.concatenate([NO_RANKS, *(r for t in own if len(t.p) for r in (t.half, t.whole))]), n))
        _powers.cache_clear()
        release()

    def payload(batches):
        for name, table in _blocks(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            yield _rows([(name, -1, zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes()))])

    def opened(block: pa.Table, told: pa.Table):
        """The block's table and sequences, for each of these what is covered and asked as first-round answers have it, and the ranks of what is asked and shown."""
        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block["body"][0].as_py())).read_all()
        answers = {-2 - k: b for k, b in zip(told["bucket"].to_pylist(), told["body"].to_pylist(), strict=True) if k > -FINAL}
        own = _sequences(_texts(table), length, words)
        ranks = np.concatenate([NO_RANKS, *(r for t in own if len(t.p) for r in (t.half, t.whole))])
        rep, first = _read(ranks, answers, n)
        at, found, ranks = 0, [], []
        for t in own:
            a, b = (at, at) if not len(t.p) else (at + len(t.half), at + len(t.half) + len(t.whole))
            covered, ends, shown = t.asked(rep[at:a], rep[a:b], first[a:b])
            found.append((covered, ends))
            ranks.append(np.concatenate([t.strings(ends), t.strings(shown)]))
            t.sums, at = None, b  # no longer needed, and many times the text
        return table, own, found, ranks

    def last_round(block: pa.Table, told: pa.Table) -> pa.Table:
        ranks = opened(block, told)[3]
        release()
        return pa.Table.from_batches([_rows(_send(block["block"][0].as_py(), np.concatenate([NO_RANKS, *ranks]), n))])

    def judged(block: pa.Table, told: pa.Table) -> pa.Table:
        table, own, found, ranks = opened(block, told)
        release()
        answers = {-FINAL - 2 - k: b for k, b in zip(told["bucket"].to_pylist(), told["body"].to_pylist(), strict=True) if k <= -FINAL}
        rep, _ = _read(np.concatenate([NO_RANKS, *ranks]), answers, n)
        removed, spans, kept = [], [], []
        told_of = list(zip(own, found, _split(rep, [len(x) for x in ranks]), strict=True))
        for i, raw in enumerate(_texts(table)):
            edge = np.zeros(len(raw) + 1, np.int64)
            for t, (covered, ends), r in told_of[kinds * i : kinds * (i + 1)]:
                for s in (covered, ends[r[: len(ends)]]):
                    a, b = t.span(s)
                    np.add.at(edge, a, 1)
                    np.add.at(edge, b, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if removed[-1] else raw)
        if max((t.n for t in own), default=0) > 1 << 20:  # powers for such a text take as much memory as the rest
            _powers.cache_clear()
        out = table.drop_columns(["_text"])
        for name, values, kind in (("n_bytes", [t.n for t in own[::kinds]], pa.int64()), ("n_removed", removed, pa.int64()), ("n_spans", spans, pa.int64()), ("kept", kept, pa.binary())):
            out = out.append_column(name, pa.array(values, kind))
        return out

    schema = plain.drop("_text").withColumns({c: F.lit(0).cast("long") for c in new[:3]}).withColumn("kept", F.lit(None).cast("binary")).schema
    # partitions by their number, not by the session's setting: tasks stay as large however large docs is
    at = lambda df, key: df.repartition(4 * n, key).groupBy(key)
    told = store(at(plain.mapInArrow(first_round, _ROW_SQL), "bucket").applyInArrow(_answer, _ROW_SQL), "ranks")
    blocks = at(plain.mapInArrow(payload, _ROW_SQL), "block")  # one exchange serves both rounds
    asked = blocks.cogroup(at(told, "block")).applyInArrow(last_round, _ROW_SQL)
    ends = at(asked, "bucket").applyInArrow(_answer, _ROW_SQL).withColumn("bucket", F.col("bucket") - F.lit(FINAL))
    return blocks.cogroup(at(told.unionByName(ends), "block")).applyInArrow(judged, schema)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What stays of all documents without the strings of 400 bytes that they repeat."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
