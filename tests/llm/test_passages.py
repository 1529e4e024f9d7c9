import collections
import re

import numpy as np
import pytest

from soundline.llm import common, suffix_dedup


def _kept(texts, length, words):
    """What stays of each text without strings of `length` bytes and passages of `words` words that occur anywhere else."""
    raw = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)] for x in raw]
    strings = collections.Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    of = lambda x, at: b" ".join(x[a:b] for a, b in at)
    passages = collections.Counter(of(x, at[i : i + words]) for x, at in zip(raw, places, strict=True) for i in range(len(at) - words + 1))
    for x, at in zip(raw, places, strict=True):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            gone[i : i + length] |= strings[x[i : i + length]] > 1
        for i in range(len(at) - words + 1):
            gone[at[i][0] : at[i + words - 1][1]] |= passages[of(x, at[i : i + words])] > 1
        yield np.frombuffer(x, np.uint8)[~gone].tobytes()


def test_passages_of_words_by_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdeéf"), n)) for n in rng.integers(1, 8, 300)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, long = prose(60), prose(200)
    broken = passage.split()
    texts = [f"{prose(20)} {passage} {prose(9)}", f"{passage}\n{prose(70)}", f"{prose(3)}\t" + "\r\n ".join(broken), " ".join(broken[:50]), " ".join(broken[9:]), " ".join(broken[:51]) + "x"]
    texts += [f"{long} {prose(40)}", f"{prose(7)} {long}", long[100:520], "a " * 51, "a " * 53 + "b", "  ", "", None, prose(300), "y" * 450, "z" * 401, " ".join(["el"] * 120)]
    df = common.store(spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3), "rows")
    want = dict(enumerate(_kept(texts, 400, 51)))
    assert len(passage.encode()) < 400 and passage.encode() not in want[0] and want[3] and want[13] == b""
    for block in (500, 4_000_000):
        found = suffix_dedup.remove_repeats(df, buckets=3, block_bytes=block, words=51).collect()
        assert {r.id: bytes(r.kept) for r in found} == want
        assert all(r.n_removed == r.n_bytes - len(r.kept) for r in found)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, words=20)


def test_pipeline_cuts_short_passages_of_over_50_words(spark):
    import corpus_pipeline as C

    rng = np.random.default_rng(6)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    passage, shorter = prose(51), prose(50)
    rows = [(1, f"{prose(30)} {passage} {prose(30)}"), (2, f"{passage} {prose(40)}"), (3, f"{shorter} {prose(9)}"), (4, f"{prose(8)} {shorter}")]
    got = {r.doc_id: r.text for r in C.drop_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert got == {i: t.replace(passage, "") for i, t in rows}
