import collections
import itertools
import random

from test_llm import none, odd  # noqa: F401

import corpus_pipeline
from soundline.llm import near_duplicates


def _set(text, size=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _planted(seed=5):
    """Texts of 60 to 300 words, each with copies in which 0 to 12 places are changed, and bucket-mates below 0.8."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows = []
    for _ in range(60):
        base = [word() for _ in range(rng.randint(60, 300))]
        rows.append(" ".join(base))
        for changes in (0, 1, 2, 3, 4, 6, 9, 12):
            copy = list(base)
            for i in rng.sample(range(len(copy)), changes):
                copy[i] = word()
            rows.append(" ".join(copy))
    return list(enumerate(rows))


def _groups(rows):
    """Smallest id of the component of each id, over all pairs of similarity 0.8 or more."""
    sets, up = {i: _set(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(up), 2):
        if _jaccard(sets[a], sets[b]) >= 0.8:
            p, q = sorted((find(a), find(b)))
            up[q] = p
    return {i: find(i) for i in up}


def test_groups_as_brute_force(spark):
    rows = _planted()
    want = _groups(rows)
    sets = {i: _set(t) for i, t in rows}
    linked = [_jaccard(sets[i], sets[c]) for i, c in want.items() if i != c]
    assert sum(0.8 <= x < 0.9 for x in linked) > 20 and len(set(want.values())) > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == want
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in rows if want[i] == i}


def test_pairs_that_no_leader_joins(spark):
    """A chain: neighbours are similar, the ends aren't, whoever leads their buckets."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12 : i * 12 + 200])) for i in range(16)]
    want = _groups(rows)
    assert set(want.values()) == {0}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == want


def test_large_buckets_in_tiles(spark, monkeypatch):
    """Copies of one text with 2 to 20 changed words, in buckets over the limit and tiles of 16."""
    rng = random.Random(1)
    base = [f"w{rng.random()}" for _ in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for j in rng.sample(range(150), rng.choice((2, 4, 8, 12, 20))):
            copy[j] = f"w{rng.random()}"
        rows.append((i, " ".join(copy)))
    want = _groups(rows)
    assert 10 < len(set(want.values())) < 110
    tiled = near_duplicates.tiled
    monkeypatch.setattr(near_duplicates, "LARGE", 8)
    monkeypatch.setattr(near_duplicates, "tiled", lambda *a: tiled(*a, tile=16))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == want


def test_odd_rows(odd, none):  # noqa: F811
    got = collections.Counter((r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(odd).collect())
    assert got == collections.Counter({(1, 1): 1, (None, 1): 1, (2, 2): 1, (3, 2): 1, (6, 2): 1, (4, 4): 1, (5, 5): 2})
    assert near_duplicates.near_duplicates(none).count() == 0


def test_candidates_are_those_within_the_radius(spark):
    """Every similar pair has fingerprints within the radius and is a candidate; hardly any other pair is."""
    rows = _planted(seed=11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = near_duplicates.signatures(docs, 5)
    node = {r.doc_id: r.node for r in signed.collect()}
    got = {(r.a, r.b) for r in near_duplicates.candidates(signed, 4, 5).collect()}
    sets = {i: _set(t) for i, t in rows}
    words = {i: near_duplicates.fingerprint(near_duplicates.shingles(t, 5)) for i, t in rows}
    apart = lambda a, b: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(words[a].tolist(), words[b].tolist(), strict=True))
    similar = [(a, b) for a, b in itertools.combinations(sets, 2) if node[a] != node[b] and _jaccard(sets[a], sets[b]) >= 0.8]
    assert len(similar) > 100 and all(tuple(sorted((node[a], node[b]))) in got for a, b in similar)
    assert max(apart(a, b) for a, b in similar) <= near_duplicates.RADIUS
    assert len(got) < 60 * 36 + 10


def test_candidates_of_a_large_group_stay_few(spark, monkeypatch):
    """Rows grow with the nodes, not with the square of a group over several tiles, and join what all pairs would."""
    rng = random.Random(3)
    base = [f"w{rng.random()}" for _ in range(200)]
    rows = []
    for i in range(300):
        copy = list(base)
        for j in rng.sample(range(200), rng.choice((1, 2, 3, 14))):
            copy[j] = f"w{rng.random()}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    signed = near_duplicates.signatures(docs, 5)
    nodes = signed.select("node").distinct().count()
    found = near_duplicates.candidates(signed, 4, 5, tile=64).collect()
    assert any(r.dense for r in found) and len(found) < 5 * nodes
    node = {r.doc_id: r.node for r in signed.collect()}
    words = {node[i]: near_duplicates.fingerprint(near_duplicates.shingles(t, 5)) for i, t in rows}
    n = {node[i]: len(near_duplicates.shingles(t, 5)) for i, t in rows}
    apart = lambda a, b: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(words[a].tolist(), words[b].tolist(), strict=True))
    pairs = [(a, b) for a, b in itertools.combinations(words, 2) if apart(a, b) <= near_duplicates.RADIUS and 5 * min(n[a], n[b]) >= 4 * max(n[a], n[b])]
    assert len(pairs) > 50 * nodes
    all_, few = ({frozenset(g) for g in _joined(words, p)} for p in (pairs, [(r.a, r.b) for r in found]))
    assert all_ == few
    real = near_duplicates.candidates
    monkeypatch.setattr(near_duplicates, "candidates", lambda *a: real(*a, tile=64))
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == _groups(rows)


def _joined(nodes, pairs):
    up = {i: {i} for i in nodes}
    for a, b in pairs:
        if up[a] is not up[b]:
            up[a] |= up[b]
            for i in up[b]:
                up[i] = up[a]
    return up.values()
