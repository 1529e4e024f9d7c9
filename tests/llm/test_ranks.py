import numpy as np

from soundline.llm import suffix_dedup as S


def test_distinct_where_ranks_clash():
    """Strings of one rank whose confirming hashes differ stay apart; first places and counts are those of the rows."""
    rng = np.random.default_rng(2)
    for clash in (False, True):
        ranks = np.stack([rng.integers(0, 50, 400), rng.integers(0, 3, 400) * clash], 1).astype(np.uint64)
        own, where, inverse, count = S._distinct(ranks)
        rows = [tuple(r) for r in ranks.tolist()]
        assert [tuple(r) for r in own.tolist()] == sorted(set(rows))
        assert where.tolist() == [rows.index(r) for r in sorted(set(rows))]
        assert (own[inverse] == ranks).all() and count.tolist() == [rows.count(r) for r in sorted(set(rows))]
    assert all(len(x) == 0 for x in S._distinct(S.NO_RANKS))


def test_starts_asked_for_as_by_search():
    """asked() tells the positions around each start as a search for it would."""
    rng = np.random.default_rng(3)
    for n in (400, 401, 463, 2000):
        t = S._Text(rng.integers(97, 123, n, np.uint8).tobytes(), 400)
        half, whole, first = (rng.random(len(x)) < 0.5 for x in (t.half, t.whole, t.whole))
        alive, repeated = np.zeros(len(t.p), bool), np.zeros(len(t.p) + 1, bool)
        alive[t.half_at], repeated[t.whole_at + 1] = half, whole
        live = lambda s: any(alive[i] for i in [np.searchsorted(t.p, s + S.WINDOW - 1)] if i < len(t.p))
        known = [s for s in range(t.last + 1) if half.any() and repeated[np.searchsorted(t.p, s, side="right")]]
        covered, ends, _ = t.asked(half, whole, first)
        assert covered.tolist() == known
        assert ends.tolist() == [s for s in range(t.last + 1) if live(s) and s not in set(known)]


def test_told_where_ranks_clash():
    """A rank is there twice only where its confirming hash is too; the first of its kind is marked."""
    rng = np.random.default_rng(5)
    for clash in (False, True):
        ranks = np.stack([rng.integers(0, 300, 400), rng.integers(0, 3, 400) * clash], 1).astype(np.uint64)
        bodies = [r[:, 0].astype("<u8").tobytes() + r[:, 1].astype("<u2").tobytes() for r in (ranks[:150], ranks[150:150], ranks[150:])]
        rows = [tuple(r) for r in ranks.tolist()]
        shared, first = S._told(bodies)
        assert shared.tolist() == [rows.count(r) > 1 for r in rows]
        assert first.tolist() == [rows.index(r) == i for i, r in enumerate(rows)]
    assert all(len(x) == 0 for x in S._told([]))
