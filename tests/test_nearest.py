import numpy as np

from soundline.queries import nearest_vectors


def test_several_blocks_and_chunks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (300, 3)).astype(float)  # many ties
    rows = spark.createDataFrame([(i * 7, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = rows.filter("vec_id % 5 = 0")
    got = {(r.q, r["rank"]): r.near for r in nearest_vectors(asked, rows, 4, block=16, chunk=40).collect()}
    want = {}
    for i in range(0, 300, 5):
        dist = np.sqrt(((x - x[i]) ** 2).sum(1))
        near = sorted((round(float(dist[j]), 6), j * 7) for j in range(300) if j != i)[:4]
        want |= {(i * 7, n + 1): y for n, (_, y) in enumerate(near)}
    assert got == want


def test_empty(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert nearest_vectors(rows, rows, 5).count() == 0
