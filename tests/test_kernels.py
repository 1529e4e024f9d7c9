import itertools
import math

import numpy as np
import pytest

from soundline import queries
from soundline.functions import raster as R
from soundline.operators import shapes, spatial
from soundline.sources.fixtures import layer

SF = "/root/testdata/sf0.001"


def _turn(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _in_circle(a, b, c, d):
    (ax, ay), (bx, by), (cx, cy) = ((p[0] - d[0], p[1] - d[1]) for p in (a, b, c))
    return (ax * ax + ay * ay) * (bx * cy - cx * by) - (bx * bx + by * by) * (ax * cy - cx * ay) + (cx * cx + cy * cy) * (ax * by - bx * ay)


def _check_mesh(pts, tri):
    """Counter-clockwise, empty circles, and together the hull."""
    area = 0
    for t in tri:
        a, b, c = (pts[i] for i in t)
        assert _turn(a, b, c) > 0
        area += _turn(a, b, c)
        assert all(_in_circle(a, b, c, p) <= 0 for p in pts)
    hull = R.convex_hull(np.array(pts, float)).tolist()
    assert area == sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(hull, hull[1:] + hull[:1], strict=True))


def test_triangles_have_empty_circles():
    rng = np.random.default_rng(0)
    for pts in (rng.integers(0, 5000, (60, 2)), np.array(list(itertools.product(range(5), range(6)))) * 100, rng.integers(0, 12, (90, 2))):
        own = [tuple(p) for p in np.unique(pts, axis=0).tolist()]
        tri = R.triangulate(np.array(own)).tolist()
        _check_mesh(own, tri)
        across = R.neighbours(np.array(tri))
        sides = {frozenset(p): t for t, x in enumerate(tri) for p in itertools.combinations(x, 2)}
        assert all(set(tri[t]) - {tri[t][k]} <= set(tri[o]) for t, row in enumerate(across.tolist()) for k, o in enumerate(row) if o >= 0) and len(sides) * 2 == 3 * len(tri) + sum((across == -1).sum(1))
    assert R.triangulate(np.array([[0, 0], [1, 1], [2, 2]])).tolist() == []


def test_navmesh_of_every_tile(spark):
    nodes = {r.k: (r.lon_e5, r.lat_e5) for r in layer(spark, SF, "chart_nodes").collect()}
    tiles: dict = {}
    for r in queries.navmesh_triangulate(spark, SF).collect():
        tiles.setdefault((r.cx, r.cy), []).append(r.corners)
    for (cx, cy), found in tiles.items():
        own = sorted({p for p in nodes.values() if (p[0] // 10000, p[1] // 10000) == (cx, cy)})
        _check_mesh(own, [[own.index(nodes[k]) for k in t] for t in found])
    assert tiles


def test_geodesic_and_utm():
    assert abs(R.geodesic(0.0, 0.0, 1.0, 0.0) - 111319.4908) < 1e-3 and abs(R.geodesic(0.0, 0.0, 0.0, 1.0) - 110574.3886) < 1e-3
    assert R.geodesic(3.0, 51.0, 3.0, 51.0) == 0
    x, y = R.utm(np.array([3.0, 3.0, 2.0]), np.array([0.0, 51.0, 51.0]), 31)
    assert abs(x[0] - 500000) < 1e-6 and abs(y[0]) < 1e-6 and abs(y[1] / 0.9996 - R.geodesic(3.0, 0.0, 3.0, 51.0)) < 1e-2
    # near the central meridian a small step has 0.9996 of its length
    a, b = (np.array(v) for v in zip(*[R.utm(lon, lat, 31) for lon, lat in ((3.0, 51.0), (3.001, 51.0007))], strict=True))
    assert abs(math.dist((a[0], b[0]), (a[1], b[1])) - 0.9996 * float(R.geodesic(3.0, 51.0, 3.001, 51.0007))) < 1e-2


def test_raster_splits_as_brute_force():
    rng = np.random.default_rng(1)
    m = np.zeros((24, 30), bool)
    m[3:20, 4:26] = True
    m[9:12, 26:30] = True
    m &= rng.random(m.shape) > 0.03
    off = [(i, j) for i in range(-1, 25) for j in range(-1, 31) if not (0 <= i < 24 and 0 <= j < 30 and m[i, j])]
    d2 = np.array([[min((i - a) ** 2 + (j - b) ** 2 for a, b in off) for j in range(30)] for i in range(24)])
    assert (R.distance2(m) == d2).all() and (R.erode(m, 2) == (d2 > 4)).all()
    grown = np.array([[any(m[a, b] and (i - a) ** 2 + (j - b) ** 2 <= 4 for a in range(24) for b in range(30)) for j in range(30)] for i in range(24)])
    assert (R.dilate(m, 2) == grown).all()
    wide, narrow = R.split_wide(m, 2)
    assert not (wide & narrow).any() and ((wide | narrow) == m).all() and not wide[9:12, 29].any()
    labels = R.parts(m)
    assert (sum(p.astype(int) for p in labels) == m).all()
    for p in labels:
        i, j = map(int, np.argwhere(p)[0])
        seen, todo = {(i, j)}, [(i, j)]
        while todo:
            a, b = todo.pop()
            for c in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= c[0] < 24 and 0 <= c[1] < 30 and m[c] and c not in seen:
                    seen.add(c)
                    todo.append(c)
        assert seen == set(map(tuple, np.argwhere(p).tolist()))
    deep = np.zeros_like(m)
    deep[5:18, 6:15] = True
    own, shallow = R.split_deep(m, deep, np.zeros_like(m), 1, 1, 3)
    assert not (own & shallow).any() and ((own | shallow) == m).all() and own.any() and not own[:, 16:].any()


def test_simplify_keeps_within_tolerance():
    rng = np.random.default_rng(2)
    line = np.cumsum(rng.normal(size=(200, 2)), axis=0)
    kept = R.simplify(line, 1.5)
    assert {tuple(p) for p in kept} <= {tuple(p) for p in line} and (kept[0] == line[0]).all() and (kept[-1] == line[-1]).all() and len(kept) < 100

    def far(p, a, b):
        d = b - a
        return abs(d[0] * (p[1] - a[1]) - d[1] * (p[0] - a[0])) / max(math.hypot(*d), 1e-9)

    where = [next(i for i, p in enumerate(line) if (p == k).all()) for k in kept]
    assert all(far(line[i], line[a], line[b]) <= 1.5 + 1e-9 for a, b in zip(where, where[1:], strict=False) for i in range(a + 1, b))


@pytest.mark.parametrize("turn", [1, -1])
def test_shapes_whichever_way_rings_run(spark, turn):
    shell, hole = [(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]
    rows = [(x, y, x2, y2) for x in (-1, 0, 2, 4, 5, 8) for y in (0, 3, 5) for x2, y2 in ((5, 5), (9, 9), (20, 5))]
    df = spark.createDataFrame(rows, "x long, y long, x2 long, y2 long").withColumn("rings", shapes.F.array(shapes.ring(*shell[::turn]), shapes.ring(*hole)))
    inner = lambda x, y: 0 < x < 10 and 0 < y < 10 and not (4 <= x <= 6 and 4 <= y <= 6)
    c = shapes.F.col
    for r in df.select("*", shapes.inside(c("rings"), c("x"), c("y")).alias("i"), shapes.meets_segment(c("rings"), c("x"), c("y"), c("x2"), c("y2")).alias("m")).collect():
        assert r.i == inner(r.x, r.y)
        steps = [(r.x + (r.x2 - r.x) * k / 420, r.y + (r.y2 - r.y) * k / 420) for k in range(421)]
        assert r.m == any(0 <= a <= 10 and 0 <= b <= 10 and not (4 < a < 6 and 4 < b < 6) for a, b in steps)


def test_knn_reaches_far_clusters(spark):
    p = [(i, 10 * i, 0) for i in range(6)] + [(90, 900_000, 900_000)]
    df = spark.createDataFrame(p, "k long, x long, y long")
    got = {(r.l.k, r["rank"]): r.r.k for r in spatial.knn_join(df, df, 3, exclude=shapes.F.col("l.k") == shapes.F.col("r.k"), reach=50).collect()}
    want = {(a, n + 1): b for a, x, y in p for n, (_, b) in enumerate(sorted(((x - x2) ** 2 + (y - y2) ** 2, b) for b, x2, y2 in p if b != a)[:3])}
    assert got == want
    assert spatial.knn_join(df, df, 9, reach=50).count() == 49 and spatial.knn_join(df.limit(0), df, 3).count() == spatial.knn_join(df, df.limit(0), 3).count() == 0
