import math

import pandas as pd
import pytest

from soundline import queries
from soundline.functions import raster as R
from soundline.sources.fixtures import layer

SF = "/root/testdata/sf0.001"


def _skeleton(box, lands, px, shortest, longest):
    """Pixel by pixel: the water, and its medial axis."""
    x0, y0, x1, y1 = box
    on = set()
    for r in range(math.ceil((y1 - y0) / px) + 1):
        for c in range(math.ceil((x1 - x0) / px) + 1):
            left, top = x0 + c * px, y1 - r * px
            dry = any(left <= l[2] and left + px > l[0] and top >= l[1] and top - px < l[3] for l in lands)
            if left + px / 2 <= x1 and top - px / 2 >= y0 and not dry:
                on.add((r, c))
    full = set(on)
    away = lambda p: min((p[0] - r) ** 2 + (p[1] - c) ** 2 for r in range(-1, 30) for c in range(-1, 30) if (r, c) not in full)
    block = lambda p: [(p[0] + i, p[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]

    def pieces(some):
        up = {p: p for p in some}
        for _ in some:
            up = {p: min(up[q] for q in some if max(abs(p[0] - q[0]), abs(p[1] - q[1])) <= 1) for p in some}
        return len(set(up.values()))

    for p in sorted(full, key=lambda p: (away(p), -sum(q in full for q in block(p)), p)):
        here = [q for q in block(p) if q in on]
        if len(here) >= 3 and pieces(here) == pieces([q for q in here if q != p]):
            on.remove(p)
    return full, on


@pytest.mark.parametrize("lands", [[], [(400, 300, 700, 800)], [(0, 0, 130, 950), (500, 500, 560, 560)]])
def test_skeletons_as_brute_force(spark, lands):
    box, px = (0, 0, 1200, 900), 60
    full, on = _skeleton(box, lands, px, 60, 100)
    far = lambda p: min((p[0] - r) ** 2 + (p[1] - c) ** 2 for r in range(-1, 30) for c in range(-1, 30) if (r, c) not in full)
    bands = spark.createDataFrame([(1, *box), (2, 5000, 5000, 5300, 5300)], "band_id long, minx long, miny long, maxx long, maxy long")
    land = spark.createDataFrame(lands, "minx long, miny long, maxx long, maxy long")
    rows = [r for r in queries.skeletons(bands, land, px).collect() if r.band_id == 1]
    near = lambda p: [(p[0] + i, p[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (p[0] + i, p[1] + j) in on]
    ends = {p for p in on if len(near(p)) != 2}
    chains = {}
    for p in ends:
        for q in near(p):
            path = [p, q]
            while path[-1] not in ends:
                path.append(next(x for x in near(path[-1]) if x != path[-2]))
            key = frozenset((path[0], path[-1]))
            if path[0] == path[-1] and len(path) < 4:
                continue
            size = sum(px * math.hypot(a[0] - b[0], a[1] - b[1]) for a, b in zip(path, path[1:], strict=False))
            if key not in chains or chains[key][0] < size:
                chains[key] = (size, path)
    length = sum(s for s, _ in chains.values())
    assert sum(r.length for r in rows) == pytest.approx(length)  # at this pixel size no spur is short
    assert min((r.min_width for r in rows), default=0) == pytest.approx(min((2 * px * math.sqrt(far(p)) for _, c in chains.values() for p in c), default=0))
    assert all(r.length < 100 + px * math.sqrt(2) for r in rows)


def test_skeleton_prunes():
    line, spur = [(5, c) for c in range(20)], [(5, 10), (4, 10), (3, 10)]
    found = [line[:11], line[10:], spur]
    assert R.prune(found, 20, 60) == sorted([line[:11], line[10:]], key=lambda c: (c[0], c[-1]))
    assert [len(x) for x in R.resample(line[:11], 20, 100)] == [6, 6]


def test_every_band_has_a_row_unless_dry(spark):
    got = {r.band_id for r in queries.skeleton_network(spark, SF).select("band_id").distinct().collect()}
    land = [(r.minx, r.miny, r.maxx, r.maxy) for r in layer(spark, SF, "chart_land").collect()]
    meets = lambda b: any(b.minx <= l[2] and b.maxx >= l[0] and b.miny <= l[3] and b.maxy >= l[1] for l in land)
    free = {b.band_id for b in layer(spark, SF, "depth_bands").collect() if not meets(b)}
    assert len(free) > 20 and free <= got


def test_equal_rasters_are_thinned_once(monkeypatch):
    """Bands that differ in their place alone have the same segments, from one raster."""
    axis, calls = R.medial_axis, []
    monkeypatch.setattr(R, "medial_axis", lambda mask: calls.append(1) or axis(mask))
    land = lambda x: [{"minx": x + 400, "miny": 300, "maxx": x + 700, "maxy": 800}]
    own = [(i, x, 0, x + 1200, 900, land(x) if i >= 20 else None) for i in range(40) for x in [5000 * i]]
    f = pd.DataFrame(own, columns=["band_id", "minx", "miny", "maxx", "maxy", "land"])
    got = pd.concat(queries.raster_segments([f[:10], f[10:]], 60, 60, 100)).set_index("band_id")
    alike = lambda a, b: got.loc[a].reset_index(drop=True).equals(got.loc[b].reset_index(drop=True))
    assert len(calls) == 2 and set(got.index) == set(range(40))
    assert all(alike(i, i - i % 20) for i in range(40)) and not alike(0, 20)
