import gzip
import json
import zipfile

import pytest

from soundline.sources import geojson, packages, sqlite

SQUARE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]


def _layer(spark):
    rows = [
        ("Polygon", json.dumps(SQUARE), {"id": "in"}),
        ("Polygon", json.dumps([[[2, 2], [8, 2], [8, 8], [2, 8], [2, 2]]]), {"id": "cut", 'a"b': "x\ny"}),
        ("Polygon", json.dumps([[[20, 20], [28, 20], [28, 28], [20, 20]]]), {"id": "out"}),
        ("Point", "[1, 1]", {"id": "p"}),
        ("Point", "[9, 1]", {"id": "q"}),
        ("LineString", "[[1, 1], [30, 1]]", {"id": "l"}),
        ("MultiPolygon", json.dumps([SQUARE, [[[3, 3], [9, 3], [9, 9], [3, 3]]]]), {"id": "m"}),
        (None, None, {"id": "none"}),
    ]
    return spark.createDataFrame(rows, geojson.SCHEMA)


def _as_set(df):
    return {(r.kind, None if r.coordinates is None else json.dumps(json.loads(r.coordinates)), tuple(sorted(r.properties.items()))) for r in df.collect()}


@pytest.mark.parametrize("lines", [False, True])
def test_geojson_round_trip(spark, tmp_path, lines):
    layer = _layer(spark).repartition(3)
    geojson.write(layer, f"{tmp_path}/out", lines)
    if not lines:
        for p in (tmp_path / "out").glob("part-*"):
            assert json.loads(p.read_text())["type"] == "FeatureCollection"
    assert _as_set(geojson.read(spark, f"{tmp_path}/out", f"{tmp_path}/missing", lines=lines)) == _as_set(layer)


def test_geojson_missing_and_empty(spark, tmp_path):
    assert geojson.read(spark, f"{tmp_path}/none").collect() == []
    geojson.write(_layer(spark).filter("false"), f"{tmp_path}/empty")
    assert geojson.read(spark, f"{tmp_path}/empty").count() == 0
    assert geojson.clip(_layer(spark).filter("false"), 0, 0, 1, 1).count() == 0


def test_clip(spark):
    got = {r.properties["id"]: r for r in geojson.clip(_layer(spark), 0, 0, 5, 5).collect()}
    assert set(got) == {"in", "cut", "p", "l", "m"}

    def area(ring):
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))) / 2

    assert area(json.loads(got["in"].coordinates)[0]) == 16
    ring = json.loads(got["cut"].coordinates)[0]
    assert area(ring) == 9 and ring[0] == ring[-1]
    assert [area(p[0]) for p in json.loads(got["m"].coordinates)] == [16, 2]


def test_sqlite_round_trip(spark, tmp_path):
    path = f"{tmp_path}/x.sqlite"
    nodes = spark.createDataFrame([(i, i / 7, None if i % 3 else f"n{i}", [i]) for i in range(1000)], "id long, lat double, lon string, tags array<int>")
    for _ in range(2):  # the second replaces the first
        sqlite.write({"nodes": nodes, "none": nodes.filter("false")}, path, keys={"nodes": "id"}, batch=64)
    got = sqlite.read(spark, path, "nodes", "lat double, id long, lon string, tags string", 5)
    assert sorted(map(tuple, got.select("id", "lat", "lon", "tags").collect())) == [(i, i / 7, None if i % 3 else f"n{i}", f"[{i}]") for i in range(1000)]
    assert got.rdd.getNumPartitions() == 5
    assert sqlite.read(spark, path, "none", "id long").count() == 0
    assert sqlite.metadata(path) is None and sqlite.metadata(f"{tmp_path}/no") is None


def test_publish(spark, tmp_path):
    path = f"{tmp_path}/r.sqlite"
    sqlite.write({"metadata": spark.createDataFrame([("NL", "north", 2)], "country string, name string, schema_version int")}, path)
    told = packages.publish(path, f"{tmp_path}/out/nl", "north")
    with open(path, "rb") as f:
        assert gzip.open(told["package"]).read() == f.read()
    assert json.loads((tmp_path / "out/nl/north.metadata.json").read_text()) == {"country": "NL", "name": "north", "description": "", "schema_version": 2}
    with pytest.raises(ValueError):
        packages.publish(f"{tmp_path}/none.sqlite", f"{tmp_path}/out", "none")


def test_chart_files_and_archives(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    for n in ("US1AA.000", "a/US5BB.000", "a/b/other.000", "a/US5BB.txt"):
        (tmp_path / n).write_bytes(b"x")
    names = lambda df: sorted((r.path.rsplit("/", 1)[1], r.band) for r in df.collect())
    assert names(packages.chart_files(spark, str(tmp_path))) == [("US5BB.000", 5), ("other.000", None)]
    assert len(names(packages.chart_files(spark, str(tmp_path), coarse=True))) == 3
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("d/x.000", b"one")
        z.writestr("y.txt", b"two")
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    got = sorted(((r.archive.rsplit("/", 1)[1], r.ok, r.member, r.content and bytes(r.content)) for r in packages.members(spark, str(tmp_path)).collect()), key=str)
    assert got == [("bad.zip", False, None, None), ("good.zip", True, "d/x.000", b"one"), ("good.zip", True, "y.txt", b"two")]
