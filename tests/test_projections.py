import duckdb

from soundline import shape_queries  # noqa: F401
from soundline.queries import ORACLE, QUERIES


def test_places_beyond_a_pole_as_sql(spark, tmp_path):
    ids = [0, 7, 155_199, 155_200, 155_241, 400_000, 880_001, 899_999]  # from latitude 51 over 90 and 270 to 276
    spark.createDataFrame([(i, i % 25) for i in ids], "c_custkey long, c_nationkey int").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = QUERIES["node_projections"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = con.execute(ORACLE["node_projections"])
    names = [c[0] for c in want.description]
    plain = lambda r: tuple("nan" if isinstance(x, float) and x != x else None if x is None else round(float(x), 6) for x in r)
    assert got.columns == names and sorted(map(plain, got.collect())) == sorted(map(plain, want.fetchall()))
