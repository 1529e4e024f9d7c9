import math

from soundline.operators import hazards


def test_far_edges_keep_their_distance(spark):
    e = spark.createDataFrame([(1, 2, 0, 0, 10, 0), (3, 4, 90000, 0, 90000, 50), (5, 6, 95, 95, 105, 105), (7, 8, 0, 50, 0, 50)], "u long, v long, x1 long, y1 long, x2 long, y2 long")
    e = e.selectExpr("*", "least(x1, x2) minx", "least(y1, y2) miny", "greatest(x1, x2) maxx", "greatest(y1, y2) maxy")
    land = spark.createDataFrame([(100, 100, 200, 200)], "minx long, miny long, maxx long, maxy long")
    got = {r.u: r.distance_to_land for r in hazards.distance_to_land(e, land).collect()}
    assert got == {1: round(math.hypot(90, 100), 2), 3: round(math.hypot(89800, 50), 2), 5: 0.0, 7: round(math.hypot(100, 50), 2)}
    assert {r.distance_to_land for r in hazards.distance_to_land(e, land.limit(0)).collect()} == {9999.0}
