"""Point-in-polygon join: holes, concave polygons, overlaps, multi-part areas, boundary points."""

from pyspark.sql import functions as F

from roadrisk.operators.spatial import spatial_join


def _ring(pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def test_polygon_edge_cases(spark):
    square_hole = [_ring([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]), _ring([(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)])]
    concave_l = [_ring([(20, 0), (30, 0), (30, 3), (23, 3), (23, 10), (20, 10), (20, 0)])]
    over_a = [_ring([(40, 0), (46, 0), (46, 6), (40, 6), (40, 0)])]
    over_b = [_ring([(43, 3), (49, 3), (49, 9), (43, 9), (43, 3)])]
    part1 = [_ring([(60, 0), (62, 0), (62, 2), (60, 2), (60, 0)])]
    part2 = [_ring([(65, 0), (67, 0), (67, 2), (65, 2), (65, 0)])]
    areas = spark.createDataFrame(
        [(1, "hole", square_hole), (2, "L", concave_l), (3, "A", over_a), (4, "B", over_b), (5, "two", part1), (5, "two", part2)],
        "community_area_number int, community string, rings array<array<struct<x:double,y:double>>>")
    pts = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 25.0, 5.0), (4, 21.0, 5.0), (5, 44.0, 4.0), (6, 41.0, 1.0),
           (7, 61.0, 1.0), (8, 66.0, 1.0), (9, 10.0, 5.0), (10, 0.0, 0.0), (11, 100.0, 100.0), (12, None, None)]
    points = spark.createDataFrame(pts, "id int, lon double, lat double")
    got = {}
    for r in spatial_join(points, areas).collect():
        got.setdefault(r["id"], set()).add(r["community_area_number"])
    assert got[1] == {1}          # inside the square
    assert got[2] == {None}       # inside the hole
    assert got[3] == {None}       # in the notch of the L
    assert got[4] == {2}          # in the L's vertical bar
    assert got[5] == {3, 4}       # overlap -> duplicated
    assert got[6] == {3}
    assert got[7] == {5} and got[8] == {5}  # two-part area
    assert got[9] == {None}       # on an edge: not within
    assert got[10] == {None}      # on a vertex: not within
    assert got[11] == {None} and got[12] == {None}
    assert spatial_join(points, areas).count() == 13  # 12 points + 1 duplicate


def test_join_plan_broadcasts_checked_side(spark):
    areas = spark.createDataFrame([(1, [_ring([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])])],
                                  "community_area_number int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.range(100).select(F.col("id"), (F.col("id") / 100).alias("lon"), F.lit(0.5).alias("lat"))
    plan = spatial_join(pts, areas)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
