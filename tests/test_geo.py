import random

import pytest
from pyspark.sql import functions as F

from urbanlake.functions import geo
from urbanlake.operators.spatial import PolygonIndex, spatial_enrich, within_left_join

SQUARE_WITH_HOLE = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)))"


def polys(spark, items):
    df = spark.createDataFrame(items, "pid int, wkt string")
    return df.withColumn("geom", geo.parse_multipolygon("wkt"))


def test_parse_point(spark):
    df = spark.createDataFrame([("POINT (-87.6 41.9)",), ("POINT(1 2)",), (None,)], "w string")
    got = [r[0] for r in df.select(geo.parse_point("w")).collect()]
    assert got[0]["x"] == -87.6 and got[0]["y"] == 41.9
    assert (got[1]["x"], got[1]["y"]) == (1.0, 2.0)
    assert got[2] is None


def test_bad_point_fails(spark):
    df = spark.createDataFrame([("POINT (abc 1)",)], "w string")
    with pytest.raises(Exception):
        df.select(geo.parse_point("w")).collect()


def test_parse_multipolygon_rings(spark):
    p = polys(spark, [(1, SQUARE_WITH_HOLE), (2, "POLYGON ((0 0, 1 0, 1 1, 0 0))")])
    got = p.select(F.size("geom"), F.size(F.flatten("geom"))).collect()
    assert [tuple(r) for r in got] == [(2, 10), (1, 4)]


def test_strict_within_square_with_hole(spark):
    # Inside, hole, edges, corners, outer and inner boundary, NULL
    pts = [(3.0, 3.0), (1.5, 1.5), (0.0, 2.0), (4.0, 2.0), (2.0, 0.0), (0.0, 0.0), (2.0, 2.0), (3.0, 1.0), (None, None)]
    expected = [True, False, False, False, False, False, False, True, False]
    p = polys(spark, [(1, SQUARE_WITH_HOLE)])
    df = spark.createDataFrame(list(enumerate(pts)), "i int, xy struct<x:double,y:double>")
    df = df.withColumn("pt", F.when(F.col("xy.x").isNotNull(), F.col("xy")))
    out = within_left_join(df, "pt", p, {"pid": "pid"}, cell_size=1.0)
    got = {r.i: r.pid == 1 for r in out.collect()}
    assert [got[i] for i in range(len(pts))] == expected


def test_level_with_vertex(spark):
    # a point level with a vertex of a concave polygon is counted once
    p = polys(spark, [(1, "POLYGON ((0 0, 2 1, 0 2, 1 1, 0 0))")])
    df = spark.createDataFrame([(0.5, 1.0), (1.5, 1.0)], "x double, y double").select(geo.point("x", "y").alias("pt"))
    got = [r.pid for r in within_left_join(df, "pt", p, {"pid": "pid"}).orderBy(F.col("pt.x")).collect()]
    assert got == [None, 1]


def test_overlapping_polygons_multiply_rows(spark):
    # One point in two overlapping polygons -> two rows, no de-duplication
    p = polys(spark, [(1, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), (2, "POLYGON ((1 1, 3 1, 3 3, 1 3, 1 1))")])
    df = spark.createDataFrame([(1.5, 1.5), (5.0, 5.0)], "x double, y double").select(geo.point("x", "y").alias("pt"))
    out = within_left_join(df, "pt", p, {"pid": "pid"})
    assert sorted((r.pt.x, r.pid) for r in out.collect()) == [(1.5, 1), (1.5, 2), (5.0, None)]


def _triangles(n, seed):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        pts = [(round(rnd.uniform(0, 10), 3), round(rnd.uniform(0, 10), 3)) for _ in range(3)]
        ring = ", ".join(f"{x} {y}" for x, y in pts + pts[:1])
        out.append((k, f"POLYGON (({ring}))"))
    return out


@pytest.mark.parametrize("cell", [None, 0.7, 3.0])
def test_grid_join_equals_nested_loop(spark, cell):
    p = polys(spark, _triangles(60, 11))
    rnd = random.Random(5)
    pts = spark.createDataFrame(
        [(i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(3000)], "i int, x double, y double"
    ).select("i", geo.point("x", "y").alias("pt"))
    grid = within_left_join(pts, "pt", p, {"pid": "pid"}, cell_size=cell)
    edges = p.select("pid", geo.ring_edges("geom").alias("edges"))
    loop = pts.join(F.broadcast(edges), geo.point_within(F.col("pt"), F.col("edges")), "left").select("i", "pt", "pid")
    a = sorted((r.i, r.pid if r.pid is not None else -1) for r in grid.select("i", "pid").collect())
    b = sorted((r.i, r.pid if r.pid is not None else -1) for r in loop.select("i", "pid").collect())
    assert a == b
    assert len(a) > 3000  # overlaps occur


def test_spatial_enrich_equals_direct(spark, scratch):
    p = polys(spark, _triangles(40, 3))
    rnd = random.Random(9)
    base = [(i, round(rnd.uniform(0, 10), 1), round(rnd.uniform(0, 10), 1)) for i in range(2000)]
    df = spark.createDataFrame(base, "i int, x double, y double").select(
        "i", geo.point("x", "y").alias("a"), geo.point("y", "x").alias("b")
    )
    idx = PolygonIndex(p, ["pid"])
    joins = [("a", idx, {"pa": "pid"}), ("b", idx, {"pb": "pid"})]
    via_lookup = spatial_enrich(df, joins, lookup_path=scratch("points"))
    direct = idx.join(idx.join(df, "a", {"pa": "pid"}), "b", {"pb": "pid"})
    key = lambda r: (r.i, r.pa or -1, r.pb or -1)
    assert sorted(map(key, via_lookup.collect())) == sorted(map(key, direct.collect()))
    per_row = spatial_enrich(df, joins)
    assert sorted(map(key, per_row.collect())) == sorted(map(key, direct.collect()))


def test_rows_without_a_point_stay_and_spread(spark, scratch):
    # a third of the rows without a point: all kept, none matched, no common key
    p = polys(spark, [(1, "POLYGON ((-1 -1, 6 -1, 6 6, -1 6, -1 -1))")])
    df = spark.createDataFrame([(i, None if i % 3 == 0 else float(i % 10)) for i in range(900)], "i int, x double")
    df = df.select("i", F.when(F.col("x").isNotNull(), geo.point("x", "x")).alias("a"))
    idx = PolygonIndex(p, ["pid"])
    for out in (spatial_enrich(df, [("a", idx, {"pa": "pid"})]), spatial_enrich(df, [("a", idx, {"pa": "pid"})], lookup_path=scratch("points"))):
        rows = out.collect()
        assert len(rows) == 900 and all(r.pa is None for r in rows if r.i % 3 == 0)
        assert sum(r.pa == 1 for r in rows) == sum(1 for i in range(900) if i % 3 and i % 10 < 6)
    from urbanlake.operators.spatial import _spare_key

    keys = df.where("a is null").select(_spare_key(df).alias("k")).distinct().count()
    assert keys > 290


def test_inner_cells_need_no_edges(spark):
    p = polys(spark, [(1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")])
    idx = PolygonIndex(p, ["pid"], cell_size=0.7)
    cells = idx.cells.select("_inside", F.col("_edges").isNull().alias("bare")).collect()
    assert all(r["_inside"] == r.bare for r in cells)
    assert sum(r["_inside"] for r in cells) > len(cells) / 3
    rnd = random.Random(4)
    data = [(i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(2000)] + [(2000, 5.0, 5.0), (2001, 4.0, 5.0), (2002, 0.0, 3.0)]
    pts = spark.createDataFrame(data, "i int, x double, y double").select("i", geo.point("x", "y").alias("pt"))
    inside = {i for i, x, y in data if 0 < x < 10 and 0 < y < 10 and not (4 <= x <= 6 and 4 <= y <= 6)}
    assert {r.i for r in idx.join(pts, "pt", {"pid": "pid"}).collect() if r.pid == 1} == inside


def test_index_bound_is_an_upper_bound(spark):
    p = polys(spark, _triangles(50, 1))
    idx = PolygonIndex(p, ["pid"], cell_size=0.5)
    assert idx.cells.count() <= idx.max_rows


def _ring(cx, cy, r, n, phase=0.0):
    import math

    pts = [(round(cx + r * math.cos(phase + 2 * math.pi * k / n), 6), round(cy + r * math.sin(phase + 2 * math.pi * k / n), 6)) for k in range(n)]
    return "(" + ", ".join(f"{x} {y}" for x, y in pts + pts[:1]) + ")"


def test_many_vertex_polygons_with_holes_small_cells(spark):
    wkts = [
        (1, f"POLYGON ({_ring(5, 5, 4, 400)}, {_ring(5, 5, 1.5, 150, 0.3)})"),
        (2, f"MULTIPOLYGON (({_ring(2, 8, 1.2, 90)}), ({_ring(8, 2, 1.0, 60)}))"),
    ]
    p = polys(spark, wkts)
    rnd = random.Random(21)
    pts = spark.createDataFrame(
        [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(4000)], "i int, x double, y double"
    ).select("i", geo.point("x", "y").alias("pt"))
    idx = PolygonIndex(p, ["pid"], cell_size=0.25)
    # clipping leaves each cell row far fewer edges than the polygon has
    assert idx.cells.select(F.max(F.size("_edges"))).first()[0] < 120
    grid = idx.join(pts, "pt", {"pid": "pid"})
    edges = p.select("pid", geo.ring_edges("geom").alias("edges"))
    loop = pts.join(F.broadcast(edges), geo.point_within(F.col("pt"), F.col("edges")), "left")
    a = sorted((r.i, r.pid or -1) for r in grid.select("i", "pid").collect())
    b = sorted((r.i, r.pid or -1) for r in loop.select("i", "pid").collect())
    assert a == b
    assert {pid for _, pid in a} == {-1, 1, 2}


def test_index_over_cell_budget_still_exact(spark):
    # more polygons than the cell budget: the cell size stops growing and the join stays exact
    p = polys(spark, _triangles(80, 7))
    idx = PolygonIndex(p, ["pid"], max_cells=50)
    assert idx.cells.count() <= idx.max_rows
    rnd = random.Random(2)
    pts = spark.createDataFrame(
        [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(1500)], "i int, x double, y double"
    ).select("i", geo.point("x", "y").alias("pt"))
    edges = p.select("pid", geo.ring_edges("geom").alias("edges"))
    loop = pts.join(F.broadcast(edges), geo.point_within(F.col("pt"), F.col("edges")), "left")
    a = sorted((r.i, r.pid or -1) for r in idx.join(pts, "pt", {"pid": "pid"}).select("i", "pid").collect())
    b = sorted((r.i, r.pid or -1) for r in loop.select("i", "pid").collect())
    assert a == b


def test_hot_location_holding_a_third_of_rows(spark, scratch):
    # one location (an airport centroid) holds a third of all points
    p = polys(spark, _triangles(30, 12) + [(99, "POLYGON ((4 4, 6 4, 6 6, 4 6, 4 4))")])
    rnd = random.Random(13)
    rows = [(i, 5.0, 5.0) if i % 3 == 0 else (i, round(rnd.uniform(0, 10), 2), round(rnd.uniform(0, 10), 2)) for i in range(9000)]
    df = spark.createDataFrame(rows, "i int, x double, y double").select("i", geo.point("x", "y").alias("pt"))
    idx = PolygonIndex(p, ["pid"])
    key = lambda r: (r.i, r.pid if r.pid is not None else -1)
    direct = sorted(map(key, idx.join(df, "pt", {"pid": "pid"}).select("i", "pid").collect()))
    looked_up = sorted(map(key, spatial_enrich(df, [("pt", idx, {"pid": "pid"})], lookup_path=scratch("points")).select("i", "pid").collect()))
    assert looked_up == direct
    # the same without broadcast joins: shuffled cell join with a hot cell
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = sorted(map(key, idx.join(df, "pt", {"pid": "pid"}).select("i", "pid").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert shuffled == direct
    assert sum(1 for i, pid in direct if i % 3 == 0 and pid == 99) == 3000
