"""Density-adaptive cover: same rows as the plain grid, even tasks."""

import random
from contextlib import contextmanager
from statistics import median

import pytest
from pyspark.sql import functions as F

from urbanlake.functions import geo
from urbanlake.operators.cover import DensityCover, node_counts
from urbanlake.operators.spatial import PolygonIndex, point_matches, spatial_enrich, within_left_join
from urbanlake.sources.landing import land_polygons


@contextmanager
def shuffled_joins(spark):
    """No broadcast of the layer, no skew join, no coalescing: tasks are what the keys make them."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def polygons(spark, rows):
    return land_polygons(spark.createDataFrame(rows, "pid int, the_geom string"))


def layer(spark, seed=3):
    rnd = random.Random(seed)
    wkts = [(k, f"POLYGON (({10 * (k % 4)} {10 * (k // 4)}, {10 * (k % 4) + 10} {10 * (k // 4)}, {10 * (k % 4) + 10} {10 * (k // 4) + 10}, {10 * (k % 4)} {10 * (k // 4) + 10}, {10 * (k % 4)} {10 * (k // 4)}))") for k in range(16)]
    for k in range(16, 60):  # overlapping triangles, crowded where the points are
        x, y = (rnd.uniform(10, 20), rnd.uniform(10, 20)) if k % 2 else (rnd.uniform(0, 40), rnd.uniform(0, 40))
        r = rnd.uniform(0.2, 4)
        wkts.append((k, f"POLYGON (({x} {y}, {x + r} {y}, {x} {y + r}, {x} {y}))"))
    return polygons(spark, wkts)


def points(spark, n=6000, hot="area"):
    """Nine of ten points in one grid cell (or at one place), some on polygon corners, some missing."""
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        if i % 10:
            rows.append((i, 13.3, 17.25) if hot == "place" else (i, 10 + 10 * rnd.random() ** 3, 10 + 10 * rnd.random()))
        else:
            rows.append((i, rnd.uniform(-5, 45), rnd.uniform(-5, 45)))
    rows += [(n, 10.0, 10.0), (n + 1, 20.0, 15.0), (n + 2, None, None), (n + 3, -0.001, 3.0)]
    df = spark.createDataFrame(rows, "i int, x double, y double").repartition(4)
    return df.select("i", geo.point("x", "y").alias("pt"))


def pairs(df):
    return sorted((r.i, -1 if r.pid is None else r.pid) for r in df.select("i", "pid").collect())


@pytest.mark.parametrize("hot", ["area", "place"])
def test_hot_cell_is_dealt_evenly(spark, hot):
    pts, index = points(spark, 20_000, hot), PolygonIndex(layer(spark), ["pid"], cell_size=10.0)
    with shuffled_joins(spark):
        cover = DensityCover(index, pts, "pt")
        joined = index.join(pts, "pt", {"pid": "pid"}, cover=cover)
        assert "BroadcastNestedLoopJoin" not in joined._jdf.queryExecution().toString()
        placed = cover.place(pts, F.col("pt")["x"], F.col("pt")["y"], "at", F.xxhash64("i")).where("pt IS NOT NULL")
        sizes = [r["count"] for r in placed.repartition("at.l", "at.x", "at.y", "at.s").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * median(sizes)
        tasks = [r["count"] for r in joined.dropDuplicates(["i"]).groupBy(F.col("i") % 1).count().collect()]
        assert sum(tasks) == 20_004
        grid = index.join(pts, "pt", {"pid": "pid"})
        assert pairs(joined) == pairs(grid)


def test_equals_the_grid_for_any_leaf_size_and_depth(spark):
    pts, index = points(spark, 1500), PolygonIndex(layer(spark), ["pid"], cell_size=7.0)
    want = pairs(index.join(pts, "pt", {"pid": "pid"}))
    for leaf_rows, depth in ((1, 3), (20, 6), (500, 1), (10**6, 9)):
        cover = DensityCover(index, pts, "pt", leaf_rows=leaf_rows, depth=depth)
        assert pairs(index.join(pts, "pt", {"pid": "pid"}, cover=cover)) == want
    assert not cover.trees  # nothing is crowded at a million points a leaf


def test_equals_the_exact_predicate(spark):
    pts, p = points(spark, 1200), layer(spark, 5)
    edges = p.select("pid", geo.ring_edges("geom").alias("edges"))
    loop = pts.join(F.broadcast(edges), geo.point_within(F.col("pt"), F.col("edges")), "left")
    assert pairs(within_left_join(pts, "pt", p, {"pid": "pid"}, cell_size=12.0, cover=DensityCover)) == pairs(loop)


def test_both_paths_of_enrich_take_a_cover(spark, scratch):
    pts = points(spark, 1500).withColumn("b", F.col("pt"))
    one, two = PolygonIndex(layer(spark), ["pid"], cell_size=10.0), PolygonIndex(layer(spark, 9), ["pid"], cell_size=4.0)
    joins = [("pt", one, {"pid": "pid"}), ("b", two, {"other": "pid"})]
    rows = lambda df: sorted((r.i, r.pid or -1, r.other or -1) for r in df.collect())
    want = rows(spatial_enrich(pts, joins))
    assert rows(spatial_enrich(pts, joins, cover=DensityCover)) == want
    assert rows(spatial_enrich(pts, joins, lookup_path=scratch("points"), cover=DensityCover)) == want


def test_matches_of_distinct_points(spark):
    pts = points(spark, 800).select(F.col("pt").alias("_pt")).where("_pt IS NOT NULL").distinct()
    index = PolygonIndex(layer(spark), ["pid"], cell_size=10.0)
    cover = DensityCover(index, pts, "_pt", leaf_rows=5)
    key = lambda r: (r.x, r.y, sorted(m.pid for m in r.m0))
    assert sorted(map(key, point_matches(pts, [index], [cover]).collect())) == sorted(map(key, point_matches(pts, [index]).collect()))


def test_counts_add_up_level_by_level(spark):
    pts = points(spark, 400)
    counts = node_counts(pts, F.col("pt")["x"], F.col("pt")["y"], 10.0, 4).collect()
    by_level = {}
    for r in counts:
        by_level[r.level] = by_level.get(r.level, 0) + r.n
    assert by_level == {level: 403 for level in range(5)}
    cells = {(r.x, r.y): r.n for r in counts if r.level == 0}
    direct = pts.where("pt IS NOT NULL").groupBy(F.floor(F.col("pt.x") / 10.0).alias("x"), F.floor(F.col("pt.y") / 10.0).alias("y")).count().collect()
    assert cells == {(r.x, r.y): r["count"] for r in direct}


def test_empty_points(spark):
    index = PolygonIndex(layer(spark), ["pid"])
    nothing = points(spark, 10).where("i < 0")
    assert DensityCover(index, nothing, "pt").trees == {}
    assert within_left_join(nothing, "pt", index, {"pid": "pid"}, cover=DensityCover).collect() == []
