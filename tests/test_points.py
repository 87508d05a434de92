"""Kept point dictionary."""

import random

from pyspark.sql import functions as F

from urbanlake.functions import geo
from urbanlake.operators.cover import DensityCover
from urbanlake.operators.points import PointDictionary
from urbanlake.operators.spatial import PolygonIndex, spatial_enrich
from urbanlake.sinks import files
from urbanlake.sources.landing import land_polygons


def polygons(spark, name, shift=0.0):
    squares = [(k, f"POLYGON (({k % 3 + shift} {k // 3}, {k % 3 + 1.5} {k // 3}, {k % 3 + 1.5} {k // 3 + 1}, {k % 3 + shift} {k // 3 + 1}, {k % 3 + shift} {k // 3}))") for k in range(9)]
    return land_polygons(spark.createDataFrame(squares, f"{name} int, the_geom string"))


def points(spark, seed, n=300):
    rnd = random.Random(seed)
    rows = [(i, round(rnd.uniform(-1, 5), 1), round(rnd.uniform(-1, 4), 1)) for i in range(n)]
    rows += [(n, None, None), (n + 1, float("nan"), 1.0), (n + 2, -0.0, 0.5), (n + 3, 0.0, 0.5)]
    return spark.createDataFrame(rows, "i int, x double, y double").select("i", geo.point("x", "y").alias("pt"))


def rows(df):
    return sorted((r.i, -1 if r.zip is None else r.zip, -1 if r.area is None else r.area) for r in df.select("i", "zip", "area").collect())


def test_second_run_matches_no_old_point(spark, scratch):
    zips, areas = PolygonIndex(polygons(spark, "zip"), ["zip"]), PolygonIndex(polygons(spark, "area", 0.25), ["area"])
    path, first, second = scratch("points"), points(spark, 1), points(spark, 2)
    known = PointDictionary(spark, path, [zips, areas])
    distinct = lambda *dfs: len({(r.pt.x + 0.0, r.pt.y) for df in dfs for r in df.collect() if r.pt and r.pt.x == r.pt.x})
    assert known.update([(first, ["pt"])]) == distinct(first)
    assert known.update([(first, ["pt"])]) == 0
    # another session finds them too, and matches the new ones only, of both tables in one go
    again = PointDictionary(spark, path, [PolygonIndex(polygons(spark, "zip"), ["zip"]), PolygonIndex(polygons(spark, "area", 0.25), ["area"])])
    assert again.path == known.path
    assert again.update([(first, ["pt"]), (second, ["pt"])]) == distinct(first, second) - distinct(first)
    assert again.lookup().count() == distinct(first, second)
    for df in (first, second):
        joins = [("pt", again.layers[0], {"zip": "zip"}), ("pt", again.layers[1], {"area": "area"})]
        assert rows(spatial_enrich(df, joins, dictionary=again)) == rows(spatial_enrich(df, joins))


def test_a_changed_layer_drops_the_table(spark, scratch):
    path, pts = scratch("points"), points(spark, 3)
    old = PointDictionary(spark, path, [PolygonIndex(polygons(spark, "zip"), ["zip"])])
    n = old.update([(pts, ["pt"])])
    moved = PointDictionary(spark, path, [PolygonIndex(polygons(spark, "zip", 0.5), ["zip"])])
    assert moved.path != old.path and moved.update([(pts, ["pt"])]) == n
    assert files.subfolders(spark, path) == [moved.path.rsplit("/", 1)[1]]
    # the order of the polygons does not make a version
    turned = PolygonIndex(polygons(spark, "zip", 0.5).orderBy(F.desc("zip")), ["zip"])
    assert PointDictionary(spark, path, [turned]).path == moved.path


def test_points_appended_twice_count_once(spark, scratch):
    """Two runs that do not see each other's points append the same ones."""
    index, pts = PolygonIndex(polygons(spark, "zip"), ["zip"]), points(spark, 4)
    one = PointDictionary(spark, scratch("points"), [index])
    one.update([(pts, ["pt"])])
    one._stored().write.mode("append").parquet(one.path + "/../copy")
    spark.read.parquet(one.path + "/../copy").write.mode("append").parquet(one.path)
    joins = [("pt", index, {"zip": "zip"})]
    got = spatial_enrich(pts, joins, dictionary=one)
    assert sorted(map(str, got.collect())) == sorted(map(str, spatial_enrich(pts, joins).select(got.columns).collect()))


def test_with_a_cover_and_without_points(spark, scratch):
    index = PolygonIndex(polygons(spark, "zip"), ["zip"])
    known = PointDictionary(spark, scratch("points"), [index], cover=DensityCover)
    assert known.update([(points(spark, 5).where("i < 0"), ["pt"])]) == 0
    pts = points(spark, 5)
    known.update([(pts, ["pt"])])
    joins = [("pt", index, {"zip": "zip"})]
    got = spatial_enrich(pts, joins, dictionary=known)
    assert sorted(map(str, got.collect())) == sorted(map(str, spatial_enrich(pts, joins).select(got.columns).collect()))
