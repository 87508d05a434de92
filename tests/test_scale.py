"""What keeps the larger queries in proportion to their input: files written by
several tasks, tables computed once, points that stay where they are."""

import os
import random

import pytest
from helpers import plan
from pyspark.sql import functions as F

from urbanlake.catalog import queries as q
from urbanlake.functions import geo
from urbanlake.operators.cover import DensityCover, node_code
from urbanlake.operators.spatial import PolygonIndex, within_left_join
from urbanlake.plans import reports as rp
from urbanlake.sources.landing import land_polygons

SF = "/root/testdata/sf0.001"


def squares(spark, n=5):
    rows = [(k, f"POLYGON (({k % n} {k // n}, {k % n + 1} {k // n}, {k % n + 1} {k // n + 1}, {k % n} {k // n + 1}, {k % n} {k // n}))") for k in range(n * n)]
    return land_polygons(spark.createDataFrame(rows, "pid int, the_geom string"))


@pytest.mark.parametrize("name, table, n", [("src_csv_trips", "lineitem", 6000), ("src_csv_permits", "orders", 1500)])
def test_csv_is_written_by_several_tasks(spark, monkeypatch, tmp_path, name, table, n):
    many = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/{table}.parquet").repartition(3).write.parquet(f"{many}/{table}.parquet")
    monkeypatch.setattr(q, "shared_dir", lambda spark, name: str(tmp_path / name))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task per file
    try:
        assert q.QUERIES[name](spark, many).count() == n
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len([f for f in os.listdir(tmp_path / name) if f.startswith("part-")]) == 3


def test_adaptive_join_leaves_the_points_in_place(spark):
    rnd = random.Random(4)
    rows = [(i, 2.5 + rnd.random() ** 4, 2.5) if i % 4 else (i, rnd.uniform(-1, 6), rnd.uniform(-1, 6)) for i in range(3000)] + [(3000, None, None)]
    pts = spark.createDataFrame(rows, "i int, x double, y double").repartition(3).select("i", geo.point("x", "y").alias("pt"))
    index = PolygonIndex(squares(spark), ["pid"])
    cover = DensityCover(index, pts, "pt", leaf_rows=20)
    joined = index.join(pts, "pt", {"pid": "pid"}, cover=cover)
    assert "hashpartitioning(_pc" not in plan(joined) and "SortMergeJoin" not in plan(joined)
    # each point's leaf, walked down the tree
    d, seen = cover.depth, set()
    placed = cover.place(pts, F.col("pt")["x"], F.col("pt")["y"], "at", F.lit(5).cast("long")).where("pt IS NOT NULL")
    for r in placed.select("pt", "at").collect():
        fx, fy = int(r.pt.x // (index.cell / 2**d)), int(r.pt.y // (index.cell / 2**d))
        tree, level = cover.trees.get((fx >> d, fy >> d), {}), 0
        code = lambda k: node_code(k, (fx >> (d - k)) & ((1 << k) - 1), (fy >> (d - k)) & ((1 << k) - 1))
        while level < d and code(level) in tree:
            level += 1
        copies = tree.get(code(d), 1) if level == d else 1
        assert r["at"].asDict() == {"l": level, "x": fx >> (d - level), "y": fy >> (d - level), "s": 5 % copies}
        seen.add(level)
    assert len(seen) > 3


def test_small_index_is_a_local_table_of_finer_cells(spark):
    index = PolygonIndex(squares(spark), ["pid"])
    assert "LocalTableScan" in plan(index.cells) and index.cell < 1
    pts = spark.range(50).select("id", geo.point(F.col("id") / 10 + 0.05, F.lit(2.5)).alias("pt"))
    joined = within_left_join(pts, "pt", index, {"pid": "pid"})
    assert "Exchange hashpartitioning" not in plan(joined)
    assert sorted((r.id, r.pid) for r in joined.collect()) == [(i, 10 + i // 10) for i in range(50)]


@pytest.mark.parametrize("name", ["geo_parse_multipolygon", "src_csv_polygons"])
def test_one_scan_of_the_trips_counts_both_layers(spark, name):
    tree = plan(q.QUERIES[name](spark, SF)).split("\n\n")[0]
    assert tree.count("Generate") == 1  # the points, each parsed once


def test_reports_read_what_was_written_once(spark):
    for name, df in q._all_reports(q.Inputs(spark, SF)).items():
        text = plan(df)
        assert "lineitem.parquet" not in text and "orders.parquet" not in text, name


def test_day_counts_are_added_up_before_the_only_shuffle(spark):
    trips = spark.createDataFrame([("a", None, 1, 2, 3, 4)] * 3 + [(None, None, 1, 2, 0, 4)], "trip_id string, trip_start date, pickup_zip int, dropoff_zip int, pickup_community_area int, dropoff_community_area int")
    days = rp.trip_day_facts(trips, {"Midway": [1]})
    assert plan(days).split("\n\n")[0].count("Exchange") == 1
    assert sorted(tuple(r) for r in days.drop("trip_start").collect()) == [
        ("air", 1, 2, 3, 0, True, False),
        ("area", 3, None, 3, 0, True, False),
        ("area", 4, None, 0, 3, False, True),
        ("zip", 1, None, 3, 0, True, False),
        ("zip", 2, None, 0, 3, False, True),
    ]
