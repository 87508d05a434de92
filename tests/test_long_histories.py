"""Windows split by range against the plain window."""

import datetime as dt
import random

import pytest
from helpers import plan
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from urbanlake.operators.aggregates import trailing_avgs_by_range
from urbanlake.plans import reports as rp


@pytest.mark.parametrize(("start", "end"), [(0, 2), (1, 3)])
def test_equals_the_plain_window(spark, start, end):
    rnd = random.Random(3)
    rows = [(k, dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randrange(9000)) if rnd.random() < 0.9 else None, i, float(rnd.randrange(50))) for i in range(700) for k in [rnd.choice([1, 1, 1, 2, None])]]
    rows += [(3, dt.date(1991, 5, 5), 1000, 2.0), (3, dt.date(2013, 1, 1), 1001, 4.0), (4, None, 1002, 5.0)]  # chunks with few rows or none between
    df = spark.createDataFrame(rows, "k int, d date, i int, v double").repartition(5)
    order = [F.col("d").desc_nulls_first(), F.col("i")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(start, end)
    want = {r.i: r.a for r in df.withColumn("a", F.avg("v").over(w)).collect()}
    got = trailing_avgs_by_range(df, {"a": "v"}, ["k"], order, F.year("d"), start, end)
    assert got.columns == ["k", "d", "i", "v", "a"]
    assert {r.i: r.a for r in got.collect()} == want
    exchanges = [line for line in plan(got).split("\n") if "hashpartitioning" in line]
    assert exchanges and all("_chunk" in line for line in exchanges)  # none by the key alone


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, d date, v double")
    assert trailing_avgs_by_range(df, {"a": "v"}, ["k"], [F.col("d").desc()], F.year("d"), 0, 2).collect() == []


def test_report1_averages_by_year(spark):
    rnd = random.Random(1)
    rows = []
    for z in (1, 2):
        for k in range(160):
            d = dt.date(1995, 1, 1) + dt.timedelta(weeks=k)
            monday = d + dt.timedelta(days=1)
            rows.append((None if rnd.random() < 0.3 else d, f"{monday.isocalendar()[1]}-{monday.year}", z, rnd.randrange(9), rnd.randrange(9)))
    base = spark.createDataFrame(rows, "week_start date, week_number string, zip int, total_trip_count long, weekly_positive_cases long")
    plain, split = rp.report1_averages(base), rp.report1_averages(base, by_year=True)
    assert sorted(map(str, split.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
