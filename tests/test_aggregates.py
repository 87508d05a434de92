import datetime as dt

from pyspark.sql import functions as F

from urbanlake.functions.columns import impute_area, severity
from urbanlake.operators import aggregates as agg

from helpers import staged_trips

D = dt.date


def test_union_distinct_total(spark):
    # Equal pickup/dropoff counts collapse (4 and 4 -> 4), else add (4 and 3 -> 7)
    rows = []
    k = 0
    for _ in range(4):
        rows.append((f"a{k}", D(2024, 1, 2), 1, 1, None, None))  # zip 1 as pickup and dropoff
        k += 1
    for _ in range(4):
        rows.append((f"b{k}", D(2024, 1, 2), 2, None, None, None))
        k += 1
    for _ in range(3):
        rows.append((f"c{k}", D(2024, 1, 2), None, 2, None, None))
        k += 1
    t = staged_trips(spark, rows)
    got = {r.zip: r.total_trip_count for r in agg.endpoint_totals(t, ["week_number"]).collect()}
    assert got == {1: 4, 2: 7}


def test_union_distinct_rows(spark):
    t = staged_trips(spark, [("a", D(2024, 1, 2), 1, 1, None, None), ("b", D(2024, 1, 2), 1, None, None, None)])
    g = agg.endpoint_counts(t, ["week_number"])
    got = sorted(r.trip_count for r in agg.union_distinct_rows(g, ["week_number"]).collect())
    assert got == [1, 2]  # pickup count 2, dropoff count 1


def test_count_ignores_null_ids(spark):
    # S16
    t = staged_trips(spark, [("a", D(2024, 1, 2), 1, None, None, None), (None, D(2024, 1, 2), 1, None, None, None),
                             ("c", D(2024, 1, 2), 1, None, None, None)])
    assert agg.endpoint_totals(t, ["week_number"]).first().total_trip_count == 2


def test_percentile_cont(spark):
    # 1, 2, 4, NULL at p = 0.25 -> 1.5
    df = spark.createDataFrame([(1,), (2,), (4,), (None,)], "v int")
    q = agg.quartiles(df, ["v"])
    r = df.limit(1).select(q["q1_v"].alias("q1"), q["q3_v"].alias("q3")).first()
    assert (r.q1, r.q3) == (1.5, 3.0)


def test_severity_truth_table(spark):
    # ranks: below Q1 -> 1, within [Q1, Q3] -> 2, above Q3 -> 3; sum >= 5 High, 4 Medium, else Low
    vals = {1: 0.0, 2: 5.0, 3: 20.0}
    data = [(a, b, vals[a], vals[b]) for a in (1, 2, 3) for b in (1, 2, 3)] + [(0, 0, None, 5.0)]
    df = spark.createDataFrame(data, "ra int, rb int, t double, c double")
    out = df.select("ra", "rb", severity(F.col("t"), F.col("c"), F.lit(1.0), F.lit(10.0), F.lit(1.0), F.lit(10.0)).alias("s"))
    for r in out.collect():
        if r.ra == 0:
            assert r.s == "Low"  # NULL average
        else:
            total = r.ra + r.rb
            assert r.s == ("High" if total >= 5 else "Medium" if total == 4 else "Low")


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(1.0, 10.0)], "t double, c double")
    s = df.select(severity(F.col("t"), F.col("c"), F.lit(1.0), F.lit(10.0), F.lit(10.0), F.lit(20.0))).first()[0]
    assert s == "Medium"  # t = Q1 and c = Q1 are both "within"


def test_top_k_nulls_first(spark):
    # Scores 1, NULL, 2 -> descending top-2 is NULL, 2
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "area int, score double")
    got = [r.score for r in agg.top_k(df, 2, [F.col("score").desc_nulls_first(), F.col("area")]).collect()]
    assert got == [None, 2.0]


def test_frames_inclusive_and_exclusive(spark):
    # Totals newest first 10, 20, 30, 40
    df = spark.createDataFrame([(1, D(2024, 1, 28), 10), (1, D(2024, 1, 21), 20), (1, D(2024, 1, 14), 30),
                                (1, D(2024, 1, 7), 40)], "zip int, ws date, n long")
    order = [F.col("ws").desc_nulls_first()]
    out = df.select(
        "ws",
        agg.trailing_avg("n", ["zip"], order, 0, 2).alias("incl"),
        agg.forecast_int(agg.trailing_avg("n", ["zip"], order, 1, 3)).alias("excl"),
    ).orderBy(F.col("ws").desc()).collect()
    assert out[0].incl == 20.0 and out[0].excl == 30 and out[-1].excl == 0


def test_forecast_rounds_half_away_from_zero(spark):
    # 2.5 -> 3, 3.5 -> 4, 2.4 -> 2
    df = spark.createDataFrame([(2.5,), (3.5,), (2.4,)], "a double")
    assert [r[0] for r in df.select(agg.forecast_int(F.col("a"))).collect()] == [3, 4, 2]


def test_impute_area(spark):
    # NULL and 0 are missing
    df = spark.createDataFrame([(None, 5), (0, 5), (7, 5)], "own int, m int")
    assert [r[0] for r in df.select(impute_area("own", "m")).collect()] == [5, 5, 7]


def test_keep_min_ties_and_null_group(spark):
    df = spark.createDataFrame([(1, 3), (2, 2), (3, 2), (None, 1)], "zip int, n long")
    assert sorted(r.zip if r.zip is not None else -1 for r in agg.keep_min(df, "n").collect()) == [-1]
    df2 = df.where("zip is not null")
    assert sorted(r.zip for r in agg.keep_min(df2, "n").collect()) == [2, 3]


def test_quartiles_approx_option(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as long) as v")
    exact = df.limit(1).select(agg.quartiles(df, ["v"]).alias("q")).first().q
    approx = df.limit(1).select(agg.quartiles(df, ["v"], approx=True).alias("q")).first().q
    assert (exact.q1_v, exact.q3_v) == (250.75, 750.25)
    assert abs(approx.q1_v - 250.75) <= 1 and abs(approx.q3_v - 750.25) <= 1
