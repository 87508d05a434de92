import datetime as dt

from pyspark.sql import functions as F

from urbanlake.plans import reports as rp

from helpers import by, covid, staged_trips, zips

D = dt.date


def test_dense_spine_zero_filled(spark):
    # 3 days x 4 ZIPs with one trip -> 12 rows, 11 zeros
    t = staged_trips(spark, [("a", D(2024, 1, 1), 1, None, None, None),
                             ("b", D(2024, 1, 2), None, None, None, None),
                             ("c", D(2024, 1, 3), None, None, None, None)])
    out = rp.report4c_daily(t, zips(spark, [1, 2, 3, 4]))
    assert out.count() == 12
    assert out.where(F.col("total_trip_count") == 0).count() == 11


def test_null_period_row_per_zip(spark):
    # A trip with a NULL date gives one NULL-period row per ZIP with total 0
    t = staged_trips(spark, [("a", None, 1, 1, None, None), ("b", D(2024, 1, 1), 1, None, None, None)])
    out = rp.report4c_daily(t, zips(spark, [1, 2]))
    nulls = out.where(F.col("date").isNull()).collect()
    assert len(nulls) == 2 and all(r.total_trip_count == 0 for r in nulls)
    # NULL dates sort first in the descending report order
    assert rp.ordered(out, "rpttbl04c").first().date is None


def test_week_without_covid_row(spark):
    # Weeks come from COVID; a ZIP without a COVID row that week has NULL week start, 0 cases
    t = staged_trips(spark, [("a", D(2024, 1, 2), 1, 2, None, None), ("x", D(2024, 3, 5), 1, None, None, None)])
    c = covid(spark, [("1", D(2023, 12, 31), 5)])
    out = rp.report1_severity(t, c, zips(spark, [1, 2]))
    got = {r.zip: (r.week_start, r.weekly_positive_cases, r.total_trip_count) for r in out.collect()}
    assert got == {1: (D(2023, 12, 31), 5, 1), 2: (None, 0, 1)}
    assert out.where(F.col("week_number") == "WEEK-10-2024").count() == 0  # trip week absent from COVID


def test_label_collision_merges_in_report1_not_4a(spark):
    # 1-1996 covers the weeks of Monday 1996-01-01 and 1996-12-30
    t = staged_trips(spark, [("a", D(1996, 1, 2), 1, None, None, None), ("b", D(1996, 12, 31), 1, None, None, None),
                             ("c", D(1996, 12, 31), 1, None, None, None)])
    c = covid(spark, [("1", D(1995, 12, 31), 4), ("1", D(1996, 12, 29), 6)])
    r1 = rp.report1_severity(t, c, zips(spark, [1])).collect()
    assert len(r1) == 2 and {r.total_trip_count for r in r1} == {3}  # merged trips, one row per COVID row
    r4 = by(rp.report4a_weekly(t, zips(spark, [1])), "week_start")
    assert [(r.week_number, r.total_trip_count, r.forecasted_trip_count) for r in r4] == [
        ("WEEK-1-1996", 1, 0), ("WEEK-1-1996", 2, 1)]


def test_report3_full_outer_and_high_without_trips(spark):
    t = staged_trips(spark, [("a", D(2024, 1, 2), None, None, 3, 4), ("b", D(2024, 1, 2), None, None, 4, 0),
                             ("n1", None, None, None, 3, None), ("n2", None, None, None, None, 3)])
    ccvi = spark.createDataFrame([(3, "HIGH"), (4, "High"), (5, "high"), (6, "low")], "community_area int, ccvi_category string")
    out = rp.report3_ccvi(t, ccvi).collect()
    got = sorted(((r.community_area, r.week_number, r.trips_from, r.trips_to) for r in out), key=str)
    # NULL-week sides stay apart; area 5 has no trips: NULL week and counts (S24); area 6 is not HIGH
    assert got == sorted([
        (3, "WEEK-1-2024", 1, 0), (4, "WEEK-1-2024", 1, 1),
        (3, None, 1, 0), (3, None, 0, 1), (5, None, None, None),
    ], key=str)


def test_report2_airports(spark):
    t = staged_trips(spark, [("a", D(2024, 1, 2), 3, 5, None, None), ("b", D(2024, 1, 2), 7, 5, None, None),
                             ("c", D(2024, 1, 2), 8, 5, None, None), ("d", D(2024, 1, 2), 3, None, None, None)])
    c = covid(spark, [("5", D(2023, 12, 31), 2)])
    out = rp.report2_airport(t, c, zips(spark, [5, 6]), {"Midway": [3], "O'Hare": [7, 8]})
    got = {(r.from_airport, r.to_zip_code): (r.trip_count, r.weekly_positive_cases) for r in out.collect()}
    assert got == {("Midway", 5): (1, 2), ("O'Hare", 5): (2, 2), ("Midway", 6): (0, 0), ("O'Hare", 6): (0, 0)}


def test_report5_sums_before_join(spark):
    health = spark.createDataFrame(
        [(i, float(i), None, float(i)) for i in range(1, 8)] + [(9, None, None, 1.0)],
        "community_area int, below_poverty_level double, per_capita_income decimal(18,2), unemployment double",
    )
    permits = spark.createDataFrame(
        [("p1", 7, "1.50"), ("p2", 7, "2.25"), ("p3", 6, None), ("p4", 1, "9.00")],
        "permit_no string, community_area int, fee string",
    ).select("permit_no", "community_area", F.col("fee").cast("decimal(18,2)").alias("subtotal_unpaid"))
    out = rp.ordered(rp.report5_waiver(health, permits), "rpttbl05").collect()
    got = [(r.community_area, None if r.total_fees_waived is None else str(r.total_fees_waived)) for r in out]
    # top 5: NULL score (area 9) first, then 7, 6, 5, 4; ordered by fee ascending, NULLs last
    assert got == [(7, "3.75"), (4, None), (5, None), (6, None), (9, None)]


def test_report6_null_zip_holds_minimum(spark):
    # Only the NULL-ZIP group has the minimum -> report empty
    permits = spark.createDataFrame(
        [("a", " PERMIT - NEW CONSTRUCTION ", 1, None), ("b", "PERMIT - NEW CONSTRUCTION", 1, 10),
         ("c", "PERMIT - NEW CONSTRUCTION", 1, 10), ("d", "OTHER", 1, 11)],
        "permit_no string, permit_type string, community_area int, zip int",
    )
    health = spark.createDataFrame([(1, 100.0)], "community_area int, per_capita_income double")
    assert rp.report6_loans(permits, health).count() == 0
    more = permits.union(spark.createDataFrame([("e", "PERMIT - NEW CONSTRUCTION", 1, None)], permits.schema))
    # now the NULL group and ZIP 10 tie at 2: ZIP 10 qualifies, the NULL group never joins
    assert sorted(r.permit_id for r in rp.report6_loans(more, health).collect()) == ["b", "c"]
    fewer = permits.where("zip is not null")
    assert sorted(r.permit_id for r in rp.report6_loans(fewer, health).collect()) == ["b", "c"]


def test_reports_from_shared_day_facts_equal_trip_scans(spark):
    import random

    from test_properties import _random_trips

    t = _random_trips(spark, 6000, 17)
    rnd = random.Random(4)
    # community areas with 0 / NULL and NULL days are in the random trips
    t = t.withColumn("pickup_community_area", F.when(F.rand(1) < 0.1, None).otherwise((F.rand(2) * 6).cast("int"))) \
         .withColumn("dropoff_community_area", F.when(F.rand(3) < 0.1, None).otherwise((F.rand(4) * 6).cast("int")))
    z = zips(spark, [0, 1, 2, 3, 4, 5, 6, 7, 9])
    airports = {"Midway": [3], "O'Hare": [5, 6]}
    days = rp.trip_day_facts(t, airports)
    c = covid(spark, [(str(k), D(2024, 1, 7) + dt.timedelta(weeks=w), k + w + rnd.randrange(3)) for k in range(6) for w in range(4)])
    ccvi = spark.createDataFrame([(a, "HIGH" if a % 2 else "low") for a in range(1, 9)], "community_area int, ccvi_category string")
    key = lambda r: tuple(str(x) for x in r)
    for a, b in [
        (rp.report1_severity(t, c, z), rp.report1_severity(None, c, z, days)),
        (rp.report2_airport(t, c, z, airports), rp.report2_airport(None, c, z, airports, days)),
        (rp.report3_ccvi(t, ccvi), rp.report3_ccvi(None, ccvi, days)),
        (rp.report4a_weekly(t, z), rp.report4a_weekly(None, z, days)),
        (rp.report4b_monthly(t, z), rp.report4b_monthly(None, z, days)),
        (rp.report4c_daily(t, z), rp.report4c_daily(None, z, days)),
    ]:
        assert sorted(key(r) for r in a.collect()) == sorted(key(r) for r in b.collect())
    # NULL-week sides stay apart through the day table too
    assert rp.area_week_counts_from_days(days).where("week_start is null").count() >= 2
