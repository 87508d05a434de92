import csv
import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from urbanlake import schemas, sinks
from urbanlake.catalog.queries import Inputs
from urbanlake.operators import aggregates as agg
from urbanlake.operators.spine import dense_spine
from urbanlake.plans import reports as rp
from urbanlake.plans.pipeline import REFERENCE_RERUN_MODES, day_facts_of, run_pipeline
from urbanlake.sources import driver_tables as dt_tables

from helpers import oracle_count, plan, staged_trips


def _random_trips(spark, n, seed):
    rnd = random.Random(seed)
    day0 = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        rows.append((
            None if rnd.random() < 0.05 else f"t{i % (n // 2)}",
            None if rnd.random() < 0.02 else day0 + dt.timedelta(days=rnd.randrange(40)),
            None if rnd.random() < 0.3 else rnd.randrange(8),
            None if rnd.random() < 0.3 else rnd.randrange(8),
            None, None,
        ))
    return staged_trips(spark, rows)


def test_one_scan_totals_equal_union_then_sum(spark):
    # R3 / S5 on 20,000 random rows with NULL ids, dates and ZIPs
    t = _random_trips(spark, 20000, 3)
    for period in ("week_number", "trip_start"):
        fused = agg.endpoint_totals(t, [period])
        p = t.where(F.col("pickup_zip").isNotNull()).groupBy(period, F.col("pickup_zip").alias("zip")).agg(F.count("trip_id").alias("n"))
        d = t.where(F.col("dropoff_zip").isNotNull()).groupBy(period, F.col("dropoff_zip").alias("zip")).agg(F.count("trip_id").alias("n"))
        literal = p.union(d).distinct().groupBy(period, "zip").agg(F.sum("n").alias("total_trip_count"))
        a = sorted(map(tuple, fused.select(period, "zip", "total_trip_count").collect()), key=str)
        b = sorted(map(tuple, literal.collect()), key=str)
        assert a == b
        # the distinct union really drops rows here, so the test has teeth
        assert p.union(d).count() > p.union(d).distinct().count()


def test_union_distinct_rows_equal_literal_union(spark):
    t = _random_trips(spark, 5000, 8)
    rows = agg.union_distinct_rows(agg.endpoint_counts(t, ["week_number"]), ["week_number"])
    p = t.where(F.col("pickup_zip").isNotNull()).groupBy("week_number", F.col("pickup_zip").alias("zip")).agg(F.count("trip_id").alias("trip_count"))
    d = t.where(F.col("dropoff_zip").isNotNull()).groupBy("week_number", F.col("dropoff_zip").alias("zip")).agg(F.count("trip_id").alias("trip_count"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, p.union(d).distinct().collect()), key=str)


def test_spine_size_is_product(spark):
    t = _random_trips(spark, 3000, 5)
    zips = spark.createDataFrame([(z,) for z in [1, 2, 3, 3, None]], "zip int")
    spine = dense_spine(t.select("trip_start"), zips)
    n_days = t.select("trip_start").distinct().count()
    assert spine.count() == n_days * 4  # NULL day and NULL ZIP kept once each
    assert spine.distinct().count() == spine.count()


def test_pipeline_modes(spark, scratch):
    # Ignore leaves existing tables; a re-run like the reference's appends
    # to landing and staging (staging re-reads the doubled landing) and skips reports
    sf = "/root/testdata/sf0.001"
    raw = {name: (lambda fn=fn: fn(spark, sf)) for name, fn in dt_tables.RAW.items()}
    root = scratch("pipe")
    w = run_pipeline(spark, raw, root, airports=dt_tables.TEST_AIRPORTS, csv_out=True)
    n = {k: sinks.scan_table(spark, p).count() for k, p in w.items() if not k.startswith("export.")}
    assert n["summarised.rpttbl01"] == oracle_count("report1_severity", sf)
    assert sinks.read_report_csv(spark, w["export.rpttbl04c"], "rpttbl04c").count() == n["summarised.rpttbl04c"]

    run_pipeline(spark, raw, root, mode="ignore", airports=dt_tables.TEST_AIRPORTS)
    assert {k: sinks.scan_table(spark, w[k]).count() for k in n} == n

    run_pipeline(spark, raw, root, mode=REFERENCE_RERUN_MODES, airports=dt_tables.TEST_AIRPORTS)
    after = {k: sinks.scan_table(spark, w[k]).count() for k in n}
    assert after["landing.public_health"] == 2 * n["landing.public_health"]
    assert after["staging.public_health"] == 3 * n["staging.public_health"]
    assert all(after[k] == n[k] for k in n if k.startswith("summarised."))


def _trip_reports(i, days, trips=None):
    covid, zips, ccvi = i.stg_covid, i.zips, i.stg_ccvi
    return {
        "rpttbl01": rp.report1_severity(trips, covid, zips, days),
        "rpttbl02": rp.report2_airport(trips, covid, zips, dt_tables.TEST_AIRPORTS, days),
        "rpttbl03": rp.report3_ccvi(trips, ccvi, days),
        "rpttbl04a": rp.report4a_weekly(trips, zips, days),
        "rpttbl04b": rp.report4b_monthly(trips, zips, days),
        "rpttbl04c": rp.report4c_daily(trips, zips, days),
    }


def _sorted(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("mode", ["append", {"staging": "append"}])
def test_reruns_count_every_staged_trip_once(spark, scratch, mode):
    # the per-day counts follow the staged trips, whatever the mode
    sf = "/root/testdata/sf0.001"
    raw = {name: (lambda fn=fn: fn(spark, sf)) for name, fn in dt_tables.RAW.items()}
    root = scratch("pipe")
    run_pipeline(spark, raw, root, airports=dt_tables.TEST_AIRPORTS)
    w = run_pipeline(spark, raw, root, mode=mode, airports=dt_tables.TEST_AIRPORTS)
    trips = sinks.scan_table(spark, w["staging.trips_data"])
    days = sinks.scan_table(spark, w["staging.trip_day_facts"])
    i = Inputs(spark, sf)
    straight, counted = _trip_reports(i, None, trips), _trip_reports(i, days)
    for name in straight:
        assert _sorted(counted[name]) == _sorted(straight[name]), name
    if mode != "append":  # the written reports were overwritten from the same counts
        assert _sorted(sinks.scan_table(spark, w["summarised.rpttbl04c"])) == _sorted(straight["rpttbl04c"])


def test_one_month_is_replaced_and_pruned(spark, scratch):
    sf = "/root/testdata/sf0.001"
    raw = {name: (lambda fn=fn: fn(spark, sf)) for name, fn in dt_tables.RAW.items()}
    root = scratch("pipe")
    w = run_pipeline(spark, raw, root, airports=dt_tables.TEST_AIRPORTS)
    trips = sinks.scan_table(spark, w["staging.trips_data"])
    before = {r.month_number: r["count"] for r in trips.groupBy("month_number").count().collect()}
    march = F.date_format("trip_start", "M-yyyy") == "3-1995"
    raw["taxi_trips"] = lambda: dt_tables.RAW["taxi_trips"](spark, sf).where(march & (F.col("dropoff_community_area") > 5))
    run_pipeline(spark, raw, root, mode={"staging": "replace"}, airports=dt_tables.TEST_AIRPORTS)
    trips = spark.read.parquet(w["staging.trips_data"])
    after = {r.month_number: r["count"] for r in trips.groupBy("month_number").count().collect()}
    assert 0 < after["3-1995"] < before["3-1995"]
    assert {m: n for m, n in after.items() if m != "3-1995"} == {m: n for m, n in before.items() if m != "3-1995"}
    days = sinks.scan_table(spark, w["staging.trip_day_facts"])
    i = Inputs(spark, sf)
    assert _sorted(_trip_reports(i, days)["rpttbl04c"]) == _sorted(_trip_reports(i, None, trips)["rpttbl04c"])
    text = plan(day_facts_of(trips, ["3-1995"], dt_tables.TEST_AIRPORTS))
    assert "PartitionFilters" in text and "3-1995" in text.split("PartitionFilters")[1].split("\n")[0]


def test_exports_are_in_report_order_across_files(spark, scratch):
    i = Inputs(spark, "/root/testdata/sf0.001")
    days = i.days
    frames = {
        **_trip_reports(i, days),
        "rpttbl05": rp.report5_waiver(i.stg_health, i.stg_permits),
        "rpttbl06": rp.report6_loans(i.stg_permits, i.stg_health),
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, df in frames.items():
            path, order = scratch("export"), rp.report_order(name)
            table = scratch("table")
            sinks.write_table(df.repartition(6), table)
            sinks.write_csv(sinks.scan_table(spark, table), path, headers=schemas.REPORT_HEADERS[name], order=order)
            files = sorted(glob.glob(path.removeprefix("file:") + "/part-*.csv"))
            if name not in ("rpttbl05", "rpttbl06"):
                assert len(files) >= 4, name
            got = []
            for f in files:
                with open(f, newline="") as lines:
                    got += list(csv.reader(lines))[1:]
            want = df.orderBy(*order).collect() if order else []
            keys = [c for c in schemas.REPORT_HEADERS[name]]
            text = lambda v: "" if v is None else str(v)
            if order:
                assert len(got) == len(want)
                used = [k for k, c in enumerate(keys) if c in {"week_start", "date", "month_number", "zip", "from_airport", "to_zip_code", "community_area", "total_fees_waived"}]
                assert [[r[k] for k in used] for r in got] == [[text(r[keys[k]]) for k in used] for r in want], name
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
