"""Incremental refresh of the trip reports against a full rebuild."""

import datetime as dt
import random

import pytest
from helpers import covid, plan, staged_trips, zips
from pyspark.sql import functions as F

from urbanlake import sinks
from urbanlake.plans import pipeline, refresh
from urbanlake.plans import reports as rp
from urbanlake.sources import driver_tables as dt_tables

AIR = {"Midway": [1], "O'Hare": [2]}


def trips_of(days, seed):
    rnd = random.Random(seed)
    out = []
    for day in days:
        for _ in range(rnd.randrange(1, 4)):
            out.append((f"t{len(out)}", day, rnd.choice([1, 2, 3, None]), rnd.choice([1, 2, 3]), rnd.choice([7, 8, 0, None]), rnd.choice([7, 8, 9])))
    return out


def facts(spark, trips):
    return pipeline.day_facts_of(staged_trips(spark, trips), None, AIR).withColumn("month_number", F.col("month_number"))


def same(spark, got, want):
    for name in want:
        a, b = got[name].select(sorted(want[name].columns)), want[name].select(sorted(want[name].columns))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def full(spark, f, c, ccvi, z):
    out = {name: refresh.rebuild(name, f, c, ccvi, z, AIR) for name in refresh.SHAPES}
    return {**out, "rpttbl01": rp.report1_severity(None, c, z, f)}


START = dt.date(1995, 12, 4)
DAYS = [START + dt.timedelta(days=3 * k) for k in range(150)]


@pytest.mark.parametrize("change", ["middle", "new", "gone", "null", "border"])
def test_equals_a_full_rebuild(spark, scratch, change):
    z = zips(spark, [1, 2, 3, 4])
    ccvi = spark.createDataFrame([(7, "HIGH"), (8, "low"), (9, "high"), (10, "High")], "community_area int, ccvi_category string")
    weeks = sorted({refresh.sunday(d) for d in DAYS})[:60:2]
    rows = [(str(k), w, 5 * k + i) for i, w in enumerate(weeks) for k in (1, 2, 4)]
    before = trips_of([*DAYS, None], 1)
    touched = {"middle": DAYS[40:42], "new": [dt.date(1996, 6, 2), dt.date(1997, 3, 1), dt.date(1995, 1, 1)], "gone": DAYS[60:75], "null": [None], "border": [dt.date(1996, 12, 30), dt.date(1996, 1, 1)]}[change]
    after = [t for t in before if t[1] not in touched] + ([] if change == "gone" else trips_of(touched, 9))
    cases = rows if change != "border" else [*rows, ("2", dt.date(1996, 12, 29), 3)]
    root, facts_path = scratch("reports"), scratch("facts")
    for f, c, days in ((facts(spark, before), covid(spark, rows), None), (facts(spark, after), covid(spark, cases), touched)):
        sinks.write_table(f, facts_path, partition_by=["month_number"])
        f = sinks.scan_table(spark, facts_path, schema=f.schema)
        got = refresh.refresh(spark, root, f, c, ccvi, z, days, AIR)
        same(spark, got, full(spark, f, c, ccvi, z))


def test_only_touched_months_are_read(spark, scratch):
    f = facts(spark, trips_of(DAYS, 3))
    path = scratch("facts")
    sinks.write_table(f, path, partition_by=["month_number"])
    f = sinks.scan_table(spark, path, schema=f.schema)
    parts, days = refresh.affected_parts(refresh.SHAPES["rpttbl04c"], DAYS, [DAYS[40]])
    assert parts == {199604} and {refresh.month_of(d) for d in days} == {"3-1996", "4-1996", "2-1997"}
    some = refresh.in_days(f, days)
    text = plan(refresh.rebuild("rpttbl04c", some, None, None, zips(spark, [1]), AIR))
    filters = text.split("PartitionFilters: ")[1].split("\n")[0]
    assert "month_number" in filters and "4-1996" in filters and "7-1996" not in filters
    assert some.select(F.input_file_name()).distinct().count() == 3 < len(f.inputFiles()) / 4


def test_parts_of_a_change():
    shape = refresh.SHAPES["rpttbl04a"]
    days = [dt.date(1995, 12, 10) + dt.timedelta(weeks=k) for k in range(30)]
    assert refresh.affected_parts(shape, days, [dt.date(1995, 12, 19)])[0] == {1995, 1996}  # its forecast reaches January
    assert refresh.affected_parts(shape, days, [days[10]])[0] == {1996}
    assert refresh.affected_parts(shape, days, [None])[0] == set()
    assert refresh.affected_parts(refresh.SHAPES["rpttbl01"], days, [dt.date(1996, 12, 31)])[0] == {1996}


def test_pipeline_refreshes_what_a_batch_reaches(spark, scratch):
    sf = "/root/testdata/sf0.001"
    raw = {name: (lambda fn=fn: fn(spark, sf)) for name, fn in dt_tables.RAW.items()}
    cut = F.col("trip_start") < F.lit("1996-05-01").cast("date")

    def deliver(keep, weeks):
        return {
            **raw,
            "taxi_trips": lambda: dt_tables.RAW["taxi_trips"](spark, sf).where(keep),
            "covid_by_zip": lambda: dt_tables.RAW["covid_by_zip"](spark, sf).where(weeks),
            "building_permit": lambda: dt_tables.RAW["building_permit"](spark, sf).where("false"),
        }

    late = F.col("week_start") >= F.lit("1996-05-01").cast("date")
    root, mode = scratch("pipe"), {"summarised": "refresh"}
    run = lambda r, b: pipeline.run_pipeline(spark, r, root, mode=mode, batch=b, airports=dt_tables.TEST_AIRPORTS)
    run(deliver(cut, ~late), "b1")
    w = run(deliver(~cut & (F.month("trip_start") < 9), late), "b2")
    trips, covid_rows = sinks.scan_table(spark, w["staging.trips_data"]), sinks.scan_table(spark, w["staging.covid_by_zip"])
    land = {k: sinks.scan_table(spark, w[f"landing.{k}"]) for k in ("boundaries_zip",)}
    ccvi = sinks.scan_table(spark, w["staging.ccvi_by_ca"])
    z = land["boundaries_zip"]
    want = {
        "rpttbl01": rp.report1_severity(trips, covid_rows, z),
        "rpttbl02": rp.report2_airport(trips, covid_rows, z, dt_tables.TEST_AIRPORTS),
        "rpttbl03": rp.report3_ccvi(trips, ccvi),
        "rpttbl04a": rp.report4a_weekly(trips, z),
        "rpttbl04b": rp.report4b_monthly(trips, z),
        "rpttbl04c": rp.report4c_daily(trips, z),
    }
    same(spark, {k: spark.read.parquet(w[f"summarised.{k}"]) for k in want}, want)
