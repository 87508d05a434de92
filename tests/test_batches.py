"""Restartable append: a run that stops anywhere is repeated without doubling."""

import pytest
from pyspark.sql import functions as F

from urbanlake import sinks
from urbanlake.plans import pipeline
from urbanlake.sinks import batches, files
from urbanlake.sources import driver_tables as dt_tables

SF = "/root/testdata/sf0.001"


class Killed(Exception):
    pass


def stop_after(monkeypatch, module, name, n):
    """Let ``name`` work ``n`` times, then stop the run."""
    real, calls = getattr(module, name), []

    def call(*a, **k):
        if len(calls) == n:
            raise Killed
        calls.append(name)
        return real(*a, **k)

    monkeypatch.setattr(module, name, call)


def table(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "m").collect()))


@pytest.mark.parametrize(("step", "n"), [("write_table", 0), ("touch", 0), ("move", 0), ("move", 1), ("touch", 1), ("delete", 0)])
def test_killed_between_any_two_steps(spark, scratch, monkeypatch, step, n):
    path = scratch("batch")
    rows = lambda a, b: spark.range(a, b, 1, 4).select(F.col("id").alias("k"), (F.col("id") % 3).alias("m"))
    assert batches.append_batch(spark, lambda: rows(0, 10), path, "first", ["m"])
    with monkeypatch.context() as patch:
        stop_after(patch, batches if step == "write_table" else files, step, n)
        with pytest.raises(Killed):
            batches.append_batch(spark, lambda: rows(10, 30), path, "second", ["m"])
    batches.append_batch(spark, lambda: rows(10, 30), path, "second", ["m"])
    assert table(spark, path) == [(k, k % 3) for k in range(30)]
    assert not batches.append_batch(spark, lambda: rows(10, 30), path, "second", ["m"])
    assert table(spark, path) == [(k, k % 3) for k in range(30)]
    assert batches.batches(spark, path) == ["first", "second"]
    like = rows(0, 0)
    assert sorted(r.k for r in batches.read_batch(spark, path, "second", like).collect()) == list(range(10, 30))
    assert batches.read_batch(spark, path, "third", like).count() == 0


def test_names_and_empty_batches(spark, scratch):
    path = scratch("batch")
    with pytest.raises(ValueError, match="batch name"):
        batches.append_batch(spark, lambda: spark.range(1), path, "a/b")
    assert batches.append_batch(spark, lambda: spark.range(0), path, "none")
    assert batches.append_batch(spark, lambda: spark.range(3), path, "some")
    assert spark.read.parquet(path).count() == 3


def _raw(spark, months):
    raw = {name: (lambda fn=fn: fn(spark, SF)) for name, fn in dt_tables.RAW.items()}
    keep = F.month("trip_start").isin(months)
    raw["taxi_trips"] = lambda: dt_tables.RAW["taxi_trips"](spark, SF).where(keep)
    raw["building_permit"] = lambda: dt_tables.RAW["building_permit"](spark, SF).where(F.col("id").cast("long") % 2 == months[0] % 2)
    raw["covid_by_zip"] = lambda: dt_tables.RAW["covid_by_zip"](spark, SF).where(F.month("week_start").isin(months))
    return raw


GROWING = ("landing.taxi_trips", "landing.building_permit", "staging.trips_data", "staging.building_permit", "staging.covid_by_zip")


def contents(spark, written):
    return {k: sorted(map(str, spark.read.parquet(p).select(sorted(spark.read.parquet(p).columns)).collect())) for k, p in written.items()}


def test_pipeline_repeated_after_each_zone(spark, scratch, monkeypatch):
    """The second of two batches stops after each appended table; repeated, it
    gives what an undisturbed run gives."""
    run = lambda root, months, batch: pipeline.run_pipeline(spark, _raw(spark, months), root, batch=batch, airports=dt_tables.TEST_AIRPORTS)
    plain, killed = scratch("plain"), scratch("killed")
    first, second = [1, 3, 5, 7, 9, 11], [2, 4, 6, 8, 10, 12]
    run(plain, first, "b1")
    want = contents(spark, run(plain, second, "b2"))
    run(killed, first, "b1")
    for n in (0, 3, 5, 6):  # six tables are appended, three landed and three staged; then come the day counts
        with monkeypatch.context() as patch:
            if n < 6:
                stop_after(patch, pipeline, "append_batch", n)
            else:
                stop_after(patch, pipeline, "day_facts_of", 1)
            with pytest.raises(Killed):
                run(killed, second, "b2")
    got = contents(spark, run(killed, second, "b2"))
    assert got == want
    # both batches together are the whole delivery
    whole = pipeline.run_pipeline(spark, _raw(spark, list(range(1, 13))), scratch("whole"), airports=dt_tables.TEST_AIRPORTS)
    permits = sinks.scan_table(spark, whole["staging.building_permit"]).count()
    assert len(want["staging.trips_data"]) == sinks.scan_table(spark, whole["staging.trips_data"]).count()
    assert 0 < permits and want["summarised.rpttbl04c"] == contents(spark, {"r": whole["summarised.rpttbl04c"]})["r"]
