from pyspark.sql import functions as F

from urbanlake import schemas, sinks
from urbanlake.plans import staging as st
from urbanlake.sources import driver_tables as dt
from urbanlake.sources import landing as ld
from urbanlake.streaming import stage_trips_stream

SF = "/root/testdata/sf0.001"


def test_stream_staging_matches_batch_and_is_incremental(spark, scratch):
    raw = dt.trips_raw(spark, SF)
    landing_dir, out, ckpt = scratch("landing"), scratch("staged"), scratch("ckpt")
    first = raw.where(F.col("trip_start") < "1998-01-01")
    second = raw.where(F.col("trip_start") >= "1998-01-01")
    fmt = schemas.DATE_FORMATS["taxi_trips"]
    sinks.write_csv(first, landing_dir + "/part1", date_format=fmt)
    zips = ld.land_polygons(dt.zip_polygons_raw(spark, SF))
    areas = ld.land_polygons(dt.area_polygons_raw(spark, SF))

    q = stage_trips_stream(spark, landing_dir + "/*", zips, areas, out, checkpoint_location=ckpt)
    q.awaitTermination()
    n1 = spark.read.parquet(out).count()

    sinks.write_csv(second, landing_dir + "/part2", date_format=fmt)
    q = stage_trips_stream(spark, landing_dir + "/*", zips, areas, out, checkpoint_location=ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(out).drop("batch_id")

    # the same files again: nothing is staged twice
    q = stage_trips_stream(spark, landing_dir + "/*", zips, areas, out, checkpoint_location=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == streamed.count()

    batch = st.stage_trips(ld.land_trips(raw), zips, areas)
    cols = ["trip_id", "trip_start", "pickup_zip", "dropoff_zip", "pickup_community_area", "week_number"]
    key = lambda r: tuple(str(x) for x in r)
    assert 0 < n1 < streamed.count()
    assert sorted(map(key, streamed.select(*cols).collect())) == sorted(map(key, batch.select(*cols).collect()))



def test_streamed_day_facts_feed_the_reports(spark, scratch):
    from urbanlake.plans import reports as rp

    raw = dt.trips_raw(spark, SF)
    landing_dir, out, ckpt, facts = scratch("landing"), scratch("staged"), scratch("ckpt"), scratch("facts")
    fmt = schemas.DATE_FORMATS["taxi_trips"]
    # two files that share days (split by line number, not by date)
    sinks.write_csv(raw.where("cast(substring(trip_id, -1) as int) % 2 = 0"), landing_dir + "/a", date_format=fmt)
    sinks.write_csv(raw.where("cast(substring(trip_id, -1) as int) % 2 = 1"), landing_dir + "/b", date_format=fmt)
    zips = ld.land_polygons(dt.zip_polygons_raw(spark, SF))
    areas = ld.land_polygons(dt.area_polygons_raw(spark, SF))
    q = stage_trips_stream(spark, landing_dir + "/*", zips, areas, out, checkpoint_location=ckpt,
                           max_files_per_trigger=1, facts_path=facts, airports=dt.TEST_AIRPORTS)
    q.awaitTermination()
    days = spark.read.parquet(facts)
    assert days.select("batch_id").distinct().count() >= 2  # several micro-batches share days
    staged = st.stage_trips(ld.land_trips(raw), zips, areas)
    covid = st.stage_covid(ld.land_covid(dt.covid_raw(spark, SF)))
    key = lambda r: tuple(str(x) for x in r)
    for a, b in [
        (rp.report1_severity(staged, covid, zips), rp.report1_severity(None, covid, zips, days)),
        (rp.report4c_daily(staged, zips), rp.report4c_daily(None, zips, days)),
        (rp.report2_airport(staged, covid, zips, dt.TEST_AIRPORTS), rp.report2_airport(None, covid, zips, dt.TEST_AIRPORTS, days)),
    ]:
        assert sorted(key(r) for r in a.collect()) == sorted(key(r) for r in b.collect())
