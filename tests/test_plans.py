"""Plan-shape guards: the physical plans keep the properties the design relies on."""

from helpers import plan

from urbanlake import sinks
from urbanlake.operators.spatial import PolygonIndex
from urbanlake.plans import reports as rp
from urbanlake.plans import staging as st
from urbanlake.sources import driver_tables as dt
from urbanlake.sources import landing as ld

SF = "/root/testdata/sf0.001"


def _landed(spark, scratch):
    root = scratch("plans")
    out = {}
    for t in ("taxi_trips", "boundaries_zip", "comm_area", "covid_by_zip", "ccvi_by_ca"):
        sinks.write_table(ld.LAND[t](dt.RAW[t](spark, SF)), f"{root}/{t}")
        out[t] = sinks.scan_table(spark, f"{root}/{t}")
    return root, out


def test_staging_joins_on_spread_keys(spark, scratch):
    _, land = _landed(spark, scratch)
    zi, ai = PolygonIndex(land["boundaries_zip"], ["zip"]), PolygonIndex(land["comm_area"], ["area_numbe"])
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    direct = st.stage_trips(land["taxi_trips"], zi, ai)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before  # a lazy plan
    looked_up = st.stage_trips(land["taxi_trips"], zi, ai, lookup_path=scratch("points"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, joins in ((direct, 4), (looked_up, 2)):
            text = plan(df)
            tree = text.split("\n\n")[0]
            assert "CartesianProduct" not in tree and "NestedLoop" not in tree
            assert tree.count("SortMergeJoin") == joins
            # rows without a point are dealt out by a key of their own
            assert text.count("xxhash64(trip_id") >= joins and "isnull" in text
            # the location filter and the column pruning reach the trips scan
            assert "Or(IsNotNull(pickup_point),IsNotNull(dropoff_point))" in text
            assert all("taxi_id" not in part.split("\n")[0] for part in text.split("ReadSchema:")[1:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_reports_from_day_table_do_not_read_trips(spark, scratch):
    root, land = _landed(spark, scratch)
    zi, ai = PolygonIndex(land["boundaries_zip"], ["zip"]), PolygonIndex(land["comm_area"], ["area_numbe"])
    trips_path = f"{root}/staged_trips"
    sinks.write_table(st.stage_trips(land["taxi_trips"], zi, ai), trips_path)
    trips = sinks.scan_table(spark, trips_path)
    days = rp.trip_day_facts(trips, dt.TEST_AIRPORTS)
    sinks.write_table(days, f"{root}/days")
    days = sinks.scan_table(spark, f"{root}/days")
    covid = st.stage_covid(land["covid_by_zip"])
    ccvi = st.stage_ccvi(land["ccvi_by_ca"])
    zips = land["boundaries_zip"]
    for df in (
        rp.report1_severity(trips, covid, zips, days),
        rp.report2_airport(trips, covid, zips, dt.TEST_AIRPORTS, days),
        rp.report3_ccvi(trips, ccvi, days),
        rp.report4a_weekly(trips, zips, days),
        rp.report4b_monthly(trips, zips, days),
        rp.report4c_daily(trips, zips, days),
    ):
        text = plan(df)
        assert "staged_trips" not in text
        assert "CartesianProduct" not in text and "SortMergeJoin" not in text
