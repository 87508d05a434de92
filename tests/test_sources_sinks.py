import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from urbanlake import schemas, sinks
from urbanlake.plans import staging as st
from urbanlake.sources import landing as ld

D = dt.date


def _write_text(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_quotes_commas_newlines_and_empty(spark, scratch):
    path = scratch("csv")
    header = ",".join(f.name for f in schemas.BOUNDARIES_ZIP.fields)
    body = '"MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))",1,,0.5,\n"say ""hi"", ok\nline2",2,7,,1.5\n'
    _write_text(_local(path), header + "\n" + body)
    rows = ld.read_csv(spark, path, "boundaries_zip").orderBy("objectid").collect()
    assert rows[0].zip is None and rows[0].shape_len is None  # empty field -> NULL
    assert rows[1].the_geom == 'say "hi", ok\nline2'  # one intact field
    assert rows[1].zip == 7 and rows[1].shape_len == 1.5


def test_csv_bad_row_fails(spark, scratch):
    path = scratch("csvbad")
    _write_text(_local(path), "a,b,c,d,e\nPOINT,notanint,1,2,3\n")
    with pytest.raises(Exception):
        ld.read_csv(spark, path, "boundaries_zip").collect()


def test_trip_timestamp_text_becomes_date(spark, scratch):
    path = scratch("trips")
    fields = ["" for _ in schemas.TAXI_TRIPS.fields]
    fields[0], fields[2] = "t1", "01/05/2024 11:45:00 PM"
    fields[19] = '"POINT (-87.6 41.9)"'
    _write_text(_local(path), ",".join(f.name for f in schemas.TAXI_TRIPS.fields) + "\n" + ",".join(fields) + "\n")
    r = ld.load(spark, path, "taxi_trips").first()
    assert r.trip_start == D(2024, 1, 5) and r.week_start == D(2023, 12, 31) and r.week_start_iso == D(2024, 1, 1)
    assert (r.pickup_point.x, r.pickup_point.y) == (-87.6, 41.9) and r.dropoff_point is None


def test_bad_fee_text_fails_the_job(spark):
    # Casting 'abc' to numeric is an error, as in the reference
    permits = spark.createDataFrame(
        [("1", "P1", " PERMIT - NEW CONSTRUCTION ", "abc", 1.0, 1.0, 3)],
        "id string, permit_no string, permit_type string, subtotal_unpaid string, latitude double, longitude double, community_area int",
    ).withColumn("location_point", F.struct(F.lit(0.5).alias("x"), F.lit(0.5).alias("y")))
    polys = spark.createDataFrame([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], "zip int, the_geom string")
    z = ld.land_polygons(polys)
    a = ld.land_polygons(polys.withColumnRenamed("zip", "area_numbe"))
    with pytest.raises(Exception):
        st.stage_permits(permits, z, a).collect()


def test_ccvi_filter_before_cast(spark):
    raw = spark.createDataFrame([(" CA ", "12", "HIGH"), ("ZIP", "not-a-number", "low")],
                                "geography_type string, area_or_zip string, ccvi_category string")
    assert [tuple(r) for r in st.stage_ccvi(raw).collect()] == [(12, "HIGH")]


def test_sink_modes(spark, scratch):
    # Ignore skips an existing table, append duplicates, overwrite replaces
    df = spark.range(3)
    p = scratch("modes")
    sinks.write_table(df, p, mode="ignore")
    sinks.write_table(spark.range(10), p, mode="ignore")
    assert sinks.scan_table(spark, p).count() == 3
    sinks.write_table(df, p, mode="append")
    assert sinks.scan_table(spark, p).count() == 6
    sinks.write_table(df, p, mode="overwrite")
    assert sinks.scan_table(spark, p).count() == 3


def test_report_csv_roundtrip_with_headers(spark, scratch):
    df = spark.createDataFrame([(D(2024, 1, 7), 1, 5, 4), (None, 2, 0, 0)], "date date, zip int, total_trip_count long, forecasted_trip_count int")
    p = scratch("rcsv")
    sinks.write_csv(df, p, headers=schemas.REPORT_HEADERS["rpttbl04c"])
    head = spark.read.text(p).where(F.col("value").startswith("Date")).first()[0]
    assert head == "Date,ZIP,Total Trip Count,Forecasted Trip Count"
    back = sinks.read_report_csv(spark, p, "rpttbl04c")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_json_documents_shape(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 7), 3, None, "1.50")], "week_start date, zip int, severity string, fee string"
    ).withColumn("fee", F.col("fee").cast("decimal(18,2)"))
    doc = json.loads(sinks.json_documents(df, {"week_start": "Week Start", "zip": "ZIP"}).first()[0])
    assert list(doc) == sorted(doc)
    assert doc == {"Week Start": "2024-01-07T00:00:00Z", "ZIP": 3, "severity": None, "fee": "1.50"}
    types = {"week_start": "date", "zip": "numeric", "severity": "text", "fee": "numeric"}
    line = sinks.json_documents(df, {"week_start": "Week Start", "zip": "ZIP"}, types).first()[0]
    assert '"ZIP":"3"' in line and '"fee":"1.50"' in line


def test_jdbc_options_carry_the_declared_types():
    headers, types = schemas.REPORT_HEADERS["rpttbl04c"], schemas.report_types("rpttbl04c")
    props = sinks.jdbc_properties(headers, types, {"user": "u"}, 4)
    assert props == {
        "user": "u", "batchsize": "10000", "numPartitions": "4",
        "createTableColumnTypes": "`Date` DATE, `ZIP` NUMERIC, `Total Trip Count` NUMERIC, `Forecasted Trip Count` INTEGER",
    }


def test_large_csv_is_read_in_several_tasks(spark, scratch):
    path = scratch("bigcsv")
    header = ",".join(f.name for f in schemas.BOUNDARIES_ZIP.fields)
    _write_text(_local(path), header + "\n" + "".join(f'"MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))",{i},{i},0.5,1.5\n' for i in range(20000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        one, many = (ld.read_csv(spark, path, "boundaries_zip", multi_line=m) for m in (True, False))
        assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() >= 4
        assert many.count() == 20000 and many.agg(F.sum("zip")).first()[0] == sum(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    stray = scratch("straycsv")
    _write_text(_local(stray), header + '\n"say\nit",1,2,0.5,1.5\n')
    with pytest.raises(Exception):
        ld.read_csv(spark, stray, "boundaries_zip", multi_line=False).collect()


def test_command_line_runs_the_zones_from_csv(spark, scratch):
    import json as _json

    from urbanlake.__main__ import main
    from urbanlake.sources import driver_tables as dt

    sf = "/root/testdata/sf0.001"
    src = scratch("src")
    for table, fn in dt.RAW.items():
        sinks.write_csv(fn(spark, sf), f"{src}/{table}", date_format=schemas.DATE_FORMATS.get(table))
    out = scratch("warehouse")
    airports = _json.dumps(dt.TEST_AIRPORTS)
    options = ["--json-out", "--raw-points", "--single-line", "covid_by_zip"]
    written = main(["--src-dir", src, "--out", out, "--csv-out", "--airports", airports, *options], spark)
    from helpers import oracle_count

    assert sinks.scan_table(spark, written["summarised.rpttbl01"]).count() == oracle_count("report1_severity", sf)
    assert "export.rpttbl06" in written and "export_json.rpttbl06" in written
    with pytest.raises(SystemExit):
        main(["--out", out], spark)


def test_stage_covid_keeps_known_located_zips(spark):
    # ZIP not NULL, not 'Unknown', location not NULL; labels from the week start
    raw = spark.createDataFrame(
        [("60601", D(2024, 1, 7), 3, "POINT (1 2)"), ("Unknown", D(2024, 1, 7), 4, None),
         (None, D(2024, 1, 7), 5, "POINT (1 2)"), ("60602", D(2024, 1, 7), 6, None),
         ("60603", D(2023, 12, 31), 7, "POINT (3 4)")],
        "zip_code string, week_start date, cases_weekly int, zip_location string",
    )
    from urbanlake.sources.driver_tables import conform

    staged = st.stage_covid(ld.land_covid(conform(raw, schemas.COVID_BY_ZIP)))
    got = sorted((r.zip_code, r.cases_weekly, r.week_number, r.month_number) for r in staged.collect())
    assert got == [("60601", 3, "2-2024", "1-2024"), ("60603", 7, "1-2024", "12-2023")]


def test_write_jdbc_reaches_the_driver_lookup(spark):
    # no database is started: a URL no JDBC driver accepts must fail at the
    # driver lookup, after the writer options were assembled
    df = spark.createDataFrame([(1, "a")], "zip int, permit_id string")
    with pytest.raises(Exception) as err:
        sinks.write_jdbc(df, "jdbc:urbanlake-none://nowhere/db", "rpttbl06", headers=schemas.REPORT_HEADERS["rpttbl06"])
    assert "driver" in str(err.value).lower()


def test_a_cluster_without_a_shared_folder_is_an_error():
    from urbanlake.session import is_local

    assert is_local("local") and is_local("local[4]") and is_local("local[*]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("spark://host:7077") and not is_local("yarn")
