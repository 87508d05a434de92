"""Tiny staged-shape frames for edge tests."""

import contextlib
import io

from pyspark.sql import functions as F

from urbanlake.functions import calendar as cal

TRIP_COLS = "trip_id string, trip_start date, pickup_zip int, dropoff_zip int, pickup_community_area int, dropoff_community_area int"


def staged_trips(spark, data):
    """Rows (trip_id, date, pickup_zip, dropoff_zip, pickup_area, dropoff_area) → staged trip columns."""
    df = spark.createDataFrame(data, TRIP_COLS)
    return df.select(
        "trip_id",
        "trip_start",
        cal.week_start("trip_start").alias("week_start"),
        "pickup_community_area",
        "dropoff_community_area",
        "pickup_zip",
        "dropoff_zip",
        cal.week_label(cal.week_start_iso("trip_start")).alias("week_number"),
        cal.month_label("trip_start").alias("month_number"),
    )


def zips(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "zip int")


def covid(spark, data):
    """Rows (zip_code text, week_start date, cases) → staged COVID columns."""
    df = spark.createDataFrame(data, "zip_code string, week_start date, cases_weekly int")
    return df.select(
        "zip_code",
        "week_start",
        "cases_weekly",
        cal.week_label(cal.iso_from_week_start("week_start")).alias("week_number"),
        cal.month_label("week_start").alias("month_number"),
    )


def by(df, *cols):
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).collect()


def oracle_count(key, sf):
    """Row count of a registered query's DuckDB oracle on the test tables in ``sf``."""
    import duckdb

    from urbanlake.catalog.queries import ORACLE

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(f"SELECT count(*) FROM ({ORACLE[key]})").fetchone()[0]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
