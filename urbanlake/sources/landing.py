"""Landing zone: typed CSV load plus parsed geometry and generated columns
(SURVEY A1-A9, C6-C7).

``read_csv`` is the ``COPY … CSV HEADER`` equivalent: a declared schema
mapped by position, comma delimiter, ``"`` as both quote and escape (so a
doubled quote inside a quoted field is one quote), quoted newlines allowed,
and the job fails on a malformed row.

``land_*`` functions take a frame in the raw landing schema (from CSV or any
other source) and add what the reference derives on load: geometry parsed
from WKT and the stored week-start columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..functions import calendar as cal
from ..functions import geo
from . import csv_blocks


def csv_options(date_format: str | None = None, multi_line: bool = True) -> dict[str, str]:
    """Reader options matching ``COPY … DELIMITER ',' CSV HEADER``.

    ``multi_line`` keeps quoted newlines intact (as ``COPY`` does) at the
    price of one task per file; without it a quoted newline fails the job
    instead of splitting a row.  ``csv_blocks`` keeps them in several tasks.
    """
    opts = {
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "multiLine": "true" if multi_line else "false",
        "mode": "FAILFAST",
        "enforceSchema": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    if date_format:
        opts["dateFormat"] = date_format
    return opts


def read_csv(
    spark: SparkSession, path: str, table: str, multi_line: bool | None = None, date_format: str | None = None
) -> DataFrame:
    """Raw landing table ``table`` (a key of ``schemas.LANDING``) from CSV.

    Files are read in several tasks each and quoted newlines kept intact
    (``csv_blocks``; one small job over the lines runs when this is called).
    ``multi_line=True`` takes Spark's own reader instead, one task per file,
    and ``multi_line=False`` spares that job for files known to hold no
    quoted newline: one that does fails the job.

    ``date_format`` overrides the table's default text format of its date
    columns (``schemas.DATE_FORMATS``).
    """
    fmt, schema = date_format or schemas.DATE_FORMATS.get(table), schemas.LANDING[table]
    if multi_line is None:
        return csv_blocks.read_csv_blocks(spark, path, schema, csv_options(fmt))
    return spark.read.schema(schema).options(**csv_options(fmt, multi_line)).csv(path)


def land_trips(raw: DataFrame) -> DataFrame:
    """Trips with point structs and the generated Sunday/Monday week starts."""
    return (
        raw.withColumn("pickup_point", geo.parse_point("pickup_location"))
        .withColumn("dropoff_point", geo.parse_point("dropoff_location"))
        .withColumn("week_start", cal.week_start("trip_start"))
        .withColumn("week_start_iso", cal.week_start_iso("trip_start"))
    )


def land_polygons(raw: DataFrame) -> DataFrame:
    """ZIP or community-area polygons with ``geom`` rings parsed from WKT."""
    return raw.withColumn("geom", geo.parse_multipolygon("the_geom"))


def land_covid(raw: DataFrame) -> DataFrame:
    return raw.withColumn("zip_point", geo.parse_point("zip_location")).withColumn(
        "week_start_iso", cal.iso_from_week_start("week_start")
    )


def land_ccvi(raw: DataFrame) -> DataFrame:
    return raw.withColumn("location_point", geo.parse_point("location"))


def land_permits(raw: DataFrame) -> DataFrame:
    return raw.withColumn("location_point", geo.parse_point("location"))


def land_health(raw: DataFrame) -> DataFrame:
    return raw


LAND = {
    "taxi_trips": land_trips,
    "boundaries_zip": land_polygons,
    "comm_area": land_polygons,
    "covid_by_zip": land_covid,
    "ccvi_by_ca": land_ccvi,
    "building_permit": land_permits,
    "public_health": land_health,
}


def load(
    spark: SparkSession, path: str, table: str, multi_line: bool | None = None, date_format: str | None = None
) -> DataFrame:
    """Read a landing CSV and apply its landing transformation."""
    return LAND[table](read_csv(spark, path, table, multi_line, date_format))
