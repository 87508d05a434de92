"""End-to-end zone pipeline: landing → staging → summarised →
publish.

One Spark application instead of a chain of shell scripts.  Each zone is
written as Parquet under ``out_root`` (shared storage on a cluster) and the
next zone reads the written tables back: lineage is cut at every zone, so a
lost executor recomputes at most one zone's tasks, and the staged trips —
read by six reports — are computed once.  Any failure raises and stops the
run, as the reference's runner stops at the first failing script.
All six trip reports share one scan of the staged trips through a small
table of per-day counts (``reports.trip_day_facts``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.calendar import iso_from_week_start, month_label
from ..operators.cover import DensityCover
from ..operators.points import PointDictionary
from ..operators.spatial import PolygonIndex
from ..schemas import LANDING, REFERENCE_AIRPORTS, REPORT_HEADERS, report_types
from ..sinks import files
from ..sinks.batches import append_batch, read_batch
from ..sinks.publish import publish
from ..sources import landing
from . import refresh, reports, staging

# What re-running the reference's scripts does to each zone (S21): landing
# loads and staging inserts append, report tables are created only if absent.
REFERENCE_RERUN_MODES = {"landing": "append", "staging": "append", "summarised": "ignore", "export": "overwrite"}

# Tables that grow by batches; the others are snapshots.
BATCHED = ("taxi_trips", "building_permit", "covid_by_zip")

LANDING_TABLES = (
    "taxi_trips", "boundaries_zip", "covid_by_zip", "ccvi_by_ca",
    "public_health", "building_permit", "comm_area",
)


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame | str | Callable[[], DataFrame]],
    out_root: str,
    mode: str | Mapping[str, str] = "overwrite",
    airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS,
    csv_out: bool = False,
    json_out: bool = False,
    jdbc: Mapping | None = None,
    dedupe_points: bool = True,
    multi_line: Mapping[str, bool] | None = None,
    batch: str | None = None,
) -> dict[str, str]:
    """Run every zone; return ``{table: path}`` of everything written.

    ``raw`` gives each landing table as a raw-schema DataFrame, a CSV path
    (read with the declared schema) or a zero-argument callable.
    CSV files are read in several tasks each, quoted newlines included;
    ``multi_line={"taxi_trips": False}`` spares that table the job which looks
    for them: for files known to hold none (one that does fails the job).

    ``mode`` is the writer mode for every table, or a ``{zone: mode}``
    mapping (zones ``landing``, ``staging``, ``summarised``, ``export``):
    ``ignore`` skips existing tables like ``CREATE TABLE IF NOT EXISTS``,
    ``append`` duplicates rows like re-running the reference's loads and
    inserts; ``REFERENCE_RERUN_MODES`` reproduces a re-run of the reference.
    Staged trips and their per-day counts are partitioned by month:
    ``{"staging": "replace"}`` stages what was landed now and replaces just
    its months.  The per-day counts are derived, so they always follow the
    staged trips, whatever the mode.

    ``batch`` names a delivery of trips, permits and COVID rows: it is landed,
    staged and appended to these tables exactly once, whatever ``mode`` says of
    them, and a run that was killed anywhere is simply repeated
    (``sinks.batches``).  Polygons, vulnerability and health rows are snapshots
    and overwritten.

    ``{"summarised": "refresh"}`` recomputes only the parts of the trip reports
    that the landed days reach (``plans.refresh``); the tables are then kept in
    parts and have a column ``part``.

    The ZIP and area of each location are kept from run to run as long as the
    polygons stay the same (``operators.points``).
    ``dedupe_points=False`` skips the distinct-point lookup of the spatial
    joins, for locations that do not repeat (raw GPS); trips then join over a
    cover that follows the density of their points (``operators.cover``).

    Publishing: ``csv_out`` and ``json_out`` export every report in its order
    under ``export/``; ``jdbc`` (``url``, and optionally ``properties``,
    ``mode``, ``table`` as a pattern for the report's name) loads them into a
    database; its mode ``swap`` loads a side table, compares the counts and
    swaps (``sinks.publish``).
    """
    root = out_root.rstrip("/")
    written: dict[str, str] = {}
    modes = {z: (mode if isinstance(mode, str) else mode.get(z, "overwrite")) for z in ("landing", "staging", "summarised", "export")}

    def put(zone: str, name: str, df: DataFrame, how: str | None = None, by: list[str] | None = None) -> DataFrame:
        path = f"{root}/{zone}/{name}"
        sinks.write_table(df, path, mode=how or modes[zone], partition_by=by)
        written[f"{zone}.{name}"] = path
        return sinks.scan_table(spark, path, schema=df.schema)

    def append(zone: str, name: str, empty: DataFrame, make: Callable[[], DataFrame], by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """The table with this batch in it, and the batch alone."""
        path = f"{root}/{zone}/{name}"
        append_batch(spark, make, path, batch, by)
        written[f"{zone}.{name}"] = path
        return sinks.scan_table(spark, path, schema=empty.schema), read_batch(spark, path, batch, empty)

    def source(table: str) -> DataFrame:
        src = raw[table]
        if isinstance(src, str):
            src = landing.read_csv(spark, src, table, multi_line=(multi_line or {}).get(table))
        elif callable(src) and not isinstance(src, DataFrame):
            src = src()
        return landing.LAND[table](src)

    land: dict[str, DataFrame] = {}  # what this run stages
    for table in LANDING_TABLES:
        if batch and table in BATCHED:
            empty = landing.LAND[table](spark.createDataFrame([], LANDING[table]))
            _, land[table] = append("landing", table, empty, lambda t=table: source(t))
        else:
            land[table] = put("landing", table, source(table), "overwrite" if batch else None)

    zips, areas = land["boundaries_zip"], land["comm_area"]
    zip_index = PolygonIndex(zips, ["zip"])
    area_index = PolygonIndex(areas, ["area_numbe"])
    dictionary = PointDictionary(spark, f"{root}/staging/_points", [zip_index, area_index]) if dedupe_points else None
    if dictionary:
        dictionary.update(staging.point_sources(land["taxi_trips"], land["building_permit"]))
    cover = None if dictionary else DensityCover
    plans = {
        "trips_data": lambda t: staging.stage_trips(t, zip_index, area_index, cover=cover, dictionary=dictionary),
        "covid_by_zip": staging.stage_covid,
        "building_permit": lambda t: staging.stage_permits(t, zip_index, area_index, dictionary=dictionary),
        "ccvi_by_ca": staging.stage_ccvi,
        "public_health": staging.stage_health,
    }
    months = ["month_number"]

    def stage(name: str, table: str, by: list[str] | None = None) -> DataFrame:
        if not (batch and table in BATCHED):
            return put("staging", name, plans[name](land[table]), "overwrite" if batch else None, by)
        empty = plans[name](land[table]).limit(0)
        return append("staging", name, empty, lambda: plans[name](land[table]), by)[0]

    trips = stage("trips_data", "taxi_trips", months)
    covid = stage("covid_by_zip", "covid_by_zip")
    ccvi = stage("ccvi_by_ca", "ccvi_by_ca")
    permits = stage("building_permit", "building_permit")
    health = stage("public_health", "public_health")

    # One scan of the staged trips feeds all six trip reports: small per-day
    # counts, rolled up by each report.
    days_path = f"{root}/staging/trip_day_facts"
    state, pending = f"{root}/summarised/_state", f"{root}/summarised/_pending"
    touched = None  # days whose counts change; None: any
    if (batch or modes["staging"] == "replace") and files.exists(spark, days_path):
        # one value per calendar day that was landed now
        landed = {r[0] for r in land["taxi_trips"].select("trip_start").distinct().collect()}
        labels = {refresh.month_of(d) for d in landed}
        old = sinks.scan_table(spark, days_path, schema=day_facts_of(trips, None, airports).schema)
        touched = {r[0] for r in old.where(F.col("month_number").isin([m for m in labels if m])).select("trip_start").distinct().collect()} | landed
        # a run that ends before its reports are written leaves its days to the next one
        spark.createDataFrame([(d,) for d in touched], "day date").coalesce(1).write.mode("append").parquet(pending)
        touched = {r[0] for r in spark.read.schema("day date").parquet(pending).collect()}
        days = put("staging", "trip_day_facts", day_facts_of(trips, sorted(labels, key=str), airports), "replace", months)
    else:
        days = put("staging", "trip_day_facts", day_facts_of(trips, None, airports), "overwrite", months)
    inputs = (days, covid, ccvi, zips)
    if modes["summarised"] == "refresh":
        digest = _state(zip_index, ccvi, airports)
        touched = touched if files.exists(spark, f"{state}/{digest}") else None
        files.delete(spark, state)
        weeks = [r[0] for r in land["covid_by_zip"].select(iso_from_week_start("week_start")).distinct().collect()] if batch else []
        weekly = None if touched is None or not batch else {*touched, *weeks}  # a snapshot of COVID rows may change any week
        out = refresh.refresh(spark, f"{root}/summarised", *inputs, weekly, airports, ("rpttbl01", "rpttbl02"))
        out |= refresh.refresh(spark, f"{root}/summarised", *inputs, touched, airports, ("rpttbl03", "rpttbl04a", "rpttbl04b", "rpttbl04c"))
        files.touch(spark, f"{state}/{digest}")
        files.delete(spark, pending)
    else:
        files.delete(spark, state)
        out = {
            "rpttbl01": reports.report1_severity(trips, covid, zips, days),
            "rpttbl02": reports.report2_airport(trips, covid, zips, airports, days),
            "rpttbl03": reports.report3_ccvi(trips, ccvi, days),
            "rpttbl04a": reports.report4a_weekly(trips, zips, days),
            "rpttbl04b": reports.report4b_monthly(trips, zips, days),
            "rpttbl04c": reports.report4c_daily(trips, zips, days),
        }
    kept = set(out) if modes["summarised"] == "refresh" else set()
    out |= {"rpttbl05": reports.report5_waiver(health, permits), "rpttbl06": reports.report6_loans(permits, health)}
    for name, df in out.items():
        if name in kept:
            table, written[f"summarised.{name}"] = df, f"{root}/summarised/{name}"
        else:
            table = put("summarised", name, df, "overwrite" if kept else None)
        headers, types, order = REPORT_HEADERS[name], report_types(name), reports.report_order(name)
        if csv_out:
            written[f"export.{name}"] = sinks.write_csv(
                table, f"{root}/export/{name}", mode=modes["export"], headers=headers, order=order
            )
        if json_out:
            written[f"export_json.{name}"] = sinks.write_json(
                table, f"{root}/export_json/{name}", mode=modes["export"], headers=headers, types=types, order=order
            )
        if jdbc and jdbc.get("mode") == "swap":
            target = jdbc.get("table", "{report}").format(report=name)
            publish(table, jdbc["url"], target, headers, types, jdbc.get("properties"))
        elif jdbc:
            sinks.write_jdbc(
                table, jdbc["url"], jdbc.get("table", "{report}").format(report=name), mode=jdbc.get("mode", "append"),
                properties=jdbc.get("properties"), headers=headers, types=types,
            )
    return written


def _state(zip_index: PolygonIndex, ccvi: DataFrame, airports: Mapping[str, Sequence[int]]) -> str:
    """Digest of what all rows of the reports depend on."""
    row = ccvi.select(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    text = f"{zip_index.version()} {tuple(row)} {sorted((a, sorted(z)) for a, z in airports.items())}"
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def day_facts_of(trips: DataFrame, months: Sequence[str | None] | None, airports: Mapping[str, Sequence[int]]) -> DataFrame:
    """Per-day counts with their month, of all staged trips or of the given
    months (labels; only their partitions are read)."""
    if months is not None:
        label = F.col("month_number")
        trips = trips.where(label.isin([m for m in months if m is not None]) | (label.isNull() if None in months else F.lit(False)))
    return reports.trip_day_facts(trips, airports).withColumn("month_number", month_label("trip_start"))
