"""Every operator of SURVEY §2 as a registered query over the test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and, where SQL can express
it, the DuckDB oracle text (``sql_oracle``) with identical column names.
All queries run on the whole input tables through the library's own
operators; keys that exercise a sink or a file source write to a fresh
folder under the session's shared checkpoint directory and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, sinks
from ..functions import calendar as cal
from ..functions import geo
from ..functions.columns import airport_from_zip, impute_area, score_sum
from ..operators import aggregates as agg
from ..operators.cover import DensityCover
from ..operators.points import PointDictionary
from ..operators.quantiles import exact_quartiles
from ..operators.spatial import PolygonIndex, within_left_join
from ..operators.spine import dense_spine, zero_filled_left_join
from ..plans import reports as rp
from ..plans import staging as st
from ..plans.pipeline import run_pipeline
from ..plans.refresh import refresh
from ..session import shared_dir
from ..sinks.batches import append_batch
from ..sources import driver_tables as dt
from ..sources import landing as ld
from .sql_oracle import PERIODS, with_ctes

AIRPORTS = dt.TEST_AIRPORTS
AIRPORT_ZIPS = [z for zs in AIRPORTS.values() for z in zs]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return deco


class Inputs:
    """Landed and staged frames derived from one test-data folder (lazy)."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def trips(self) -> DataFrame:
        return ld.land_trips(dt.trips_raw(self.spark, self.sf))

    @cached_property
    def zips(self) -> DataFrame:
        return ld.land_polygons(dt.zip_polygons_raw(self.spark, self.sf))

    @cached_property
    def areas(self) -> DataFrame:
        return ld.land_polygons(dt.area_polygons_raw(self.spark, self.sf))

    @cached_property
    def covid(self) -> DataFrame:
        return ld.land_covid(dt.covid_raw(self.spark, self.sf))

    @cached_property
    def ccvi(self) -> DataFrame:
        return ld.land_ccvi(dt.ccvi_raw(self.spark, self.sf))

    @cached_property
    def health(self) -> DataFrame:
        return ld.land_health(dt.health_raw(self.spark, self.sf))

    @cached_property
    def permits(self) -> DataFrame:
        return ld.land_permits(dt.permits_raw(self.spark, self.sf))

    @cached_property
    def zip_index(self) -> PolygonIndex:
        return PolygonIndex(self.zips, ["zip"])

    @cached_property
    def area_index(self) -> PolygonIndex:
        return PolygonIndex(self.areas, ["area_numbe"])

    @cached_property
    def stg_trips(self) -> DataFrame:
        return st.stage_trips(self.trips, self.zip_index, self.area_index, lookup_path=shared_dir(self.spark, "trip-points"))

    @cached_property
    def stg_covid(self) -> DataFrame:
        return st.stage_covid(self.covid)

    @cached_property
    def stg_ccvi(self) -> DataFrame:
        return st.stage_ccvi(self.ccvi)

    @cached_property
    def stg_permits(self) -> DataFrame:
        return st.stage_permits(self.permits, self.zip_index, self.area_index, lookup_path=shared_dir(self.spark, "permit-points"))

    @cached_property
    def stg_health(self) -> DataFrame:
        return st.stage_health(self.health)

    @cached_property
    def days(self) -> DataFrame:
        """Per-day counts shared by the six trip reports, written once as run_pipeline does."""
        return self._written("trip-day-facts", rp.trip_day_facts(self.stg_trips, AIRPORTS))

    # staged tables that several reports read, written once as run_pipeline does
    @cached_property
    def kept_covid(self) -> DataFrame:
        return self._written("stg-covid", self.stg_covid)

    @cached_property
    def kept_permits(self) -> DataFrame:
        return self._written("stg-permits", self.stg_permits)

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        return sinks.scan_table(self.spark, sinks.write_table(df, shared_dir(self.spark, name)))

    @cached_property
    def zip_keys(self) -> DataFrame:
        return self.zips.select(F.col("zip").cast("int").alias("zip"))


def _xy(point: str, prefix: str) -> list:
    return [F.col(point)["x"].alias(f"{prefix}_x"), F.col(point)["y"].alias(f"{prefix}_y")]


# =============================================================== 2.1 sources
@query("src_csv_trips", """
SELECT trip_id, taxi_id, trip_start, trip_end, trip_seconds, trip_miles,
       pickup_census_tract, dropoff_census_tract, pickup_community_area, dropoff_community_area,
       fare, payment_type, company, px AS pickup_x, py AS pickup_y, dx AS dropoff_x, dy AS dropoff_y,
       py AS pickup_lat, dy AS dropoff_lat, week_start, week_start_iso
FROM trips_l""")
def src_csv_trips(spark, sf):
    path = shared_dir(spark, "src_csv_trips")
    # a file per writing task, each read in as many tasks as it has blocks
    sinks.write_csv(dt.trips_raw(spark, sf), path, date_format=schemas.DATE_FORMATS["taxi_trips"])
    t = ld.load(spark, path, "taxi_trips")
    return t.select(
        "trip_id", "taxi_id", "trip_start", "trip_end", "trip_seconds", "trip_miles",
        "pickup_census_tract", "dropoff_census_tract", "pickup_community_area", "dropoff_community_area",
        "fare", "payment_type", "company", *_xy("pickup_point", "pickup"), *_xy("dropoff_point", "dropoff"),
        "pickup_lat", "dropoff_lat", "week_start", "week_start_iso",
    )


def _polygon_stats(df: DataFrame, layer: str, id_col: str) -> DataFrame:
    g = F.col("geom")
    edges = geo.ring_edges(g)
    twice_area = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"])
    return df.select(
        F.lit(layer).alias("layer"),
        F.col(id_col).cast("int").alias("polygon_id"),
        F.size(g).alias("n_rings"),
        F.size(F.flatten(g)).alias("n_vertices"),
        F.array_min(geo.ring_coords(g, "x")).alias("xmin"),
        F.array_max(geo.ring_coords(g, "x")).alias("xmax"),
        F.array_min(geo.ring_coords(g, "y")).alias("ymin"),
        F.array_max(geo.ring_coords(g, "y")).alias("ymax"),
        (F.abs(twice_area) / 2).alias("area"),
    )


_POLYGON_STATS_SQL = """
SELECT s.*, CAST(coalesce(c.n, 0) AS BIGINT) AS n_pickups
FROM (
    SELECT 'zip' AS layer, CAST(n_nationkey AS INTEGER) AS polygon_id, 1 AS n_rings, 7 AS n_vertices,
           CAST(n_nationkey % 5 AS DOUBLE) AS xmin, CAST(n_nationkey % 5 + 1 AS DOUBLE) AS xmax,
           CAST(n_nationkey // 5 AS DOUBLE) AS ymin, CAST(n_nationkey // 5 + 1 AS DOUBLE) AS ymax,
           0.75::DOUBLE AS area
    FROM nation
    UNION ALL
    SELECT 'area', CAST(r_regionkey + 1 AS INTEGER), 1, 5,
           CAST(r_regionkey AS DOUBLE), CAST(r_regionkey + 1 AS DOUBLE), 0.0::DOUBLE, 5.0::DOUBLE, 5.0::DOUBLE
    FROM region) s
LEFT JOIN (
    SELECT 'zip' AS layer, h.zip AS id, count(*) AS n FROM trips_l t JOIN zip_hit h ON h.x = t.px AND h.y = t.py GROUP BY 2
    UNION ALL
    SELECT 'area', h.area, count(*) FROM trips_l t JOIN area_hit h ON h.x = t.px AND h.y = t.py GROUP BY 2) c
  ON s.layer = c.layer AND s.polygon_id = c.id"""


def _polygon_stats_with_pickups(spark, sf, zips: DataFrame, areas: DataFrame) -> DataFrame:
    """Geometry statistics of each parsed polygon and the number of trip
    pickups inside it (the parsed rings of both layers, as one layer, drive a
    single within-join over all trips)."""
    # parsed once a row: a plain column would be parsed anew by each filter that the join infers from it
    pickups = dt.trips_raw(spark, sf).select(F.explode(F.array(geo.parse_point("pickup_location"))).alias("p")).where(F.col("p").isNotNull())
    layers = (("zip", zips, "zip"), ("area", areas, "area_numbe"))
    stats, both = (
        reduce(DataFrame.unionByName, parts)
        for parts in (
            [_polygon_stats(df, layer, key) for layer, df, key in layers],
            [df.select(F.lit(layer).alias("_layer"), F.col(key).cast("int").alias("_id"), "geom") for layer, df, key in layers],
        )
    )
    inside = (
        within_left_join(pickups, "p", both, {"_layer": "_layer", "_id": "_id"})
        .where(F.col("_id").isNotNull())
        .groupBy("_layer", "_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    same = (stats["layer"] == inside["_layer"]) & (stats["polygon_id"] == inside["_id"])
    return stats.join(inside, same, "left").select(*stats.columns, F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_pickups"))


@query("src_csv_polygons", _POLYGON_STATS_SQL)
def src_csv_polygons(spark, sf):
    zpath, apath = shared_dir(spark, "src_csv_zip"), shared_dir(spark, "src_csv_area")
    sinks.write_csv(dt.zip_polygons_raw(spark, sf), zpath)
    sinks.write_csv(dt.area_polygons_raw(spark, sf), apath)
    z = ld.load(spark, zpath, "boundaries_zip")
    a = ld.load(spark, apath, "comm_area")
    return _polygon_stats_with_pickups(spark, sf, z, a)


@query("src_csv_covid", """
SELECT zip_code, week_number_int AS week_number, week_start, week_end, cases_weekly, cases_cumulative,
       tests_weekly, tests_cumulative, row_id, loc_x, loc_y, week_start + 1 AS week_start_iso
FROM covid_l""")
def src_csv_covid(spark, sf):
    path = shared_dir(spark, "src_csv_covid")
    sinks.write_csv(dt.covid_raw(spark, sf), path, date_format=schemas.DATE_FORMATS["covid_by_zip"])
    c = ld.load(spark, path, "covid_by_zip")
    return c.select(
        "zip_code", "week_number", "week_start", "week_end", "cases_weekly", "cases_cumulative",
        "tests_weekly", "tests_cumulative", "row_id",
        F.col("zip_point")["x"].alias("loc_x"), F.col("zip_point")["y"].alias("loc_y"), "week_start_iso",
    )


@query("src_csv_ccvi", """
SELECT geography_type, area_or_zip, community_area_name, ccvi_score, ccvi_category FROM ccvi_l""")
def src_csv_ccvi(spark, sf):
    path = shared_dir(spark, "src_csv_ccvi")
    sinks.write_csv(dt.ccvi_raw(spark, sf), path)
    return ld.load(spark, path, "ccvi_by_ca").select(
        "geography_type", "area_or_zip", "community_area_name", "ccvi_score", "ccvi_category"
    )


@query("src_csv_health", """
SELECT community_area, community_area_name, below_poverty_level, per_capita_income, unemployment FROM health_l""")
def src_csv_health(spark, sf):
    path = shared_dir(spark, "src_csv_health")
    sinks.write_csv(dt.health_raw(spark, sf), path)
    return ld.load(spark, path, "public_health").select(
        "community_area", "community_area_name", "below_poverty_level", "per_capita_income", "unemployment"
    )


@query("src_csv_permits", """
SELECT id, permit_no, permit_status, permit_type, application_start_date, subtotal_unpaid, community_area,
       y AS latitude, x AS longitude, x AS loc_x, y AS loc_y
FROM permits_l""")
def src_csv_permits(spark, sf):
    path = shared_dir(spark, "src_csv_permits")
    sinks.write_csv(dt.permits_raw(spark, sf), path, date_format=schemas.DATE_FORMATS["building_permit"])
    p = ld.load(spark, path, "building_permit")
    return p.select(
        "id", "permit_no", "permit_status", "permit_type", "application_start_date", "subtotal_unpaid",
        "community_area", "latitude", "longitude",
        F.col("location_point")["x"].alias("loc_x"), F.col("location_point")["y"].alias("loc_y"),
    )


@query("geo_parse_point", "SELECT trip_id, px AS pickup_x, py AS pickup_y, dx AS dropoff_x, dy AS dropoff_y FROM trips_l")
def geo_parse_point(spark, sf):
    t = Inputs(spark, sf).trips
    return t.select("trip_id", *_xy("pickup_point", "pickup"), *_xy("dropoff_point", "dropoff"))


@query("geo_parse_multipolygon", _POLYGON_STATS_SQL)
def geo_parse_multipolygon(spark, sf):
    i = Inputs(spark, sf)
    return _polygon_stats_with_pickups(spark, sf, i.zips, i.areas)


_R1_COLS = "week_start, week_number, zip, total_trip_count, weekly_positive_cases, severity, forecasted_severity"


_REPORT_CTES = {
    "rpttbl01": "r1", "rpttbl02": "r2", "rpttbl03": "r3", "rpttbl04a": "r4a", "rpttbl04b": "r4b", "rpttbl04c": "r4c",
    "rpttbl05": "r5", "rpttbl06": "r6",
}


def _all_reports(i: Inputs) -> dict[str, DataFrame]:
    return {
        "rpttbl01": rp.report1_severity(None, i.kept_covid, i.zips, i.days),
        "rpttbl02": rp.report2_airport(None, i.kept_covid, i.zips, AIRPORTS, i.days),
        "rpttbl03": rp.report3_ccvi(None, i.stg_ccvi, i.days),
        "rpttbl04a": rp.report4a_weekly(None, i.zips, i.days),
        "rpttbl04b": rp.report4b_monthly(None, i.zips, i.days),
        "rpttbl04c": rp.report4c_daily(None, i.zips, i.days),
        "rpttbl05": rp.report5_waiver(i.stg_health, i.kept_permits),
        "rpttbl06": rp.report6_loans(i.kept_permits, i.stg_health),
    }


def _as_text(reports: dict[str, DataFrame]) -> DataFrame:
    """Rows of several reports as one table: report, and the row's fields
    joined by ``|`` in report column order, NULL as ``-``."""
    out = None
    for name, df in reports.items():
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in schemas.REPORT_HEADERS[name]]
        part = df.select(F.lit(name).alias("report"), F.concat_ws("|", *fields).alias("fields"))
        out = part if out is None else out.unionByName(part)
    return out


_ALL_REPORTS_SQL = "\nUNION ALL\n".join(
    "SELECT '{0}' AS report, concat_ws('|', {1}) AS fields FROM {2}".format(
        name, ", ".join(f"ifnull(CAST({c} AS VARCHAR), '-')" for c in schemas.REPORT_HEADERS[name]), cte
    )
    for name, cte in _REPORT_CTES.items()
)


@query("report_csv_roundtrip", _ALL_REPORTS_SQL)
def report_csv_roundtrip(spark, sf):
    back = {}
    for name, df in _all_reports(Inputs(spark, sf)).items():
        path = shared_dir(spark, f"report_csv_{name}")
        sinks.write_csv(df, path, headers=schemas.REPORT_HEADERS[name], order=rp.report_order(name))
        back[name] = sinks.read_report_csv(spark, path, name)
    return _as_text(back)


@query("scan_report", _ALL_REPORTS_SQL)
def scan_report(spark, sf):
    back = {}
    for name, df in _all_reports(Inputs(spark, sf)).items():
        path = shared_dir(spark, f"scan_{name}")
        sinks.write_table(df, path)
        back[name] = sinks.scan_table(spark, path)
    return _as_text(back)


@query("airport_dim", """
SELECT airport, CAST(coalesce(c.n, 0) AS BIGINT) AS trips
FROM airport a LEFT JOIN (
    SELECT airport, count(trip_id) AS n FROM airport_zip z JOIN stg_trips t ON t.pickup_zip = z.zip GROUP BY airport) c
  USING (airport)""")
def airport_dim_q(spark, sf):
    i = Inputs(spark, sf)
    dim = rp.airport_dim(spark, AIRPORTS)
    per = (
        i.stg_trips.where(F.col("pickup_zip").isin(AIRPORT_ZIPS))
        .groupBy(airport_from_zip("pickup_zip", AIRPORTS).alias("_a"))
        .agg(F.count("trip_id").alias("n"))
    )
    return zero_filled_left_join(dim, per, [("airport", "_a")], {"trips": "n"})


# ================================================================= 2.2 sinks
@query("sink_create_if_absent", "SELECT * FROM r5")
def sink_create_if_absent(spark, sf):
    i = Inputs(spark, sf)
    path = shared_dir(spark, "sink_create_if_absent")
    r5 = rp.report5_waiver(i.stg_health, i.stg_permits)
    sinks.write_table(r5, path, mode="ignore")
    sinks.write_table(r5.unionByName(r5), path, mode="ignore")  # present: skipped
    return sinks.scan_table(spark, path)


@query("sink_append", "SELECT * FROM stg_health UNION ALL SELECT * FROM stg_health")
def sink_append(spark, sf):
    i = Inputs(spark, sf)
    path = shared_dir(spark, "sink_append")
    sinks.write_table(i.stg_health, path, mode="overwrite")
    sinks.write_table(i.stg_health, path, mode="append")
    return sinks.scan_table(spark, path)


@query("sink_append_batches", "SELECT * FROM stg_health")
def sink_append_batches(spark, sf):
    """Two batches, each delivered twice: every row is there once."""
    i = Inputs(spark, sf)
    path, odd = shared_dir(spark, "sink_append_batches"), F.col("community_area") % 2 == 1
    parts = {"odd": i.stg_health.where(odd), "rest": i.stg_health.where(~F.coalesce(odd, F.lit(False)))}
    for _ in range(2):
        for name, part in parts.items():
            append_batch(spark, lambda part=part: part, path, name)
    return sinks.scan_table(spark, path)


def _json_sql(name: str, cte: str) -> str:
    """The raw JSON line of each report row, keys in order."""
    headers, types = schemas.REPORT_HEADERS[name], schemas.report_types(name)
    parts = []
    for c, h in sorted(headers.items(), key=lambda x: x[1]):
        if types[c] == "date":
            value = f"""'"' || strftime({c}, '%Y-%m-%dT00:00:00Z') || '"'"""
        elif types[c] in ("bigint", "integer"):
            value = f"CAST({c} AS VARCHAR)"
        else:
            value = f"""'"' || CAST({c} AS VARCHAR) || '"'"""
        parts.append(f"""'"{h}":' || ifnull({value}, 'null')""")
    line = " || ',' || ".join(parts)
    return f"SELECT '{name}' AS report, '{{' || {line} || '}}' AS line FROM {cte}"


@query("sink_json_report", "\nUNION ALL\n".join(_json_sql(name, cte) for name, cte in _REPORT_CTES.items()))
def sink_json_report(spark, sf):
    out = None
    for name, df in _all_reports(Inputs(spark, sf)).items():
        path = shared_dir(spark, f"json_{name}")
        sinks.write_json(
            df, path, headers=schemas.REPORT_HEADERS[name], types=schemas.report_types(name), order=rp.report_order(name)
        )
        part = spark.read.text(path).select(F.lit(name).alias("report"), F.col("value").alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


# ================================================ 2.3 projections and derived
@query("stage_trips", "SELECT * FROM stg_trips")
def stage_trips(spark, sf):
    return Inputs(spark, sf).stg_trips.drop("pickup_point", "dropoff_point")


@query("stage_trips_kept_points", "SELECT * FROM stg_trips")
def stage_trips_kept_points(spark, sf):
    """Staging over a kept point dictionary: permits bring their points first,
    trips add theirs."""
    i = Inputs(spark, sf)
    known = PointDictionary(spark, shared_dir(spark, "points"), [i.zip_index, i.area_index])
    known.update(st.point_sources(permits=i.permits))
    known.update(st.point_sources(trips=i.trips))
    return st.stage_trips(i.trips, i.zip_index, i.area_index, dictionary=known).drop("pickup_point", "dropoff_point")


@query("stage_covid", "SELECT * FROM stg_covid")
def stage_covid(spark, sf):
    return Inputs(spark, sf).stg_covid


@query("stage_ccvi", "SELECT * FROM stg_ccvi")
def stage_ccvi(spark, sf):
    return Inputs(spark, sf).stg_ccvi


@query("stage_permits", "SELECT * FROM stg_permits")
def stage_permits(spark, sf):
    return Inputs(spark, sf).stg_permits.drop("location_point")


@query("stage_health", "SELECT * FROM stg_health")
def stage_health(spark, sf):
    return Inputs(spark, sf).stg_health


@query("cal_week_start", "SELECT trip_id, trip_start, week_start FROM trips_l")
def cal_week_start(spark, sf):
    t = dt.trips_raw(spark, sf)
    return t.select("trip_id", "trip_start", cal.week_start("trip_start").alias("week_start"))


@query("cal_week_start_iso", "SELECT trip_id, trip_start, week_start_iso FROM trips_l")
def cal_week_start_iso(spark, sf):
    t = dt.trips_raw(spark, sf)
    return t.select("trip_id", "trip_start", cal.week_start_iso("trip_start").alias("week_start_iso"))


@query("cal_week_label", """
SELECT trip_id, trip_start,
       CAST(week(week_start_iso) AS VARCHAR) || '-' || CAST(year(week_start_iso) AS VARCHAR) AS week_number
FROM trips_l""")
def cal_week_label(spark, sf):
    t = dt.trips_raw(spark, sf)
    return t.select("trip_id", "trip_start", cal.week_label(cal.week_start_iso("trip_start")).alias("week_number"))


@query("cal_month_label", """
SELECT trip_id, trip_start, CAST(month(trip_start) AS VARCHAR) || '-' || CAST(year(trip_start) AS VARCHAR) AS month_number
FROM trips_l""")
def cal_month_label(spark, sf):
    t = dt.trips_raw(spark, sf)
    return t.select("trip_id", "trip_start", cal.month_label("trip_start").alias("month_number"))


@query("impute_area", """
SELECT t.trip_id, t.pickup_community_area AS own_area, h.area AS matched_area,
       list_filter([t.pickup_community_area, h.area], lambda n: n <> 0)[1] AS community_area
FROM trips_l t LEFT JOIN area_hit h ON h.x = t.px AND h.y = t.py""")
def impute_area_q(spark, sf):
    i = Inputs(spark, sf)
    t = i.trips.select("trip_id", "pickup_community_area", "pickup_point")
    j = within_left_join(t, "pickup_point", i.areas, {"matched_area": "area_numbe"})
    return j.select(
        "trip_id",
        F.col("pickup_community_area").alias("own_area"),
        "matched_area",
        impute_area("pickup_community_area", "matched_area").alias("community_area"),
    )


@query("prefix_label", "SELECT DISTINCT week_number AS label, 'WEEK-' || week_number AS prefixed FROM stg_covid")
def prefix_label(spark, sf):
    c = Inputs(spark, sf).stg_covid
    return c.select(F.col("week_number").alias("label"), cal.prefix_label("week_number").alias("prefixed")).distinct()


@query("zero_fill", """
SELECT zip, CAST(ifnull(sum(cases), 0) AS BIGINT) AS total_cases FROM zips LEFT JOIN covid_cells USING (zip) GROUP BY zip""")
def zero_fill(spark, sf):
    i = Inputs(spark, sf)
    cases = i.stg_covid.groupBy(F.col("zip_code").cast("int").alias("_zc")).agg(F.sum("cases_weekly").alias("n"))
    return zero_filled_left_join(i.zip_keys, cases, [("zip", "_zc")], {"total_cases": "n"})


@query("full_outer_merge", "SELECT week_number, week_start, community_area, trips_from, trips_to FROM area_weeks")
def full_outer_merge(spark, sf):
    return rp.area_week_counts(Inputs(spark, sf).stg_trips)


@query("airport_from_zip", """
SELECT pickup_zip, airport, n
FROM (SELECT pickup_zip, count(trip_id) AS n FROM stg_trips WHERE pickup_zip IS NOT NULL GROUP BY pickup_zip) p
LEFT JOIN airport_zip z ON z.zip = p.pickup_zip""")
def airport_from_zip_q(spark, sf):
    t = Inputs(spark, sf).stg_trips.where(F.col("pickup_zip").isNotNull())
    return t.groupBy("pickup_zip", airport_from_zip("pickup_zip", AIRPORTS).alias("airport")).agg(
        F.count("trip_id").alias("n")
    )


@query("score_sum", "SELECT community_area, unemployment + below_poverty_level AS score FROM stg_health")
def score_sum_q(spark, sf):
    h = Inputs(spark, sf).stg_health
    return h.select("community_area", score_sum("unemployment", "below_poverty_level").alias("score"))


@query("severity_actual", "SELECT week_start, week_number, zip, total_trip_count, weekly_positive_cases, severity FROM r1")
def severity_actual(spark, sf):
    i = Inputs(spark, sf)
    return rp.report1_severity(i.stg_trips, i.stg_covid, i.zips).drop("forecasted_severity")


@query("severity_forecast", "SELECT week_start, week_number, zip, forecasted_severity FROM r1")
def severity_forecast(spark, sf):
    i = Inputs(spark, sf)
    return rp.report1_severity(i.stg_trips, i.stg_covid, i.zips).select(
        "week_start", "week_number", "zip", "forecasted_severity"
    )


# ==================================================== 2.4 filters, predicates
@query("filter_any_location", """
SELECT trip_id, px AS pickup_x, py AS pickup_y, dx AS dropoff_x, dy AS dropoff_y
FROM trips_l WHERE coalesce(px, dx) IS NOT NULL""")
def filter_any_location(spark, sf):
    t = Inputs(spark, sf).trips
    return t.where(F.col("pickup_point").isNotNull() | F.col("dropoff_point").isNotNull()).select(
        "trip_id", *_xy("pickup_point", "pickup"), *_xy("dropoff_point", "dropoff")
    )


@query("filter_known_zip", """
SELECT zip_code, week_start, cases_weekly FROM covid_l
WHERE loc_x IS NOT NULL AND ifnull(zip_code, 'Unknown') <> 'Unknown'""")
def filter_known_zip(spark, sf):
    c = Inputs(spark, sf).covid
    known = F.col("zip_code").isNotNull() & (F.col("zip_code") != "Unknown") & F.col("zip_point").isNotNull()
    return c.where(known).select("zip_code", "week_start", "cases_weekly")


@query("filter_trim_eq", "SELECT geography_type, area_or_zip, ccvi_category FROM ccvi_l WHERE trim(geography_type) = 'CA'")
def filter_trim_eq(spark, sf):
    c = Inputs(spark, sf).ccvi
    return c.where(F.trim("geography_type") == "CA").select("geography_type", "area_or_zip", "ccvi_category")


@query("filter_in_list", """
SELECT trip_id, pickup_zip, dropoff_zip, week_number FROM stg_trips
WHERE dropoff_zip IS NOT NULL AND pickup_zip IN (SELECT zip FROM airport_zip)""")
def filter_in_list(spark, sf):
    t = Inputs(spark, sf).stg_trips
    return t.where(F.col("pickup_zip").isin(AIRPORT_ZIPS) & F.col("dropoff_zip").isNotNull()).select(
        "trip_id", "pickup_zip", "dropoff_zip", "week_number"
    )


@query("filter_nonzero", """
SELECT trip_id, pickup_community_area FROM trips_l
WHERE pickup_community_area <> 0""")
def filter_nonzero(spark, sf):
    t = dt.trips_raw(spark, sf)
    return t.where(F.col("pickup_community_area") != 0).select("trip_id", "pickup_community_area")


@query("filter_upper_eq", "SELECT * FROM stg_ccvi WHERE ccvi_category ILIKE 'high'")
def filter_upper_eq(spark, sf):
    return Inputs(spark, sf).stg_ccvi.where(F.upper("ccvi_category") == "HIGH")


@query("filter_lt", "SELECT * FROM stg_health WHERE per_capita_income < 30000")
def filter_lt(spark, sf):
    return Inputs(spark, sf).stg_health.where(F.col("per_capita_income") < 30000)


# ================================================================= 2.5 joins
def _endpoints(trips: DataFrame) -> DataFrame:
    return trips.select(
        "trip_id",
        F.inline(
            F.array(
                F.struct(F.lit("pickup").alias("role"), F.col("pickup_point").alias("point")),
                F.struct(F.lit("dropoff").alias("role"), F.col("dropoff_point").alias("point")),
            )
        ),
    )


def _endpoint_join_sql(hit: str, key: str) -> str:
    return f"""
SELECT trip_id, 'pickup' AS role, px AS x, py AS y, h.{key} FROM trips_l LEFT JOIN {hit} h ON h.x = px AND h.y = py
UNION ALL
SELECT trip_id, 'dropoff', dx, dy, h.{key} FROM trips_l LEFT JOIN {hit} h ON h.x = dx AND h.y = dy"""


@query("spatial_left_join_zip", _endpoint_join_sql("zip_hit", "zip"))
def spatial_left_join_zip(spark, sf):
    i = Inputs(spark, sf)
    j = within_left_join(_endpoints(i.trips), "point", i.zips, {"zip": "zip"})
    return j.select("trip_id", "role", F.col("point")["x"].alias("x"), F.col("point")["y"].alias("y"), "zip")


@query("spatial_left_join_area", _endpoint_join_sql("area_hit", "area"))
def spatial_left_join_area(spark, sf):
    i = Inputs(spark, sf)
    j = within_left_join(_endpoints(i.trips), "point", i.areas, {"area": "area_numbe"})
    return j.select("trip_id", "role", F.col("point")["x"].alias("x"), F.col("point")["y"].alias("y"), "area")


@query("spatial_adaptive_join_zip", _endpoint_join_sql("zip_hit", "zip"))
def spatial_adaptive_join_zip(spark, sf):
    """The same join over a cover that follows the density of the points."""
    i = Inputs(spark, sf)
    j = within_left_join(_endpoints(i.trips), "point", i.zips, {"zip": "zip"}, cover=DensityCover)
    return j.select("trip_id", "role", F.col("point")["x"].alias("x"), F.col("point")["y"].alias("y"), "zip")


@query("geo_point_in_polygon", """
SELECT p.x, p.y, count(h.zip) AS n_zip
FROM (SELECT DISTINCT px AS x, py AS y FROM trips_l WHERE px IS NOT NULL) p
LEFT JOIN zip_hit h ON h.x = p.x AND h.y = p.y
GROUP BY p.x, p.y""")
def geo_point_in_polygon(spark, sf):
    i = Inputs(spark, sf)
    pts = i.trips.where(F.col("pickup_point").isNotNull()).select(F.col("pickup_point").alias("p")).distinct()
    j = within_left_join(pts, "p", i.zips, {"zip": "zip"})
    return j.groupBy(F.col("p")["x"].alias("x"), F.col("p")["y"].alias("y")).agg(F.count("zip").alias("n_zip"))


@query("spine_week_zip", "SELECT * FROM covid_weeks_zips")
def spine_week_zip(spark, sf):
    i = Inputs(spark, sf)
    return dense_spine(i.stg_covid.select("week_number"), i.zip_keys)


@query("spine_week_zip_airport", "SELECT * FROM r2_spine")
def spine_week_zip_airport(spark, sf):
    i = Inputs(spark, sf)
    return dense_spine(i.stg_covid.select("week_number"), rp.airport_dim(spark, AIRPORTS), i.zip_keys)


@query("spine_tripweek_zip", "SELECT week_number, week_start, zip FROM cells_weekstart")
def spine_tripweek_zip(spark, sf):
    i = Inputs(spark, sf)
    return dense_spine(i.stg_trips.select("week_number", "week_start"), i.zip_keys)


@query("spine_month_zip", "SELECT month_number, zip FROM cells_month")
def spine_month_zip(spark, sf):
    i = Inputs(spark, sf)
    return dense_spine(i.stg_trips.select("month_number"), i.zip_keys)


@query("spine_day_zip", "SELECT trip_start AS date, zip FROM cells_day")
def spine_day_zip(spark, sf):
    i = Inputs(spark, sf)
    return dense_spine(i.stg_trips.select(F.col("trip_start").alias("date")), i.zip_keys)


@query("spine_left_counts", "SELECT trip_start AS date, zip, total_trip_count FROM cells_day")
def spine_left_counts(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4c_daily(i.stg_trips, i.zips).drop("forecasted_trip_count")


@query("left_join_cast_key", """
SELECT week_number, zip, week_start, CAST(ifnull(cases, 0) AS BIGINT) AS weekly_positive_cases
FROM covid_weeks_zips LEFT JOIN covid_cells USING (week_number, zip)""")
def left_join_cast_key(spark, sf):
    i = Inputs(spark, sf)
    spine = dense_spine(i.stg_covid.select("week_number"), i.zip_keys)
    cov = i.stg_covid.select(
        F.col("zip_code").cast("int").alias("_z"), F.col("week_number").alias("_w"), "week_start", "cases_weekly"
    )
    j = spine.join(cov, (spine["zip"] == cov["_z"]) & (spine["week_number"] == cov["_w"]), "left")
    return j.select(
        "week_number", "zip", "week_start",
        F.coalesce(F.col("cases_weekly"), F.lit(0)).cast("long").alias("weekly_positive_cases"),
    )


@query("left_join_3key", "SELECT * FROM r2_base")
def left_join_3key(spark, sf):
    return _left_join_3key(Inputs(spark, sf))


def _left_join_3key(i: Inputs) -> DataFrame:
    spine = dense_spine(i.stg_covid.select("week_number"), rp.airport_dim(i.spark, AIRPORTS), i.zip_keys)
    t = i.stg_trips.where(F.col("pickup_zip").isin(AIRPORT_ZIPS) & F.col("dropoff_zip").isNotNull())
    counts = t.groupBy(
        "week_number", airport_from_zip("pickup_zip", AIRPORTS).alias("from_airport"), F.col("dropoff_zip").alias("to_zip")
    ).agg(F.count("trip_id").alias("n"))
    return zero_filled_left_join(
        spine, counts, [("week_number", "week_number"), ("airport", "from_airport"), ("zip", "to_zip")], {"trip_count": "n"}
    )


@query("left_join_dim_fact", """
SELECT community_area, ccvi_category, n AS trips_from
FROM (FROM stg_ccvi WHERE ccvi_category ILIKE 'high')
LEFT JOIN (SELECT area AS community_area, count(trip_id) AS n FROM stg_ends WHERE role = 'pickup' GROUP BY area)
  USING (community_area)""")
def left_join_dim_fact(spark, sf):
    i = Inputs(spark, sf)
    high = i.stg_ccvi.where(F.upper("ccvi_category") == "HIGH")
    f = (
        i.stg_trips.where(F.col("pickup_community_area") != 0)
        .groupBy(F.col("pickup_community_area").alias("_area"))
        .agg(F.count("trip_id").alias("trips_from"))
    )
    return high.join(f, high["community_area"] == f["_area"], "left").select("community_area", "ccvi_category", "trips_from")


@query("topk_left_join_sum", "SELECT * FROM r5")
def topk_left_join_sum(spark, sf):
    i = Inputs(spark, sf)
    return rp.report5_waiver(i.stg_health, i.stg_permits)


@query("inner_join_area", """
SELECT permit_no, community_area, per_capita_income FROM new_buildings JOIN stg_health USING (community_area)""")
def inner_join_area(spark, sf):
    i = Inputs(spark, sf)
    nc = rp.new_construction(i.stg_permits)
    h = i.stg_health.select(F.col("community_area").alias("_area"), "per_capita_income")
    return nc.join(h, nc["community_area"] == h["_area"]).select("permit_no", "community_area", "per_capita_income")


@query("inner_join_min_zip", """
SELECT zip, permit_no FROM new_buildings WHERE zip IN (SELECT zip FROM least_built)""")
def inner_join_min_zip(spark, sf):
    i = Inputs(spark, sf)
    nc = rp.new_construction(i.stg_permits)
    z = rp.least_built_zips(i.stg_permits).select(F.col("zip").alias("_zip"))
    return nc.join(z, nc["zip"] == z["_zip"], "left_semi").select("zip", "permit_no")


@query("argmin_with_ties", "SELECT * FROM least_built")
def argmin_with_ties(spark, sf):
    return rp.least_built_zips(Inputs(spark, sf).stg_permits)


# ========================================================== 2.6 aggregations
def _role_counts_sql(name: str, alias: str | None = None) -> str:
    return f"""
SELECT {PERIODS[name]} AS {alias or PERIODS[name]}, zip,
       CAST(sum(n) FILTER (role = 'pickup') AS BIGINT).ifnull(0) AS n_pickup,
       CAST(sum(n) FILTER (role = 'dropoff') AS BIGINT).ifnull(0) AS n_dropoff
FROM ends_{name} GROUP BY {PERIODS[name]}, zip"""


def _role_counts(i: Inputs, period: str, alias: str | None = None) -> DataFrame:
    t = i.stg_trips if alias is None else i.stg_trips.withColumnRenamed(period, alias)
    g = agg.endpoint_counts(t, [alias or period])
    return g.where(F.col("zip").isNotNull()).select(alias or period, "zip", "n_pickup", "n_dropoff")


@query("trips_by_week_zip", _role_counts_sql("week"))
def trips_by_week_zip(spark, sf):
    return _role_counts(Inputs(spark, sf), "week_number")


@query("trips_by_weekstart_zip", _role_counts_sql("weekstart"))
def trips_by_weekstart_zip(spark, sf):
    return _role_counts(Inputs(spark, sf), "week_start")


@query("trips_by_month_zip", _role_counts_sql("month"))
def trips_by_month_zip(spark, sf):
    return _role_counts(Inputs(spark, sf), "month_number")


@query("trips_by_day_zip", _role_counts_sql("day", "date"))
def trips_by_day_zip(spark, sf):
    return _role_counts(Inputs(spark, sf), "trip_start", "date")


@query("endpoint_total", "SELECT week_number, zip, total AS total_trip_count FROM total_week")
def endpoint_total(spark, sf):
    return agg.endpoint_totals(Inputs(spark, sf).stg_trips, ["week_number"])


@query("airport_trips", "SELECT week_number, from_airport, to_zip, n FROM r2_atc")
def airport_trips(spark, sf):
    t = Inputs(spark, sf).stg_trips.where(F.col("pickup_zip").isin(AIRPORT_ZIPS) & F.col("dropoff_zip").isNotNull())
    return t.groupBy(
        "week_number", airport_from_zip("pickup_zip", AIRPORTS).alias("from_airport"), F.col("dropoff_zip").alias("to_zip")
    ).agg(F.count("trip_id").alias("n"))


def _side_counts(i: Inputs, col: str, out: str) -> DataFrame:
    return (
        i.stg_trips.where(F.col(col) != 0)
        .groupBy("week_number", "week_start", F.col(col).alias("community_area"))
        .agg(F.count("trip_id").alias(out))
    )


@query("trips_from_area", "SELECT week_number, week_start, community_area, trips_from AS from_count FROM area_weeks WHERE has_from")
def trips_from_area(spark, sf):
    return _side_counts(Inputs(spark, sf), "pickup_community_area", "from_count")


@query("trips_to_area", "SELECT week_number, week_start, community_area, trips_to AS to_count FROM area_weeks WHERE has_to")
def trips_to_area(spark, sf):
    return _side_counts(Inputs(spark, sf), "dropoff_community_area", "to_count")


@query("quartiles_global", "SELECT * FROM r1_iqr")
def quartiles_global(spark, sf):
    i = Inputs(spark, sf)
    base = rp.report1_base(i.stg_trips, i.stg_covid, i.zips)
    return base.agg(
        F.percentile("total_trip_count", 0.25).alias("q1_trips"),
        F.percentile("total_trip_count", 0.75).alias("q3_trips"),
        F.percentile("weekly_positive_cases", 0.25).alias("q1_cases"),
        F.percentile("weekly_positive_cases", 0.75).alias("q3_cases"),
    )


@query("quartiles_selected", "SELECT * FROM r1_iqr")
def quartiles_selected(spark, sf):
    """The same quartiles by selection over narrowing value ranges."""
    i, path = Inputs(spark, sf), shared_dir(spark, "report1_base")
    base = rp.report1_base(None, i.stg_covid, i.zips, i.days)
    sinks.write_table(base, path)
    base = sinks.scan_table(spark, path)
    q = exact_quartiles(base, ["total_trip_count", "weekly_positive_cases"], collect=100)
    names = {"q1_trips": "q1_total_trip_count", "q3_trips": "q3_total_trip_count", "q1_cases": "q1_weekly_positive_cases", "q3_cases": "q3_weekly_positive_cases"}
    return base.groupBy().agg(F.count("*").alias("n")).select(*[q[field].alias(name) for name, field in names.items()])


@query("permits_by_zip", "SELECT * FROM built")
def permits_by_zip(spark, sf):
    return rp.permits_by_zip(Inputs(spark, sf).stg_permits)


# ================================================================ 2.7 windows
@query("trailing_avg_inclusive", "SELECT week_start, week_number, zip, avg_trip_count, avg_cases FROM r1_avg")
def trailing_avg_inclusive(spark, sf):
    i = Inputs(spark, sf)
    base = rp.report1_base(i.stg_trips, i.stg_covid, i.zips)
    return rp.report1_averages(base).select("week_start", "week_number", "zip", "avg_trip_count", "avg_cases")


@query("trailing_avg_by_year", "SELECT week_start, week_number, zip, avg_trip_count, avg_cases FROM r1_avg")
def trailing_avg_by_year(spark, sf):
    """The same averages with each ZIP's history split by year."""
    i = Inputs(spark, sf)
    base = rp.report1_base(i.stg_trips, i.stg_covid, i.zips)
    return rp.report1_averages(base, by_year=True).select("week_start", "week_number", "zip", "avg_trip_count", "avg_cases")


@query("forecast_weekly", "SELECT * FROM r4a")
def forecast_weekly(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4a_weekly(i.stg_trips, i.zips)


@query("forecast_monthly", "SELECT * FROM r4b")
def forecast_monthly(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4b_monthly(i.stg_trips, i.zips)


@query("forecast_daily", "SELECT * FROM r4c")
def forecast_daily(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4c_daily(i.stg_trips, i.zips)


# ======================================================= 2.8 sorts and top-k
@query("sort_week_zip", "SELECT * FROM r4a ORDER BY week_start DESC NULLS FIRST, zip ASC NULLS LAST")
def sort_week_zip(spark, sf):
    i = Inputs(spark, sf)
    return rp.ordered(rp.report4a_weekly(i.stg_trips, i.zips), "rpttbl04a")


@query("sort_month_label", """
SELECT * FROM r4b ORDER BY CAST(split_part(month_number, '-', 2) AS INTEGER) DESC NULLS FIRST,
                           CAST(split_part(month_number, '-', 1) AS INTEGER) DESC NULLS FIRST, zip""")
def sort_month_label(spark, sf):
    i = Inputs(spark, sf)
    return rp.ordered(rp.report4b_monthly(i.stg_trips, i.zips), "rpttbl04b")


@query("topk_score", "SELECT * FROM neediest")
def topk_score(spark, sf):
    return rp.neediest_areas(Inputs(spark, sf).stg_health)


# ============================================================ 2.9 set ops
@query("union_distinct", "SELECT DISTINCT week_number, zip, n AS trip_count FROM ends_week")
def union_distinct(spark, sf):
    g = agg.endpoint_counts(Inputs(spark, sf).stg_trips, ["week_number"])
    return agg.union_distinct_rows(g, ["week_number"])


# ===================================================== 2.10 scalar functions
@query("cast_text_numeric", "SELECT id, subtotal_unpaid AS unpaid_text, CAST(subtotal_unpaid AS DECIMAL(18,2)) AS unpaid FROM permits_l")
def cast_text_numeric(spark, sf):
    p = dt.permits_raw(spark, sf)
    return p.select("id", F.col("subtotal_unpaid").alias("unpaid_text"), F.col("subtotal_unpaid").cast(schemas.MONEY).alias("unpaid"))


@query("split_label", """
SELECT DISTINCT month_number, CAST(split_part(month_number, '-', 2) AS INTEGER) AS year,
       CAST(split_part(month_number, '-', 1) AS INTEGER) AS month
FROM stg_trips""")
def split_label(spark, sf):
    t = Inputs(spark, sf).stg_trips
    return t.select(
        "month_number", cal.label_part("month_number", 2).alias("year"), cal.label_part("month_number", 1).alias("month")
    ).distinct()


# ========================================================= 2.13 pipelines
# The report keys run the pipeline's plan: the six trip reports roll up the
# shared per-day counts (``trip_day_facts``).  The window / severity / sort
# keys above run the same reports straight from the trips, so both paths
# are checked against the oracle.
@query("report1_severity", f"SELECT {_R1_COLS} FROM r1")
def report1_severity(spark, sf):
    i = Inputs(spark, sf)
    return rp.report1_severity(i.stg_trips, i.stg_covid, i.zips, i.days)


@query("report2_airport", "SELECT * FROM r2")
def report2_airport(spark, sf):
    i = Inputs(spark, sf)
    return rp.report2_airport(i.stg_trips, i.stg_covid, i.zips, AIRPORTS, i.days)


@query("report3_ccvi", "SELECT * FROM r3")
def report3_ccvi(spark, sf):
    i = Inputs(spark, sf)
    return rp.report3_ccvi(i.stg_trips, i.stg_ccvi, i.days)


@query("report4a_weekly", "SELECT * FROM r4a")
def report4a_weekly(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4a_weekly(i.stg_trips, i.zips, i.days)


@query("report4b_monthly", "SELECT * FROM r4b")
def report4b_monthly(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4b_monthly(i.stg_trips, i.zips, i.days)


@query("report4c_daily", "SELECT * FROM r4c")
def report4c_daily(spark, sf):
    i = Inputs(spark, sf)
    return rp.report4c_daily(i.stg_trips, i.zips, i.days)


@query("report5_waiver", "SELECT * FROM r5")
def report5_waiver(spark, sf):
    i = Inputs(spark, sf)
    return rp.report5_waiver(i.stg_health, i.stg_permits)


@query("report6_loans", "SELECT * FROM r6")
def report6_loans(spark, sf):
    i = Inputs(spark, sf)
    return rp.report6_loans(i.stg_permits, i.stg_health)


_TRIP_REPORTS = [name for name in _REPORT_CTES if name < "rpttbl05"]


@query("report_refresh", "\nUNION ALL\n".join(
    "SELECT '{0}' AS report, concat_ws('|', {1}) AS fields FROM {2}".format(
        name, ", ".join(f"ifnull(CAST({c} AS VARCHAR), '-')" for c in schemas.REPORT_HEADERS[name]), _REPORT_CTES[name]
    )
    for name in _TRIP_REPORTS
))
def report_refresh(spark, sf):
    """The trip reports built without one spring, then refreshed with it."""
    i, root, path = Inputs(spark, sf), shared_dir(spark, "reports"), shared_dir(spark, "days")
    facts = i.days.withColumn("month_number", cal.month_label("trip_start"))
    late = F.col("trip_start").between(F.lit("1996-04-10").cast("date"), F.lit("1996-05-20").cast("date"))
    early = facts.where(F.col("trip_start").isNull() | ~late)
    touched = [r[0] for r in i.stg_trips.where(late).select("trip_start").distinct().collect()]
    for rows, days in ((early, None), (facts, touched)):
        sinks.write_table(rows, path, partition_by=["month_number"])
        kept = sinks.scan_table(spark, path, schema=rows.schema)
        out = refresh(spark, root, kept, i.stg_covid, i.stg_ccvi, i.zips, days, AIRPORTS)
    return _as_text({name: out[name] for name in _TRIP_REPORTS})


_PIPELINE_COLUMNS = {
    "staging.trips_data": ("stg_trips", "trip_id trip_start pickup_community_area dropoff_community_area pickup_zip dropoff_zip week_number month_number"),
    "staging.covid_by_zip": ("stg_covid", "zip_code week_start cases_weekly tests_cumulative week_number month_number"),
    "staging.ccvi_by_ca": ("stg_ccvi", "community_area ccvi_category"),
    "staging.building_permit": ("stg_permits", "id permit_no permit_type subtotal_unpaid community_area zip"),
    "staging.public_health": ("stg_health", "community_area per_capita_income"),
    **{f"summarised.{name}": (cte, " ".join(schemas.REPORT_HEADERS[name])) for name, cte in _REPORT_CTES.items()},
}


@query("pipeline_end_to_end", "\nUNION ALL\n".join(
    "SELECT '{0}' AS table_name, concat_ws('|', {1}) AS fields FROM {2}".format(
        name, ", ".join(f"ifnull(CAST({c} AS VARCHAR), '-')" for c in cols.split()), cte
    )
    for name, (cte, cols) in _PIPELINE_COLUMNS.items()
))
def pipeline_end_to_end(spark, sf):
    """The contents of every staged and summarised table that one run writes."""
    raw = {name: (lambda fn=fn: fn(spark, sf)) for name, fn in dt.RAW.items()}
    written = run_pipeline(spark, raw, shared_dir(spark, "pipeline"), airports=AIRPORTS)
    out = None
    for name, (_, cols) in _PIPELINE_COLUMNS.items():
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols.split()]
        part = sinks.scan_table(spark, written[name]).select(F.lit(name).alias("table_name"), F.concat_ws("|", *fields).alias("fields"))
        out = part if out is None else out.unionByName(part)
    return out
