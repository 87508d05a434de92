"""Summarised zone: the eight reports.

Inputs are staged frames (``plans.staging``) plus the landed ZIP polygons
(the reference takes its ZIP list from the polygon table).  Column names
are snake_case; ``schemas.REPORT_HEADERS`` maps them to the reference's
headers at the sinks.

Differences from the reference's text, all deliberate and documented in
SURVEY §1.5 / §4:

* in-place ``UPDATE … FROM`` of severity and forecasts is a column computed
  on the row itself (R4), so duplicated labels cannot pick an arbitrary
  match (S18);
* every window order gets tie-breaks so ties the reference leaves to
  chance are deterministic (S17), and top-5 ties break on the area;
* pickup/dropoff counts come from one scan and one aggregate (R3), with the
  ``UNION``-distinct arithmetic kept exactly (S5).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions import calendar as cal
from ..functions.columns import airport_from_zip, score_sum, severity
from ..operators.aggregates import (
    endpoint_counts,
    rollup_endpoint_counts,
    forecast_int,
    keep_min,
    quartiles,
    top_k,
    trailing_avg,
    trailing_avgs_by_range,
    union_distinct_total,
)
from ..operators.quantiles import exact_quartiles
from ..operators.spine import dense_spine, zero_filled_left_join
from ..schemas import REFERENCE_AIRPORTS

# Fixed value: the permit type as the source spells it.
NEW_CONSTRUCTION = "PERMIT - NEW CONSTRUCTION"


def report_order(report: str) -> list[Column]:
    """Row order of a report (H1-H6); none for report 6."""
    newest = [F.col("week_start").desc_nulls_first()]
    up = lambda *names: [F.col(n).asc_nulls_last() for n in names]
    return {
        "rpttbl01": [*newest, *up("zip")],
        "rpttbl02": [*newest, *up("from_airport", "to_zip_code")],
        "rpttbl03": [*newest, *up("community_area")],
        "rpttbl04a": [*newest, *up("zip")],
        "rpttbl04b": [*[cal.label_part("month_number", i).desc_nulls_first() for i in (2, 1)], *up("zip")],
        "rpttbl04c": [F.col("date").desc_nulls_first(), *up("zip")],
        "rpttbl05": up("total_fees_waived", "community_area"),
        "rpttbl06": [],
    }[report]


def ordered(df: DataFrame, report: str) -> DataFrame:
    """``df`` in the order of its report.  Tables are written unordered (files
    keep no order); exports and the order keys sort."""
    order = report_order(report)
    return df.orderBy(*order) if order else df


def _zips(zip_polygons: DataFrame) -> DataFrame:
    return zip_polygons.select(F.col("zip").cast("int").alias("zip"))


def _covid_cases(covid: DataFrame) -> DataFrame:
    """COVID side of the (ZIP, week label) join: the text ZIP is cast to a number."""
    return covid.select(
        F.col("zip_code").cast("decimal(18,2)").cast("int").alias("_c_zip"),
        F.col("week_number").alias("_c_week"),
        F.col("week_start").alias("_c_week_start"),
        F.col("cases_weekly").alias("_c_cases"),
    )


def trip_day_facts(trips: DataFrame, airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS) -> DataFrame:
    """One scan of the staged trips → small per-day counts for all six trip reports.

    Rows are tagged by ``kind``:

    * ``zip`` — (day, ZIP) pickup / dropoff counts, NULL ZIP included
      (reports 1, 4A-4C);
    * ``area`` — (day, community area) from / to counts, areas 0 and NULL
      dropped (report 3);
    * ``air`` — (day, airport pickup ZIP, dropoff ZIP) counts (report 2).

    ``n_a`` / ``n_b`` count non-NULL trip ids of the first / second role and
    ``has_a`` / ``has_b`` say whether the role has rows at all.  Counts add
    and flags OR, so every weekly / monthly figure rolls up exactly from the
    day; ``run_pipeline`` writes this table once (days × keys: small) and
    the reports read it instead of the trips.  The reports re-derive week
    start and labels from the day with the same functions staging uses, so
    the staged table is expected to come from ``stage_trips``.
    """
    air = [z for zs in airports.values() for z in zs]
    is_air = F.col("pickup_zip").isin(air) & F.col("dropoff_zip").isNotNull()
    null_int = F.lit(None).cast("int")
    # a trip counts in each of its roles; each task adds up its trips by day and key
    # before any row moves, so what moves follows the days and keys, not the trips
    counted = trips.withColumn("_n", F.col("trip_id").isNotNull().cast("int"))

    def part(kind, k1, k2, first):
        return F.struct(kind.alias("kind"), k1.cast("int").alias("k1"), k2.alias("k2"), F.lit(first).alias("_a"))

    parts = F.array(
        part(F.lit("zip"), F.col("pickup_zip"), null_int, True),
        part(F.lit("zip"), F.col("dropoff_zip"), null_int, False),
        part(F.lit("area"), F.col("pickup_community_area"), null_int, True),
        part(F.lit("area"), F.col("dropoff_community_area"), null_int, False),
        part(F.when(is_air, F.lit("air")), F.col("pickup_zip"), F.col("dropoff_zip").cast("int"), True),
    )
    ex = counted.select("trip_start", "_n", F.inline(parts)).where(
        F.col("kind").isNotNull() & ((F.col("kind") != "area") | (F.col("k1") != 0))
    )
    return ex.groupBy("kind", "trip_start", "k1", "k2").agg(
        F.sum(F.when(F.col("_a"), F.col("_n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(~F.col("_a"), F.col("_n")).otherwise(0)).alias("n_b"),
        F.max(F.col("_a")).alias("has_a"),
        F.max(~F.col("_a")).alias("has_b"),
    )


def endpoint_days(facts: DataFrame) -> DataFrame:
    """The ``zip`` rows of ``trip_day_facts`` as ``endpoint_counts`` by day."""
    return facts.where(F.col("kind") == "zip").select(
        "trip_start",
        F.col("k1").alias("zip"),
        F.col("n_a").alias("n_pickup"),
        F.col("n_b").alias("n_dropoff"),
        F.col("has_a").alias("has_pickup"),
        F.col("has_b").alias("has_dropoff"),
    )


def _day_periods(kind: str) -> dict:
    """Period columns of each report as functions of the trip day (as staging derives them)."""
    d = F.col("trip_start")
    if kind == "week_label":
        return {"week_number": cal.week_label(cal.week_start_iso(d))}
    if kind == "week":
        return {"week_start": cal.week_start(d), "week_number": cal.week_label(cal.week_start_iso(d))}
    if kind == "month":
        return {"month_number": cal.month_label(d)}
    return {"date": d}


def _counts(trips: DataFrame | None, days: DataFrame | None, periods: Sequence[str], kind: str) -> DataFrame:
    """``endpoint_counts`` per period: from the shared ``trip_day_facts`` when
    given (``days``), else from one scan of the trips."""
    if days is not None:
        return rollup_endpoint_counts(endpoint_days(days), _day_periods(kind))
    t = trips.withColumnRenamed("trip_start", "date") if kind == "day" else trips
    return endpoint_counts(t, periods)


def _periods_and_totals(
    trips: DataFrame | None, periods: Sequence[str], kind: str, days: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Periods of all trips (also those without a located ZIP) and per
    (period, ZIP) totals.  From the trips, the periods come from the period
    column alone — a one-column Parquet read, de-duplicated map-side by the
    spine; from the (small) day table, from its rolled-up rows."""
    g = _counts(trips, days, periods, kind)
    totals = g.where(F.col("zip").isNotNull()).select(
        *periods, "zip", union_distinct_total().cast("long").alias("total")
    )
    if days is not None:
        return g.select(*periods), totals
    src = trips.withColumnRenamed("trip_start", "date") if kind == "day" else trips
    return src.select(*periods), totals


# --------------------------------------------------------------------------- 1
def report1_base(
    trips: DataFrame | None, covid: DataFrame, zip_polygons: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Dense (COVID week label × ZIP) totals and cases (steps 1-3 of report 1).

    Weeks come from the COVID table (S22) and are matched by label (S3,
    S25); ``week_start`` is the COVID row's, NULL where a ZIP has none that
    week (S17).  ``week_number`` is the bare label here.
    """
    spine = dense_spine(covid.select("week_number"), _zips(zip_polygons))
    totals = _counts(trips, days, ["week_number"], "week_label")
    totals = totals.where(F.col("zip").isNotNull()).select(
        "week_number", "zip", union_distinct_total().alias("total")
    )
    base = zero_filled_left_join(
        spine, totals, [("week_number", "week_number"), ("zip", "zip")], {"total_trip_count": "total"}
    )
    cov = _covid_cases(covid)
    return base.join(cov, (base["zip"] == cov["_c_zip"]) & (base["week_number"] == cov["_c_week"]), "left").select(
        F.col("_c_week_start").alias("week_start"),
        "week_number",
        "zip",
        "total_trip_count",
        F.coalesce(F.col("_c_cases"), F.lit(0)).cast("long").alias("weekly_positive_cases"),
    )


def report1_averages(base: DataFrame, by_year: bool = False) -> DataFrame:
    """Base rows plus the average of this and the next two older rows per ZIP
    (inclusive frame, S7), newest first with NULL weeks first (S6) and
    tie-breaks on the label's year and week, then the values (S17).
    ``by_year`` splits each ZIP's history by the year of the week."""
    order = [
        F.col("week_start").desc_nulls_first(),
        cal.label_part("week_number", 2).desc_nulls_first(),
        cal.label_part("week_number", 1).desc_nulls_first(),
        F.col("weekly_positive_cases").desc(),
        F.col("total_trip_count").desc(),
    ]
    averages = {"avg_trip_count": "total_trip_count", "avg_cases": "weekly_positive_cases"}
    if by_year:
        return trailing_avgs_by_range(base, averages, ["zip"], order, F.year("week_start"), 0, 2)
    w = Window.partitionBy("zip").orderBy(*order).rowsBetween(0, 2)
    return base.select("*", *[F.avg(c).over(w).alias(name) for name, c in averages.items()])


def report1_quartiles(base: DataFrame, approx: bool = False):
    """Scalar struct ``q1_/q3_`` of total trips and cases over the whole table."""
    return quartiles(base, ["total_trip_count", "weekly_positive_cases"], approx=approx)


def report1_severity(
    trips: DataFrame | None,
    covid: DataFrame,
    zip_polygons: DataFrame,
    days: DataFrame | None = None,
    approx_quartiles: bool = False,
) -> DataFrame:
    """RPTTBL01: weekly trips and cases per ZIP with actual and forecast severity.

    Severity ranks each value against the table's quartiles; the forecast
    ranks the trailing averages against the same quartiles.  ``days``
    (``trip_day_facts``) replaces the trips scan when given.
    """
    return report1_from_base(report1_base(trips, covid, zip_polygons, days), approx_quartiles)


def report1_from_base(base: DataFrame, approx_quartiles: bool = False, at_scale: bool = False) -> DataFrame:
    """Report 1 from its totals (``report1_base``).  ``at_scale``, for a written
    table: the exact quartiles are selected in a few jobs that run now, with
    bounded memory (``operators.quantiles``), and each ZIP's history is split
    by year."""
    qs = F.col("_q")
    found = exact_quartiles(base, ["total_trip_count", "weekly_positive_cases"]) if at_scale else report1_quartiles(base, approx_quartiles)
    bounds = (
        qs["q1_total_trip_count"], qs["q3_total_trip_count"],
        qs["q1_weekly_positive_cases"], qs["q3_weekly_positive_cases"],
    )
    return report1_averages(base, by_year=at_scale).withColumn("_q", found).select(
        "week_start",
        cal.prefix_label("week_number").alias("week_number"),
        "zip",
        "total_trip_count",
        "weekly_positive_cases",
        severity(F.col("total_trip_count"), F.col("weekly_positive_cases"), *bounds).alias("severity"),
        severity(F.col("avg_trip_count"), F.col("avg_cases"), *bounds).alias("forecasted_severity"),
    )


# --------------------------------------------------------------------------- 2
def airport_dim(spark, airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS) -> DataFrame:
    """The inline airport relation (``SELECT 'Midway' UNION ALL SELECT 'O''Hare'``, A12/I2)."""
    return spark.createDataFrame([(name,) for name in airports], "airport string")


def report2_airport(
    trips: DataFrame,
    covid: DataFrame,
    zip_polygons: DataFrame,
    airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS,
    days: DataFrame | None = None,
) -> DataFrame:
    """RPTTBL02: weekly trips from each airport to each ZIP, with that ZIP's cases.

    ``days`` (``trip_day_facts`` built with the same ``airports``) replaces
    the trips scan when given.
    """
    spark = covid.sparkSession
    spine = dense_spine(covid.select("week_number"), airport_dim(spark, airports), _zips(zip_polygons))
    if days is not None:
        air = days.where(F.col("kind") == "air")
        counts = air.groupBy(
            cal.week_label(cal.week_start_iso("trip_start")).alias("week_number"),
            airport_from_zip("k1", airports).alias("from_airport"),
            F.col("k2").alias("to_zip"),
        ).agg(F.sum("n_a").alias("n"))
    else:
        all_zips = [z for zs in airports.values() for z in zs]
        from_airport = trips.where(F.col("pickup_zip").isin(all_zips) & F.col("dropoff_zip").isNotNull())
        counts = from_airport.groupBy(
            "week_number",
            airport_from_zip("pickup_zip", airports).alias("from_airport"),
            F.col("dropoff_zip").alias("to_zip"),
        ).agg(F.count("trip_id").alias("n"))
    base = zero_filled_left_join(
        spine,
        counts,
        [("week_number", "week_number"), ("airport", "from_airport"), ("zip", "to_zip")],
        {"trip_count": "n"},
    )
    cov = _covid_cases(covid)
    return base.join(cov, (base["zip"] == cov["_c_zip"]) & (base["week_number"] == cov["_c_week"]), "left").select(
        F.col("_c_week_start").alias("week_start"),
        cal.prefix_label("week_number").alias("week_number"),
        F.col("airport").alias("from_airport"),
        F.col("zip").alias("to_zip_code"),
        "trip_count",
        F.coalesce(F.col("_c_cases"), F.lit(0)).cast("long").alias("weekly_positive_cases"),
    )


# --------------------------------------------------------------------------- 3
def area_week_counts(trips: DataFrame) -> DataFrame:
    """Trips from and to each community area per week.

    The reference counts each side separately and FULL OUTER joins them on
    (week start, area).  Here one aggregate counts both sides from one scan;
    rows with a NULL week start keep their side as a grouping key, because
    the outer join never matches NULL keys and leaves those sides apart.
    Area 0 and NULL are "missing" and are dropped (D7).
    """
    sides = F.inline(
        F.array(
            F.struct(F.lit(True).alias("_from"), F.col("pickup_community_area").alias("community_area")),
            F.struct(F.lit(False).alias("_from"), F.col("dropoff_community_area").alias("community_area")),
        )
    )
    ex = trips.select("week_number", "week_start", "trip_id", sides).where(F.col("community_area") != 0)
    tid = F.col("trip_id")
    return ex.groupBy(
        "week_start",
        "week_number",
        "community_area",
        F.when(F.col("week_start").isNull(), F.col("_from")).alias("_null_week_side"),
    ).agg(
        F.count(F.when(F.col("_from"), tid)).alias("trips_from"),
        F.count(F.when(~F.col("_from"), tid)).alias("trips_to"),
    ).drop("_null_week_side")


def area_week_counts_from_days(days: DataFrame) -> DataFrame:
    """``area_week_counts`` rolled up from the ``area`` rows of ``trip_day_facts``.

    Each day row becomes one row per side present (``has_*``), so a NULL
    week keeps its from and to sides apart exactly as on the trips.
    """
    a = days.where(F.col("kind") == "area")
    sides = a.select(
        cal.week_start("trip_start").alias("week_start"),
        cal.week_label(cal.week_start_iso("trip_start")).alias("week_number"),
        F.col("k1").alias("community_area"),
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("_from"), F.col("n_a").alias("_n"), F.col("has_a").alias("_has")),
                F.struct(F.lit(False).alias("_from"), F.col("n_b").alias("_n"), F.col("has_b").alias("_has")),
            )
        ),
    ).where(F.col("_has"))
    return sides.groupBy(
        "week_start",
        "week_number",
        "community_area",
        F.when(F.col("week_start").isNull(), F.col("_from")).alias("_null_week_side"),
    ).agg(
        F.coalesce(F.sum(F.when(F.col("_from"), F.col("_n"))), F.lit(0)).cast("long").alias("trips_from"),
        F.coalesce(F.sum(F.when(~F.col("_from"), F.col("_n"))), F.lit(0)).cast("long").alias("trips_to"),
    ).drop("_null_week_side")


def report3_ccvi(trips: DataFrame | None, ccvi: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """RPTTBL03: weekly trips from/to community areas whose category is HIGH.

    A HIGH area without trips still gives one row, with NULL week and counts
    (S24).  ``days`` (``trip_day_facts``) replaces the trips scan when given.
    """
    high = ccvi.where(F.upper(F.col("ccvi_category")) == "HIGH")
    weekly = area_week_counts_from_days(days) if days is not None else area_week_counts(trips)
    counts = weekly.withColumnRenamed("community_area", "_area")
    return high.join(counts, high["community_area"] == counts["_area"], "left").select(
        cal.prefix_label("week_number").alias("week_number"),
        "week_start",
        high["community_area"],
        "trips_from",
        "trips_to",
        "ccvi_category",
    )


# --------------------------------------------------------------------------- 4
def _traffic_forecast(
    trips: DataFrame | None,
    zip_polygons: DataFrame,
    periods: Sequence[str],
    kind: str,
    join_on: str,
    order,
    days: DataFrame | None = None,
) -> DataFrame:
    """Dense (period × ZIP) totals with the average of the three previous
    periods as forecast (exclusive frame, S7-S9)."""
    spine_periods, totals = _periods_and_totals(trips, periods, kind, days)
    spine = dense_spine(spine_periods, _zips(zip_polygons))
    base = zero_filled_left_join(spine, totals, [(join_on, join_on), ("zip", "zip")], {"total_trip_count": "total"})
    return base.withColumn(
        "forecasted_trip_count", forecast_int(trailing_avg("total_trip_count", ["zip"], order, 1, 3))
    )


def report4a_weekly(trips: DataFrame | None, zip_polygons: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """RPTTBL04A: weekly totals per ZIP and forecast; weeks from trips, joined
    on the week start (so the two weeks labelled ``1-1996`` stay apart)."""
    order = [F.col("week_start").desc_nulls_first()]
    b = _traffic_forecast(trips, zip_polygons, ["week_start", "week_number"], "week", "week_start", order, days)
    return b.select(
        cal.prefix_label("week_number").alias("week_number"),
        "week_start",
        "zip",
        "total_trip_count",
        "forecasted_trip_count",
    )


def report4b_monthly(trips: DataFrame | None, zip_polygons: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """RPTTBL04B: monthly totals per ZIP, ordered by the year and month parsed
    from the label."""
    order = [
        cal.label_part("month_number", 2).desc_nulls_first(),
        cal.label_part("month_number", 1).desc_nulls_first(),
    ]
    b = _traffic_forecast(trips, zip_polygons, ["month_number"], "month", "month_number", order, days)
    return b.select("month_number", "zip", "total_trip_count", "forecasted_trip_count")


def report4c_daily(trips: DataFrame | None, zip_polygons: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """RPTTBL04C: daily totals per ZIP and forecast."""
    order = [F.col("date").desc_nulls_first()]
    b = _traffic_forecast(trips, zip_polygons, ["date"], "day", "date", order, days)
    return b.select("date", "zip", "total_trip_count", "forecasted_trip_count")


# --------------------------------------------------------------------------- 5
def neediest_areas(health: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` areas by unemployment + poverty; a NULL score ranks first."""
    scored = health.select(
        "community_area", score_sum("unemployment", "below_poverty_level").alias("score")
    )
    return top_k(scored, k, [F.col("score").desc_nulls_first(), F.col("community_area").asc_nulls_last()])


def report5_waiver(health: DataFrame, permits: DataFrame, k: int = 5) -> DataFrame:
    """RPTTBL05: unpaid permit fees in the ``k`` neediest areas.

    Permits are summed per area *before* the join (the reference sums over
    the joined rows; for ``SUM`` the result is the same, and a duplicated
    area row still counts twice because the join keeps it).
    """
    top = neediest_areas(health, k)
    fees = permits.groupBy(F.col("community_area").alias("_area")).agg(F.sum("subtotal_unpaid").alias("_fees"))
    return (
        top.join(fees, top["community_area"] == fees["_area"], "left")
        .groupBy("community_area")
        .agg(F.sum("_fees").cast(schemas.MONEY_SUM).alias("total_fees_waived"))
    )


# --------------------------------------------------------------------------- 6
def new_construction(permits: DataFrame) -> DataFrame:
    return permits.where(F.trim(F.col("permit_type")) == NEW_CONSTRUCTION)


def permits_by_zip(permits: DataFrame) -> DataFrame:
    """New-construction permits per ZIP; NULL ZIP is a group of its own."""
    return new_construction(permits).groupBy("zip").agg(F.count("permit_type").alias("n_new_construction"))


def least_built_zips(permits: DataFrame) -> DataFrame:
    """ZIPs whose new-construction count equals the minimum, ties kept.

    The minimum is taken before any income filter and over the NULL-ZIP group
    too, so that group can hold the minimum and then nothing qualifies (S19).
    """
    return keep_min(permits_by_zip(permits), "n_new_construction")


def report6_loans(permits: DataFrame, health: DataFrame, income_limit: float = 30000) -> DataFrame:
    """RPTTBL06: new-construction permits in the least-built ZIPs whose
    community area's per-capita income is below ``income_limit``."""
    nc = new_construction(permits)
    poor = health.where(F.col("per_capita_income") < income_limit).select(F.col("community_area").alias("_area"))
    zips = least_built_zips(permits).select(F.col("zip").alias("_zip"))
    out = nc.join(poor, nc["community_area"] == poor["_area"]).join(zips, F.col("zip") == F.col("_zip"), "left_semi")
    return out.select("zip", F.col("permit_no").alias("permit_id"))
