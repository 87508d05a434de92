"""Incremental refresh of the trip reports.

A report table is kept in parts (a year, for the daily report a month), and a
change of some days reaches only some of its rows:

* its periods that hold a touched day;
* in reports 4A-4C also the three next periods of each of those, because their
  forecast looks back on them (S7); the rows are windows over what the report
  holds, so periods that appear or vanish count as touched;
* in report 1 the weeks' totals likewise; the quartiles are of the whole table,
  so its severities are made anew from the kept totals, which is the size of
  the report and reads no day counts.

``refresh`` recomputes the parts that hold such rows, from the day counts of
their periods and of the three periods before them (the scans of the day counts
name their months, so other months are not read), and replaces just these parts
(dynamic partition overwrite).  The result equals a full rebuild.  The NULL
period is a part of its own that is always recomputed.

The driver handles calendar periods only: one per day that has trips.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import calendar as cal
from ..schemas import REFERENCE_AIRPORTS
from ..sinks import files
from . import reports

Day = dt.date | None
#: Column that names the part of a row.
PART = "part"


def sunday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.isoweekday() % 7)


def label_of(day: dt.date) -> tuple[int, int]:
    """(calendar year, ISO week) of the Monday after the week's Sunday."""
    monday = sunday(day) + dt.timedelta(days=1)
    return monday.year, monday.isocalendar()[1]


def month_of(day: Day) -> str | None:
    return None if day is None else f"{day.month}-{day.year}"


@dataclass(frozen=True)
class Shape:
    """How a report's rows follow from days: ``period`` and ``part`` of a day,
    the part of a row as a Column, and how many later periods look back."""

    period: Callable[[dt.date], object]
    part: Callable[[dt.date], int]
    part_column: Callable[[], Column]
    looking_back: int


def _year(column: str) -> Callable[[], Column]:
    return lambda: F.year(column)


def _label_year() -> Column:
    return cal.label_part(F.regexp_replace("week_number", "^WEEK-", ""), 2).cast("int")


SHAPES = {
    "rpttbl01": Shape(label_of, lambda d: label_of(d)[0], _label_year, 0),
    "rpttbl02": Shape(label_of, lambda d: label_of(d)[0], _label_year, 0),
    "rpttbl03": Shape(sunday, lambda d: sunday(d).year, _year("week_start"), 0),
    "rpttbl04a": Shape(sunday, lambda d: sunday(d).year, _year("week_start"), 3),
    "rpttbl04b": Shape(lambda d: (d.year, d.month), lambda d: d.year, lambda: cal.label_part("month_number", 2).cast("int"), 3),
    "rpttbl04c": Shape(lambda d: d, lambda d: d.year * 100 + d.month, lambda: F.year("date") * 100 + F.month("date"), 3),
}
#: What report 1 keeps beside its rows.
TOTALS = "_rpttbl01_totals"


def affected_parts(shape: Shape, days: Iterable[Day], touched: Iterable[Day]) -> tuple[set[int], set[dt.date]]:
    """(parts to recompute, days whose counts that takes); ``days`` are all days
    there are now, ``touched`` those whose counts changed or that are gone."""
    here = sorted(d for d in days if d is not None)
    changed = {shape.period(d) for d in touched if d is not None}
    gone = [d for d in touched if d is not None]
    first: dict = {}  # a day of each period, gone ones included
    for d in sorted({*here, *gone}):
        first.setdefault(shape.period(d), d)
    periods = sorted(first, key=first.__getitem__)
    at = {p: i for i, p in enumerate(periods)}
    reach = {periods[i] for p in changed for i in range(at[p], min(at[p] + shape.looking_back + 1, len(periods)))}
    # periods that are gone do not count as one of the three
    there = sorted({shape.period(d) for d in here}, key=lambda p: first[p])
    for p in changed:
        later = [q for q in there if first[q] > first[p]][: shape.looking_back]
        reach |= set(later)
    parts = {shape.part(first[p]) for p in reach}
    need = {p for p in there if shape.part(first[p]) in parts}
    for p in [q for q in there if q in need]:
        i = there.index(p)
        need |= set(there[max(0, i - shape.looking_back) : i])
    if shape.looking_back:  # the NULL period looks back on the newest ones
        need |= set(there[-shape.looking_back :])
    return parts, {d for d in here if shape.period(d) in need}


def in_days(facts: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """The day counts of these days and of no day; only their months are read."""
    days = sorted(days)
    months = sorted({month_of(d) for d in days})
    month, day = F.col("month_number"), F.col("trip_start")
    return facts.where((month.isNull() | month.isin(months)) & (day.isNull() | day.isin(days)))


def rebuild(name: str, facts: DataFrame, covid: DataFrame, ccvi: DataFrame, zips: DataFrame, airports: Mapping[str, Sequence[int]]) -> DataFrame:
    """The rows of a report (of report 1 its totals) from day counts."""
    return {
        "rpttbl01": lambda: reports.report1_base(None, covid, zips, facts),
        "rpttbl02": lambda: reports.report2_airport(None, covid, zips, airports, facts),
        "rpttbl03": lambda: reports.report3_ccvi(None, ccvi, facts),
        "rpttbl04a": lambda: reports.report4a_weekly(None, zips, facts),
        "rpttbl04b": lambda: reports.report4b_monthly(None, zips, facts),
        "rpttbl04c": lambda: reports.report4c_daily(None, zips, facts),
    }[name]()


def _covid_days(covid: DataFrame) -> list[Day]:
    return [r[0] for r in covid.select(cal.iso_from_week_start("week_start")).distinct().collect()]


def _replace(rows: DataFrame, path: str, wanted: set[int] | None) -> None:
    """Write the parts; of those wanted, the ones without rows go."""
    spark, hidden = rows.sparkSession, f"{path}/_next"
    if wanted is None:
        sinks.write_table(rows, path, mode="overwrite", partition_by=[PART])
        return
    sinks.write_table(rows, hidden, mode="overwrite", partition_by=[PART])
    left = set(files.subfolders(spark, hidden))
    if left:
        sinks.write_table(sinks.scan_table(spark, hidden, schema=rows.schema), path, mode="replace", partition_by=[PART])
    for part in [*wanted, "__HIVE_DEFAULT_PARTITION__"]:
        if f"{PART}={part}" not in left:
            files.delete(spark, f"{path}/{PART}={part}")
    files.delete(spark, hidden)


def refresh(
    spark: SparkSession,
    root: str,
    facts: DataFrame,
    covid: DataFrame,
    ccvi: DataFrame,
    zips: DataFrame,
    touched: Iterable[Day] | None,
    airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS,
    names: Sequence[str] = tuple(SHAPES),
) -> dict[str, DataFrame]:
    """Bring the trip reports under ``root`` up to date with the day counts
    ``facts`` (``reports.trip_day_facts`` with their ``month_number``) and
    return them.

    ``touched``: the days whose counts changed since the last refresh, days
    that are gone included (in reports 1 and 2 also a day of each changed
    week of COVID rows); None, or a table that is not there yet, is a full build.
    ZIP, area and vulnerability tables must be those of the last refresh.
    """
    touched = None if touched is None else set(touched)
    days = [r[0] for r in facts.select("trip_start").distinct().collect()]
    out = {}
    for name in names:
        shape, path = SHAPES[name], f"{root}/{TOTALS if name == 'rpttbl01' else name}"
        part = shape.part_column().alias(PART)
        full = touched is None or not files.exists(spark, f"{path}/_SUCCESS")
        if full:
            wanted, rows = None, rebuild(name, facts, covid, ccvi, zips, airports)
        else:
            weekly = name in ("rpttbl01", "rpttbl02")  # their periods are those of the COVID rows
            wanted, needed = affected_parts(shape, [*days, *(_covid_days(covid) if weekly else [])], touched)
            some = in_days(facts, needed)
            cases = covid
            if weekly:
                cases = covid.where(_label_year().isin(sorted(wanted)) | F.col("week_number").isNull())
            rows = rebuild(name, some, cases, ccvi, zips, airports)
            keep = part.isNull() if not wanted else part.isNull() | part.isin(sorted(wanted))
            if name == "rpttbl03":  # an area has a row without a week only if it has no trip in any part
                seen = facts.where(F.col("kind") == "area").select(F.col("k1").alias("community_area"), F.lit(True).alias("_seen")).distinct()
                rows = rows.join(seen, "community_area", "left").where(F.col("trips_from").isNotNull() | F.col("_seen").isNull()).select(*rows.columns)
            rows = rows.where(keep)
        _replace(rows.select("*", part), path, wanted)
        table = sinks.scan_table(spark, path, schema=rows.select("*", part).schema).drop(PART)
        if name == "rpttbl01":
            done = f"{root}/{name}"
            sinks.write_table(reports.report1_from_base(table, at_scale=True), done)
            table = sinks.scan_table(spark, done)
        out[name] = table
    return out
