"""Write PLANS.md: physical plan trees of staging and every report.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Inputs are landed/staged first and written, as in the pipeline, so each
plan starts from Parquet scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanlake import sinks  # noqa: E402
from urbanlake.operators.spatial import PolygonIndex  # noqa: E402
from urbanlake.plans import reports as rp  # noqa: E402
from urbanlake.plans import staging as st  # noqa: E402
from urbanlake.session import get_spark, shared_dir  # noqa: E402
from urbanlake.sources import driver_tables as dt  # noqa: E402
from urbanlake.sources import landing as ld  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0]
    scans = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)\n", text)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[.+?\])\n", text)))
    out = head.strip() + "\n"
    if scans:
        out += "\nReadSchema:\n" + "\n".join(f"  {s}" for s in scans) + "\n"
    pushed = [p for p in pushed if p != "[]"]
    if pushed:
        out += "PushedFilters:\n" + "\n".join(f"  {p}" for p in pushed) + "\n"
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    root = shared_dir(spark, "plans")

    def put(name, df):
        sinks.write_table(df, f"{root}/{name}")
        return sinks.scan_table(spark, f"{root}/{name}")

    land = {t: put(t, ld.LAND[t](dt.RAW[t](spark, sf))) for t in dt.RAW}
    zi, ai = PolygonIndex(land["boundaries_zip"], ["zip"]), PolygonIndex(land["comm_area"], ["area_numbe"])
    plans = {}
    plans["stage_trips (per row)"] = tree(st.stage_trips(land["taxi_trips"], zi, ai))
    stg = st.stage_trips(land["taxi_trips"], zi, ai, lookup_path=f"{root}/points")
    plans["stage_trips (with a point lookup)"] = tree(stg)
    trips = put("stg_trips", stg)
    permits_plan = st.stage_permits(land["building_permit"], zi, ai, lookup_path=f"{root}/permit-points")
    plans["stage_permits"] = tree(permits_plan)
    permits = put("stg_permits", permits_plan)
    covid = put("stg_covid", st.stage_covid(land["covid_by_zip"]))
    ccvi = put("stg_ccvi", st.stage_ccvi(land["ccvi_by_ca"]))
    health = put("stg_health", st.stage_health(land["public_health"]))
    zips = land["boundaries_zip"]
    plans["trip_day_facts"] = tree(rp.trip_day_facts(trips, dt.TEST_AIRPORTS))
    days = put("trip_day_facts", rp.trip_day_facts(trips, dt.TEST_AIRPORTS))
    plans["report1_severity"] = tree(rp.report1_severity(trips, covid, zips, days))
    plans["report2_airport"] = tree(rp.report2_airport(trips, covid, zips, dt.TEST_AIRPORTS, days))
    plans["report3_ccvi"] = tree(rp.report3_ccvi(trips, ccvi, days))
    plans["report4a_weekly"] = tree(rp.report4a_weekly(trips, zips, days))
    plans["report4b_monthly"] = tree(rp.report4b_monthly(trips, zips, days))
    plans["report4c_daily"] = tree(rp.report4c_daily(trips, zips, days))
    plans["report4c_daily (from the trips, without the day table)"] = tree(rp.report4c_daily(trips, zips))
    plans["report5_waiver"] = tree(rp.report5_waiver(health, permits))
    plans["report6_loans"] = tree(rp.report6_loans(permits, health))

    lines = [
        "# PLANS",
        "",
        f"Physical plans (`explain('formatted')`, tree part) at `{sf}`, generated by",
        "`tools/dump_plans.py`. Staging reads the landed Parquet tables; reports read",
        "the staged tables, as `run_pipeline` does (the six trip reports read the",
        "shared per-day counts, `trip_day_facts`). Plans are AQE initial plans:",
        "at run time AQE may turn shuffled joins into broadcasts and coalesce",
        "partitions. A point lookup is already written when its plan is shown.",
        "",
    ]
    for name, text in plans.items():
        lines += [f"## {name}", "", "```", text.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
