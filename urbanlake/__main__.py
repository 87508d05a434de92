"""Command line: run the whole zone pipeline on source CSV files.

    spark-submit --py-files urbanlake.zip -m urbanlake \\
        --src-dir s3://bucket/raw --out s3://bucket/warehouse [--mode rerun] [--csv-out]

or ``python -m urbanlake …`` for a local session.  Each landing table is read
from ``<src-dir>/<table>`` (a CSV file or a folder of CSV files) unless a
per-table option (``--taxi-trips PATH`` …) names another path.  ``--mode``
is ``overwrite`` (default), ``ignore``, ``append``, ``replace`` (stage the
landed months in place of what is there) or ``rerun`` (what re-running the
reference's scripts does: landing and staging append, existing reports are
kept).  Stops with a non-zero exit status at the first
failure; prints the written tables as JSON.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .plans.pipeline import LANDING_TABLES, REFERENCE_RERUN_MODES, run_pipeline
from .schemas import REFERENCE_AIRPORTS


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="urbanlake", description=__doc__.splitlines()[0])
    p.add_argument("--src-dir", help="folder holding one CSV file or folder per landing table")
    p.add_argument("--out", required=True, help="warehouse root on shared storage")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "ignore", "append", "replace", "rerun"])
    p.add_argument("--csv-out", action="store_true", help="also export every report as CSV with headers")
    p.add_argument("--json-out", action="store_true", help="also export every report as JSON lines")
    p.add_argument("--jdbc-url", default=None, help="also load every report into this database (password: URBANLAKE_JDBC_PASSWORD)")
    p.add_argument("--jdbc-user", default=None)
    p.add_argument("--jdbc-swap", action="store_true", help="load side tables, compare counts and swap")
    p.add_argument("--batch", default=None, help="name of this delivery: appended exactly once, a killed run may be repeated")
    p.add_argument("--refresh", action="store_true", help="recompute only the parts of the trip reports that the landed days reach")
    p.add_argument("--raw-points", action="store_true", help="locations do not repeat: no distinct-point lookup")
    p.add_argument(
        "--single-line", action="append", default=[], choices=list(LANDING_TABLES), metavar="TABLE",
        help="this table's CSV holds no quoted newline: do not look for them (repeatable)",
    )
    p.add_argument("--airports", default=None, help='JSON {"name": [zip, ...]} (default: the reference\'s)')
    for table in LANDING_TABLES:
        p.add_argument(f"--{table.replace('_', '-')}", dest=table, default=None, help=f"path of the {table} CSV")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    args = parse_args(argv)
    sources = {}
    for table in LANDING_TABLES:
        path = getattr(args, table) or (f"{args.src_dir.rstrip('/')}/{table}" if args.src_dir else None)
        if not path:
            raise SystemExit(f"no source for {table}: give --src-dir or --{table.replace('_', '-')}")
        sources[table] = path
    mode = REFERENCE_RERUN_MODES if args.mode == "rerun" else args.mode
    if args.refresh:
        mode = {**(mode if isinstance(mode, dict) else dict.fromkeys(("landing", "staging", "export"), mode)), "summarised": "refresh"}
    airports = json.loads(args.airports) if args.airports else REFERENCE_AIRPORTS
    spark = spark or SparkSession.builder.appName("urbanlake").getOrCreate()
    jdbc = None
    if args.jdbc_url:
        login = {"user": args.jdbc_user, "password": os.environ.get("URBANLAKE_JDBC_PASSWORD")}
        jdbc = {"url": args.jdbc_url, "properties": {k: v for k, v in login.items() if v}}
        jdbc |= {"mode": "swap"} if args.jdbc_swap else {}
    return run_pipeline(
        spark, sources, args.out, mode=mode, airports=airports, csv_out=args.csv_out, json_out=args.json_out, jdbc=jdbc,
        dedupe_points=not args.raw_points, batch=args.batch, multi_line={table: False for table in args.single_line},
    )


if __name__ == "__main__":
    try:
        print(json.dumps(main(), indent=1))
    except SystemExit:
        raise
    except Exception as exc:  # noqa: BLE001 - report and fail like the reference's runner
        print(f"urbanlake: {type(exc).__name__}: {exc}", file=sys.stderr)
        sys.exit(1)
