"""Command line: run the full refresh or print the sales report.

    python -m starloom refresh --source <dir|jdbc-url> --target <dir> [--as-of YYYY-MM-DD]
                               [--calendar-start D --calendar-end D] [--source-format parquet]
                               [--tpch]
    python -m starloom report --target <dir> [--limit 100]

Under ``spark-submit`` the session comes from the submitter (master, resources,
``spark.checkpoint.dir``); run directly it uses ``getOrCreate()`` defaults.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from starloom.config import ensure_checkpoint_dir
from starloom.plans.refresh import full_refresh, run_report
from starloom.sources.retail import read_retail_source
from starloom.sources.tpch import retail_from_tpch


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="rebuild all seven tables into a new run folder")
    r.add_argument("--source", required=True)
    r.add_argument("--target", required=True)
    r.add_argument("--source-format", default="parquet")
    r.add_argument("--tpch", action="store_true", help="source is the TPC-H-style test tables")
    r.add_argument("--as-of", type=_date, default=dt.date.today())
    r.add_argument("--calendar-start", type=_date)
    r.add_argument("--calendar-end", type=_date)
    p = sub.add_parser("report", help="print the first lines of the sales report")
    p.add_argument("--target", required=True)
    p.add_argument("--limit", type=int, default=100)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"starloom-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "refresh":
        src = (retail_from_tpch(spark, args.source) if args.tpch
               else read_retail_source(spark, args.source, fmt=args.source_format))
        calendar = None
        if args.calendar_start or args.calendar_end:
            if not (args.calendar_start and args.calendar_end):
                ap.error("give both --calendar-start and --calendar-end")
            calendar = (args.calendar_start, args.calendar_end)
        report = full_refresh(spark, src, args.target, as_of=args.as_of, calendar=calendar)
        report.orderBy("load_order").show(truncate=False)
    else:
        run_report(spark, args.target, n=args.limit).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
