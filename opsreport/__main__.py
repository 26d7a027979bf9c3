"""``python -m opsreport``: reports for a range of dates, snapshots and consolidation."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Mapping
from datetime import date, datetime, time, timedelta

from pyspark.sql import SparkSession

from opsreport.operators.timeaxis import DEFAULT_LOOK_BACK, DateRange, resolve_range
from opsreport.plans.jobs import Store, run, set_aside
from opsreport.sources.tables import read_inputs, read_raws

# Repairs look back a month before the first month, shifted by some hours.
MARGIN = timedelta(days=35)


def setting(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not found or not key:
        raise argparse.ArgumentTypeError(f"write it as name=value: {text!r}")
    return key, value


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="opsreport", description="Daily plant report")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--inputs", help="where the input tables lie as files")
    source.add_argument("--jdbc", metavar="URL", help="database that holds the input tables")
    parser.add_argument("--format", default="parquet", help="how those files are written")
    parser.add_argument(
        "--jdbc-option",
        type=setting,
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="an option of the JDBC source, such as driver=... (may be repeated)",
    )
    parser.add_argument(
        "--jdbc-partitions", type=int, default=16, help="parallel reads of a time-stamped table"
    )
    parser.add_argument("--store", required=True, help="where snapshots and results go")
    parser.add_argument("--start-date", help="begin of the range; needs an end")
    parser.add_argument("--end-date", help="end of the range, itself included")
    parser.add_argument("--days", type=int, help="range from so many days ago until today")
    parser.add_argument(
        "--look-back", type=int, default=DEFAULT_LOOK_BACK, help="as --days, if no range is given"
    )
    parser.add_argument("--force", action="store_true", help="write stored dates anew")
    parser.add_argument("--plan-type", type=int, help="which plan counts as the budget")
    parser.add_argument(
        "--incremental", action="store_true", help="consolidate from a state, reading new snapshots"
    )
    parser.add_argument(
        "--quarantine", action="store_true", help="set rows aside that do not fit their table"
    )
    parser.add_argument("--lenient", action="store_true", help="go on without a report column")
    args = parser.parse_args(argv)
    if args.days is not None and (args.start_date or args.end_date):
        parser.error("--days stands instead of --start-date and --end-date")
    return args


def time_bounds(span: DateRange) -> tuple[datetime, datetime]:
    """The stretch of time that a run of these dates reads, for splitting scans."""
    first = datetime.combine(span.first.replace(day=1), time()) - MARGIN
    return first, datetime.combine(span.last.replace(day=1), time()) + MARGIN


def connection(args: argparse.Namespace) -> Mapping[str, str]:
    return {"url": args.jdbc, **dict(args.jdbc_option)}


def main(argv: list[str] | None = None) -> int:
    args = arguments(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("opsreport").getOrCreate()
    today = date.today()
    span = resolve_range(today, args.start_date, args.end_date, args.days, args.look_back)
    if args.jdbc:
        source = {
            "fmt": "jdbc",
            "connection": connection(args),
            "bounds": time_bounds(span),
            "partitions": args.jdbc_partitions,
        }
    else:
        source = {"location": args.inputs, "fmt": args.format}
    if args.quarantine:
        inputs, _ = set_aside(read_raws(spark, **source), Store(args.store))
    else:
        inputs = read_inputs(spark, **source)
    return run(
        spark,
        inputs,
        args.store,
        start=args.start_date,
        end=args.end_date,
        days=args.days,
        force=args.force,
        plan_type=args.plan_type,
        strict=not args.lenient,
        look_back=args.look_back,
        today=today,
        incremental=args.incremental,
    )


if __name__ == "__main__":
    raise SystemExit(main())
