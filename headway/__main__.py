"""Command line: ``python -m headway --lake s3a://bucket``, one day or ``--from`` to ``--to``."""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from headway.feeds import registry, uncurated
from headway.plans.compact import backfill, compact_all, yesterday


def parse_day(value: str) -> dt.date:
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="headway", description="Compact raw snapshots.")
    parser.add_argument("--lake", required=True, help="root that holds raw/ and curated/")
    parser.add_argument("--day", type=parse_day, help="UTC day, YYYY-MM-DD; yesterday by default")
    parser.add_argument("--from", dest="first", type=parse_day, help="first day of a backfill")
    parser.add_argument("--to", dest="last", type=parse_day, help="its last day; yesterday by default")
    parser.add_argument("--feed", choices=sorted(registry()), help="one feed; all by default")
    parser.add_argument("--name", help="name of a backfill, which goes on where it ended")
    parser.add_argument("--remember", action="store_true", help="list days that are over only once")
    levels = ("DEBUG", "INFO", "WARNING", "ERROR")
    parser.add_argument("--log-level", choices=levels, default="INFO")
    args = parser.parse_args(argv)
    if args.day and (args.first or args.last):
        parser.error("give either --day or --from and --to")
    if (args.name or args.remember) and not args.first:
        parser.error("--name and --remember are for a backfill, with --from")
    if args.last and not args.first:
        parser.error("--to needs --from")
    if args.first and args.first > (args.last or yesterday()):
        parser.error("--from is after the last day")
    return args


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=args.log_level)
    if missing := uncurated():
        logging.warning("no feed definition for %s: captured, but never curated", ", ".join(missing))
    spark = SparkSession.builder.appName("headway").getOrCreate()
    if args.first:
        last = args.last or yesterday()
        days = [args.first + dt.timedelta(days=n) for n in range((last - args.first).days + 1)]
        results = backfill(spark, args.lake, days, args.feed, name=args.name, remember=args.remember)
    else:
        results = compact_all(spark, args.lake, args.day, args.feed)
    return 1 if any(map(failed, results.values())) else 0


def failed(result) -> bool:
    """Whether a feed's result is an error, or one of its days failed."""
    if isinstance(result, list):
        return any(outcome.status == "failed" for outcome in result)
    return isinstance(result, Exception)


if __name__ == "__main__":
    raise SystemExit(main())
