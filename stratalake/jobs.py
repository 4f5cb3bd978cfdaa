"""Jobs for ``spark-submit``: all layers, the report, inspection of landing data.

    spark-submit --py-files stratalake.zip stratalake/jobs.py layers --lake s3a://lake yellow=s3a://lake/landing/yellow
    spark-submit --py-files stratalake.zip stratalake/jobs.py report --lake s3a://lake --out s3a://lake/report
    spark-submit --py-files stratalake.zip stratalake/jobs.py inspect --out s3a://lake/inspection yellow=s3a://lake/landing/yellow

A job ends with status 1 if a feed failed; the other feeds are done. Running a job again changes nothing that is done.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from stratalake.plans.gold import read_gold_monthly
from stratalake.plans.inspect import inspect
from stratalake.plans.layers import run_layers
from stratalake.plans.report import report_lines, write_report
from stratalake.plans.silver import read_silver
from stratalake.sources.feeds import FEEDS
from stratalake.sources.files import read_parquet


def feed_directory(text: str) -> tuple[str, str]:
    name, found, directory = text.partition("=")
    if not found or not directory or name not in FEEDS:
        raise argparse.ArgumentTypeError(f"{text!r} is not one of {', '.join(FEEDS)}, '=', and a directory")
    return name, directory


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stratalake")
    jobs = parser.add_subparsers(dest="job", required=True)
    layers = jobs.add_parser("layers", help="bring all layers up to date with the landing files")
    layers.add_argument("--optimize", action="store_true", help="compact silver and cluster gold after the load")
    layers.add_argument("--count-quality", action="store_true", help="count fillers and failed casts while silver is written")
    layers.add_argument("--scale", type=int, help="sum amounts exactly, in units of this many decimals")
    layers.add_argument("--side-by-side", type=int, default=4, help="feeds that go to silver at a time")
    answers = jobs.add_parser("report", help="write the text report from published tables")
    answers.add_argument("--month", type=int, default=5, choices=range(1, 13), metavar="1..12")
    answers.add_argument("--year", type=int)
    look = jobs.add_parser("inspect", help="schema, first row and profile of landing data, as JSON")
    for job in (layers, answers):
        job.add_argument("--lake", required=True)
    for job in (answers, look):
        job.add_argument("--out", required=True)
    for job in (layers, look):
        job.add_argument("feeds", nargs="+", type=feed_directory, metavar="feed=directory")
    return parser.parse_args(argv)


def layers_job(spark: SparkSession, given: argparse.Namespace) -> dict[str, str]:
    tables = run_layers(
        spark, dict(given.feeds), given.lake, optimize=given.optimize, scale=given.scale,
        side_by_side=given.side_by_side, count_quality=given.count_quality,
    )
    if given.count_quality:
        tables["quality"].write.mode("append").parquet(f"{given.lake}/quality")
    return {row.feed: row.error for row in tables["errors"].collect()}  # one row per feed at most


def report_job(spark: SparkSession, given: argparse.Namespace) -> dict[str, str]:
    monthly = read_gold_monthly(spark, f"{given.lake}/gold/monthly")
    yellow = read_silver(spark, FEEDS["yellow"], f"{given.lake}/silver/yellow")
    write_report(report_lines(monthly, yellow, given.month, given.year), given.out)
    return {}


def inspect_job(spark: SparkSession, given: argparse.Namespace) -> dict[str, str]:
    failed = {}
    for name, directory in given.feeds:
        try:
            for part, df in inspect(read_parquet(spark, directory), FEEDS[name].schema).items():
                df.write.mode("overwrite").json(f"{given.out}/{name}/{part}")
        except Exception as error:  # whatever is wrong with one feed, the others are inspected
            failed[name] = f"{type(error).__name__}: {error}"
    return failed


JOBS = {"layers": layers_job, "report": report_job, "inspect": inspect_job}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = arguments(argv)
    spark = spark or SparkSession.builder.appName(f"stratalake {given.job}").getOrCreate()
    failed = JOBS[given.job](spark, given)
    for name, error in failed.items():
        print(f"{name}: {error}", file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
