"""All layers of all feeds, from landing files to the report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from stratalake.fixed import YEAR_MONTH
from stratalake.plans.gold import publish_gold, read_gold_monthly, read_gold_trips, to_gold
from stratalake.plans.report import report
from stratalake.plans.side_by_side import run_side_by_side
from stratalake.plans.silver import COUNTS, optimize_silver, publish_counted_silver, publish_silver, read_silver
from stratalake.sources.feeds import FEEDS, Feed
from stratalake.sources.files import ingest_files, read_bronze
from stratalake.sources.tables import changed_partitions, newest_parts, publish, register_views, versions


def _newest(spark: SparkSession, path: str) -> int:
    return max(versions(spark, path), default=0)


def _mark(spark: SparkSession, path: str, number: int) -> None:
    """Note that a layer has taken in everything up to ``number``."""
    publish(spark.createDataFrame([(number,)], "upto bigint"), path, version=number)


def run_layers(
    spark: SparkSession,
    landing: Mapping[str, str],
    lake: str,
    feeds: Mapping[str, Feed] = FEEDS,
    as_of: object | None = None,
    optimize: bool = False,
    timestamp: str = "timestamp",
    scale: int | None = None,
    side_by_side: int = 4,
    count_quality: bool = False,
) -> dict[str, DataFrame]:
    """Bring every layer below ``lake`` up to date with the landing files.

    ``landing`` maps feed names to directories. Each layer takes in only what
    is new in the one before: silver the new loads, gold the months that
    silver rewrote. A layer notes its progress after its write, and taking in
    the same input twice changes nothing, so a run that was interrupted is
    completed by the next one. ``side_by_side`` feeds go to silver at a time. A
    feed that fails stops no other: what it has in silver stays, its progress
    is not noted, and ``errors`` has its name and message. With
    ``count_quality``, ``quality`` has what was counted while silver was
    written, per feed and month. Returns the
    layers, ``errors`` and ``quality``, also registered as SQL views of the
    same names.
    """
    paths = {
        name: {layer: f"{lake}/{layer}/{name}" for layer in ("bronze", "ledger", "silver", "silver_done", "gold_done")}
        for name in landing
    }

    counted: dict[str, list[tuple]] = {}

    def to_silver_layer(name: str, directory: str) -> set[str]:
        """The months that silver rewrote and gold has not taken in."""
        feed, p = feeds[name], paths[name]
        ingest_files(spark, directory, p["bronze"], p["ledger"], feed.schema)
        done, newest = _newest(spark, p["silver_done"]), _newest(spark, p["ledger"])
        if newest > done:
            bronze = read_bronze(spark, p["bronze"], p["ledger"], feed.schema, after=done)
            if count_quality:
                counted[name] = publish_counted_silver(bronze, feed, p["silver"], as_of)
            else:
                publish_silver(bronze, feed, p["silver"], as_of)
            _mark(spark, p["silver_done"], newest)
        done = _newest(spark, p["gold_done"])
        return set(changed_partitions(spark, p["silver"], done))

    found, failed = run_side_by_side(spark, {n: partial(to_silver_layer, n, d) for n, d in landing.items()}, side_by_side)
    months = set().union(*found.values())
    errors = {name: f"{type(failed[name]).__name__}: {failed[name]}" for name in landing if name in failed}
    trips_path, monthly_path = f"{lake}/gold/trips", f"{lake}/gold/monthly"
    if months:
        touched = sorted(months)
        silver = {name: read_silver(spark, feeds[name], paths[name]["silver"], touched) for name in landing}
        publish_gold(spark, to_gold(silver), trips_path, monthly_path, touched, scale, optimize, by_month=True)
        for name in landing:
            if name in errors:
                continue
            newest = newest_parts(spark, paths[name]["silver"])
            if optimize:
                newest = optimize_silver(spark, feeds[name], paths[name]["silver"], touched)
            if newest:
                _mark(spark, paths[name]["gold_done"], newest)
    tables = {f"silver_{name}": read_silver(spark, feeds[name], paths[name]["silver"]) for name in landing}
    tables["gold_trips"] = read_gold_trips(spark, trips_path, timestamp)
    tables["gold_monthly"] = read_gold_monthly(spark, monthly_path, timestamp)
    if "silver_yellow" in tables:
        tables["report"] = report(tables["gold_monthly"], tables["silver_yellow"], scale=scale)
    tables["errors"] = spark.createDataFrame(list(errors.items()), "feed string, error string")
    tables["quality"] = spark.createDataFrame([(name, *row) for name, own in sorted(counted.items()) for row in own], f"feed string, {COUNTS}")
    register_views(spark, tables)
    return tables
