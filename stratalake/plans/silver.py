"""Bronze to silver: one cleaned, de-duplicated table per feed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from stratalake.fixed import FILLERS, INGESTED_AT, YEAR_MONTH
from stratalake.functions.casting import safe_cast
from stratalake.functions.names import column, fresh_name, lookup
from stratalake.operators.clean import standard_clean, upper_strings
from stratalake.operators.dates import with_ingestion_time, with_year_month
from stratalake.operators.dedup import keep_one, keep_one_ranged
from stratalake.operators.schema import enforce_schema, lower_names
from stratalake.sources.feeds import Feed
from stratalake.sources.layout import clustered
from stratalake.sources.storage import shared_dir
from stratalake.sources.tables import newest_parts, publish_partitions, read_partitions, upsert_partitions


def silver_schema(feed: Feed) -> T.StructType:
    fields = [T.StructField(f.name.lower(), f.dataType) for f in feed.schema.fields]
    return T.StructType(fields).add(INGESTED_AT, T.TimestampType()).add(YEAR_MONTH, T.StringType())


def cleaned(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Declared types, lower-case names, upper-case texts, fillers for nulls.

    Texts are upper-cased before they are filled, so the filler keeps its case.
    """
    return standard_clean(upper_strings(lower_names(enforce_schema(bronze, feed.schema))))


def to_silver(bronze: DataFrame, feed: Feed, as_of: object | None = None) -> DataFrame:
    """One row per key of the feed, with ingestion time and month.

    The audit columns are added after the de-duplication: they are the same
    for all rows of a key and would only widen its shuffle.
    """
    unique = keep_one(cleaned(bronze, feed), feed.keys, [feed.pickup])
    return with_year_month(with_ingestion_time(unique, as_of=as_of), feed.pickup)


def to_silver_by_month(bronze: DataFrame, feed: Feed, as_of: object | None = None) -> DataFrame:
    """As ``to_silver``, with the rows left in ranges of their time, so that they can be written by month as they are."""
    unique = keep_one_ranged(cleaned(bronze, feed), feed.keys, [feed.pickup], feed.pickup)
    return with_year_month(with_ingestion_time(unique, as_of=as_of), feed.pickup)


def publish_silver(bronze: DataFrame, feed: Feed, path: str, as_of: object | None = None) -> int:
    """Upsert the cleaned rows into the silver table, month by month.

    The month comes from a key column, so a row never changes its partition.
    """
    first = not newest_parts(bronze.sparkSession, path)
    silver = (to_silver_by_month if first else to_silver)(bronze, feed, as_of)
    months = with_year_month(cleaned(bronze, feed), feed.pickup)
    return upsert_partitions(
        silver, path, YEAR_MONTH, feed.keys, source_unique=True, touched_by=months, derived_from=feed.pickup, by_partition=first
    )


# What is counted while silver is written.
COUNTS = "ano_mes string, column_name string, check string, n bigint"
MONTHS = 4096


def publish_counted_silver(bronze: DataFrame, feed: Feed, path: str, as_of: object | None = None) -> list[tuple]:
    """As ``publish_silver``; returns rows ``(ano_mes, column_name, check, n)``, those with a count.

    Per column there are ``cast_failures`` and ``fillers`` (nulls that were
    filled); per month ``rows`` (read), ``failed_rows`` and ``filled_rows`` (with
    one of the former) and ``collapsed`` (gone as repeats of a key). They are
    observed while the cleaned rows are written to the shared folder, from
    where the upsert takes them, so nothing is scanned for them; counts per
    month are histograms with a bin for every month, exact up to MONTHS months. A stage
    that is run again for a lost executor may be counted twice: counts are for
    people, not for decisions.
    """
    spark = bronze.sparkSession
    raw = {f.name: lookup(bronze.columns, f.name) for f in feed.schema.fields}
    typed = {n: safe_cast(column(c), bronze.schema[c].dataType, feed.schema[n].dataType) for n, c in raw.items() if c is not None}
    pickup = next(n for n in feed.schema.names if n.lower() == feed.pickup)
    filler = F.lit(FILLERS["timestamp"]).cast(feed.schema[pickup].dataType)
    moment = F.coalesce(typed[pickup], filler) if pickup in typed else filler
    flags: dict[tuple[str, str], Column] = {}
    for n, c in typed.items():
        if bronze.schema[raw[n]].dataType != feed.schema[n].dataType:
            flags[n.lower(), "cast_failures"] = column(raw[n]).isNotNull() & c.isNull()
        if not isinstance(feed.schema[n].dataType, T.LongType):
            flags[n.lower(), "fillers"] = c.isNull()
    of, failed, filled = (fresh_name(bronze, n) for n in ("month", "failed", "filled"))
    any_of = lambda check: reduce(Column.__or__, [f for (_, own), f in flags.items() if own == check], F.lit(False))
    marked = bronze.withColumns({of: F.year(moment) * 100 + F.month(moment), failed: any_of("cast_failures"), filled: any_of("fillers")})
    by_month = lambda test, month: F.histogram_numeric(F.when(test, month), F.lit(MONTHS))
    seen, kept = Observation(), Observation()
    metrics = [F.count_if(f).alias(f"f{i}") for i, f in enumerate(flags.values())]
    tests = {"rows": F.lit(True), "failed_rows": F.col(failed), "filled_rows": F.col(filled)}
    metrics += [by_month(test, F.col(of)).alias(check) for check, test in tests.items()]
    silver = to_silver(marked.observe(seen, *metrics), feed, as_of)
    silver = silver.observe(kept, by_month(F.lit(True), F.col(YEAR_MONTH).cast("int")).alias("rows"))
    staged = shared_dir(spark, "silver")
    silver.write.parquet(staged)
    source = spark.read.schema(silver.schema).parquet(staged)
    upsert_partitions(source, path, YEAR_MONTH, feed.keys, source_unique=True, touched_by=source.select(YEAR_MONTH), derived_from=feed.pickup)
    counts = seen.get

    def bins(found: list | None) -> Counter:
        out: Counter = Counter()
        for b in found or []:  # tasks' bins of one month stay apart when they are merged
            out[f"{int(b.x):06d}"] += int(b.y)
        return out

    read, left = bins(counts["rows"]), bins(kept.get["rows"])
    rows = [(None, name, check, counts[f"f{i}"]) for i, (name, check) in enumerate(flags)]
    rows += [(m, None, check, n) for check in tests for m, n in sorted(bins(counts[check]).items())]
    rows += [(m, None, "collapsed", n - left.get(m, 0)) for m, n in sorted(read.items())]
    return [r for r in rows if r[-1]]


def read_silver(spark: SparkSession, feed: Feed, path: str, months: Sequence[str] | None = None) -> DataFrame:
    return read_partitions(spark, path, YEAR_MONTH, silver_schema(feed), months)


def optimize_silver(spark: SparkSession, feed: Feed, path: str, months: Sequence[str] | None = None) -> int:
    """Rewrite months (all by default) clustered by the columns the feed is
    filtered on."""
    rows = clustered(read_silver(spark, feed, path, months), feed.cluster_by, lead=[YEAR_MONTH])
    return publish_partitions(rows, path, YEAR_MONTH)
