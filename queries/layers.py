"""All layers end to end, on files written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.feeds import AS_OF, SILVER_SQL, gold_sql, monthly_sql, ntz_feed, raw_feed
from queries.registry import query
from stratalake.operators.schema import enforce_schema
from stratalake.plans.layers import run_layers
from stratalake.plans.silver import read_silver
from stratalake.sources.feeds import FEEDS
from stratalake.sources.storage import compressed, shared_dir
from stratalake.streaming.upsert import silver_stream


def _run(spark: SparkSession, sf_dir: str, names=tuple(FEEDS), bad: str | None = None) -> dict[str, DataFrame]:
    root = shared_dir(spark, "layers")
    landing = {name: f"{root}/landing/{name}" for name in names}
    for name, path in landing.items():
        raw = raw_feed(spark, sf_dir, name)
        compressed(raw.select(raw.columns[0]) if name == bad else raw).parquet(path)
    feeds = {name: ntz_feed(name) for name in FEEDS}
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return run_layers(spark, landing, f"{root}/lake", feeds, as_of, timestamp="timestamp_ntz", scale=2)


@query("layers_end_to_end", monthly_sql(gold_sql(SILVER_SQL)))
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)["gold_monthly"]


GOOD = [name for name in FEEDS if name != "green"]


@query("layers_with_bad_feed", monthly_sql(gold_sql({name: SILVER_SQL[name] for name in GOOD})))
def layers_with_bad_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The green feed's files lack its columns; all others reach gold."""
    return _run(spark, sf_dir, bad="green")["gold_monthly"]


@query("layers_silver_yellow", SILVER_SQL["yellow"])
def layers_silver_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ["yellow"])["silver_yellow"]


@query("stream_silver_fhv", SILVER_SQL["fhv"])
def stream_silver_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to silver as a stream that finds the same rows twice."""
    root = shared_dir(spark, "stream-silver")
    bronze, silver, feed = f"{root}/bronze", f"{root}/silver", ntz_feed("fhv")
    raw = enforce_schema(raw_feed(spark, sf_dir, "fhv"), feed.schema)
    for _ in range(2):
        raw.write.mode("append").parquet(bronze)
        stream = spark.readStream.schema(feed.schema).parquet(bronze)
        as_of = F.lit(AS_OF).cast("timestamp_ntz")
        silver_stream(stream, feed, silver, f"{root}/checkpoint", as_of).awaitTermination()
    return read_silver(spark, feed, silver).withColumn("data_ingestao", F.col("data_ingestao").cast("timestamp_ntz"))
