"""Queries that write and read back: layout, ingest and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.feeds import AS_OF, HOURS_IN_MAY, RAW_SQL, TOTAL_SQL, gold_sql, gold_trips, monthly_sql, ntz_feed, raw_feed
from queries.registry import query, table
from stratalake.fixed import YEAR_MONTH
from stratalake.operators.dates import with_year_month
from stratalake.plans.gold import publish_gold, read_gold_monthly
from stratalake.plans.report import report
from stratalake.plans.silver import to_silver_by_month
from stratalake.sources.files import append_parquet, ingest_files, read_bronze, read_parquet
from stratalake.sources.layout import cluster_write, optimize_for_reads, partitioned_write, with_zorder_key
from stratalake.sources.storage import shared_dir
from stratalake.sources.tables import compact_partitions, publish, publish_partitions, read_partitions, read_table, register_views, upsert_partitions
from stratalake.streaming.ingest import append_stream, ingest_stream, read_stream_bronze
from stratalake.streaming.upsert import upsert_stream

KEY_BOUNDS = [1000.0 * i for i in range(1, 32)]
PRICE_BOUNDS = [15000.0 * i for i in range(1, 32)]


def _zorder_sql() -> str:
    def bucket(c: str, bounds: list[float]) -> str:
        return f"len(list_filter({bounds}, lambda b: b <= {c}))"

    bits = " + ".join(f"((x >> {i}) & 1) * {4**i} + ((y >> {i}) & 1) * {2 * 4**i}" for i in range(5))
    return f"""SELECT o_orderkey, CAST({bits} AS BIGINT) AS z FROM
        (SELECT o_orderkey, {bucket("o_orderkey", KEY_BOUNDS)} AS x, {bucket("o_totalprice", PRICE_BOUNDS)} AS y
         FROM orders)"""


@query("zorder_key", _zorder_sql())
def zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    bounds = {"o_orderkey": KEY_BOUNDS, "o_totalprice": PRICE_BOUNDS}
    return with_zorder_key(orders, "z", ["o_orderkey", "o_totalprice"], bounds, 5).select("o_orderkey", "z")


@query("clustered_roundtrip", "SELECT * FROM lineitem")
def clustered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "clustered")
    cluster_write(table(spark, sf_dir, "lineitem"), path, ["l_partkey", "l_shipdate", "l_returnflag"])
    return read_table(spark, path)


@query("clustered_by_text", "SELECT * FROM customer")
def clustered_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered by names that all begin alike, and by balance."""
    path = shared_dir(spark, "by-text")
    cluster_write(table(spark, sf_dir, "customer"), path, ["c_name", "c_acctbal"], files=16)
    return read_table(spark, path)


@query("gold_clustered", monthly_sql(gold_sql(RAW_SQL)))
def gold_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gold tables published clustered; the monthly one is read back."""
    root = shared_dir(spark, "gold-clustered")
    publish_gold(spark, gold_trips(spark, sf_dir), f"{root}/trips", f"{root}/monthly", scale=2, optimize=True)
    return read_gold_monthly(spark, f"{root}/monthly", "timestamp_ntz")


@query(
    "report_from_published",
    f"""SELECT 'media_total_amount' AS metric, 'yellow' AS key, media_total_amount AS value FROM ({TOTAL_SQL})
        UNION ALL SELECT 'media_passageiros', CAST(hora AS VARCHAR), media_passageiros FROM ({HOURS_IN_MAY})""",
)
def report_from_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from published gold and silver: the month selects the partitions of silver that are read."""
    root, feed = shared_dir(spark, "report"), ntz_feed("yellow")
    publish_gold(spark, gold_trips(spark, sf_dir), f"{root}/trips", f"{root}/monthly", scale=2)
    silver = to_silver_by_month(raw_feed(spark, sf_dir, "yellow"), feed, F.lit(AS_OF).cast("timestamp_ntz"))
    publish_partitions(silver, f"{root}/silver", YEAR_MONTH)
    yellow = read_partitions(spark, f"{root}/silver", YEAR_MONTH, silver.schema)
    return report(read_gold_monthly(spark, f"{root}/monthly", "timestamp_ntz"), yellow.select(feed.pickup, "passenger_count", YEAR_MONTH), scale=2)


@query("compacted_partitions", "SELECT *, strftime(ts, '%Y%m%d') AS day FROM events")
def compacted_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written as many small files, which are then rewritten together."""
    path = shared_dir(spark, "compacted")
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    publish_partitions(events.repartition(6), path, "day")
    compact_partitions(spark, path, "day", events.schema, target=1 << 27)
    return read_partitions(spark, path, "day", events.schema)


@query("partitioned_roundtrip", "SELECT *, strftime(o_orderdate, '%Y%m') AS ano_mes FROM orders")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "partitioned")
    orders = with_year_month(table(spark, sf_dir, "orders"), "o_orderdate")
    partitioned_write(orders, path, YEAR_MONTH, ["o_orderdate"])
    return read_table(spark, path, orders.schema)


MOVED = "SELECT * REPLACE (event_id + 1000000000 AS event_id) FROM events"


def moved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_id", F.col("event_id") + 1000000000)


@query("incremental_ingest", f"SELECT * FROM events UNION ALL {MOVED}")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, ingest again, add files, ingest: every file once."""
    root = shared_dir(spark, "ingest")
    landing, bronze, ledger = f"{root}/landing", f"{root}/bronze", f"{root}/ledger"
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{landing}/first")
    for _ in range(2):
        ingest_files(spark, landing, bronze, ledger, events.schema)
    # The second delivery carries its identifiers as texts.
    moved_events(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string")).write.parquet(f"{landing}/second")
    ingest_files(spark, landing, bronze, ledger, events.schema)
    return read_bronze(spark, bronze, ledger, events.schema)


@query("stream_ingest", f"SELECT * FROM events UNION ALL {MOVED}")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stream whose checkpoint remembers the files."""
    root = shared_dir(spark, "stream-ingest")
    landing, bronze, checkpoint = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{landing}/first")
    for delivery in (None, moved_events(spark, sf_dir)):
        if delivery is not None:
            delivery.withColumn("event_id", F.col("event_id").cast("string")).write.parquet(f"{landing}/second")
        ingest_stream(spark, landing, bronze, checkpoint, events.schema).awaitTermination()
    return read_stream_bronze(spark, bronze, events.schema)


@query("stream_append", f"SELECT * FROM events UNION ALL {MOVED}")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the declared types, appended by the file sink."""
    root = shared_dir(spark, "stream-append")
    landing, bronze, checkpoint = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events")
    for delivery in (events, moved_events(spark, sf_dir)):
        delivery.write.mode("append").parquet(landing)
        append_stream(spark, landing, bronze, checkpoint, events.schema).awaitTermination()
    return spark.read.schema(events.schema).parquet(bronze)


# The second delivery changes every value; a third of its keys are new.
SECOND = {"event_id": "case when event_id % 3 = 0 then event_id + 1000000000 else event_id end", "value": "value + 1"}
SECOND_SQL = f"SELECT * REPLACE ({SECOND['event_id']} AS event_id, {SECOND['value']} AS value) FROM events"
UPSERT_SQL = f"""WITH s AS ({SECOND_SQL}) SELECT * FROM s
    UNION ALL SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = e.event_id)"""


def second_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumns({c: F.expr(e) for c, e in SECOND.items()})


@query("stream_upsert", UPSERT_SQL)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream-upsert")
    landing, silver, checkpoint = f"{root}/landing", f"{root}/silver", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events")
    by_day = lambda df: df.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    for delivery in (events, second_delivery(spark, sf_dir)):
        delivery.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        upsert_stream(stream, silver, ["event_id"], checkpoint, "day", order_by=["ts"], prepare=by_day).awaitTermination()
    return read_partitions(spark, silver, "day", by_day(events).schema).drop("day")


@query(
    "partition_upsert",
    f"""SELECT *, strftime(ts, '%Y%m%d') AS day FROM ({UPSERT_SQL})""",
)
def partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a table partitioned by day."""
    path = shared_dir(spark, "partition-upsert")
    day = F.date_format("ts", "yyyyMMdd")
    events = table(spark, sf_dir, "events").withColumn("day", day)
    upsert_partitions(events, path, "day", ["event_id", "ts"], source_unique=True)
    upsert_partitions(second_delivery(spark, sf_dir).withColumn("day", day), path, "day", ["event_id", "ts"], source_unique=True)
    return read_partitions(spark, path, "day", events.schema)


STATED = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "analyzed_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS greatest,
            count(*) - count({c}) AS nulls FROM orders"""
        for c in STATED
    ),
)
def analyzed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics of a clustered table, as the catalog has them."""
    name = f"stratalake_analyzed_{uuid.uuid4().hex}"
    optimize_for_reads(table(spark, sf_dir, "orders"), shared_dir(spark, "analyzed"), ["o_custkey"], table=name)
    stats = [{r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} {c}").collect()} for c in STATED]
    rows = [(c, float(s["min"]), float(s["max"]), int(s["num_nulls"])) for c, s in zip(STATED, stats)]
    return spark.createDataFrame(rows, "column_name string, least double, greatest double, nulls bigint")


@query("append_directory", f"SELECT * FROM events UNION ALL {MOVED}")
def append_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two plain appends, read back as a whole directory."""
    path = shared_dir(spark, "append")
    events = table(spark, sf_dir, "events")
    for delivery in (events, moved_events(spark, sf_dir)):
        append_parquet(delivery, path)
    return read_parquet(spark, path, events.schema)


MOVED_DAY = "ts + CASE WHEN event_id % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END"


@query(
    "partition_upsert_moved_keys",
    f"""SELECT * REPLACE (value + 1 AS value), strftime({MOVED_DAY}, '%Y%m%d') AS day FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT *, strftime(ts, '%Y%m%d') AS day FROM events WHERE event_id % 2 <> 0 OR event_id IS NULL""",
)
def partition_upsert_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the keys come again, a third of those in the partition of the next day: every key stays once."""
    path = shared_dir(spark, "partition-moved")
    events = table(spark, sf_dir, "events")
    known = events.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    again = events.filter("event_id % 2 = 0").withColumn("value", F.col("value") + 1)
    again = again.withColumn("day", F.date_format(F.expr(MOVED_DAY), "yyyyMMdd"))
    upsert_partitions(known, path, "day", ["event_id"], source_unique=True)
    upsert_partitions(again, path, "day", ["event_id"], source_unique=True)
    return read_partitions(spark, path, "day", known.schema)


FEW_SQL = "SELECT * FROM events WHERE event_id % 1000 = 7"


@query(
    "upsert_by_bloom",
    f"""SELECT * REPLACE (value + 1 AS value), strftime({MOVED_DAY}, '%Y%m%d') AS day FROM ({FEW_SQL})
    UNION ALL SELECT *, strftime(ts, '%Y%m%d') AS day FROM events WHERE event_id % 1000 <> 7 OR event_id IS NULL""",
)
def upsert_by_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few keys come again, some in the next day; Bloom filters tell which row groups may have them."""
    path = shared_dir(spark, "bloom")
    known = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    few = known.filter("event_id % 1000 = 7").withColumn("value", F.col("value") + 1)
    few = few.withColumn("day", F.date_format(F.expr(MOVED_DAY), "yyyyMMdd"))
    upsert_partitions(known, path, "day", ["event_id"], source_unique=True, bloom=True)
    upsert_partitions(few, path, "day", ["event_id"], source_unique=True, bloom=True)
    return read_partitions(spark, path, "day", known.schema)


@query(
    "ingest_drift",
    "SELECT event_id, value FROM events",
)
def ingest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose types alternate, in loads of three, and files that a pattern leaves out."""
    root = shared_dir(spark, "drift")
    landing, bronze, ledger = f"{root}/landing", f"{root}/bronze", f"{root}/ledger"
    events = table(spark, sf_dir, "events").select("event_id", "value")
    for part in range(4):
        share = events.filter(F.coalesce(F.pmod("event_id", F.lit(4)), F.lit(0)) == part)
        share = share.withColumn("event_id", F.col("event_id").cast("string")) if part % 2 else share
        share.write.parquet(f"{landing}/{part}")
    events.write.parquet(f"{landing}/rejected")
    ingest_files(spark, landing, bronze, ledger, events.schema, exclude=["/rejected/"], max_files=3)
    return read_bronze(spark, bronze, ledger, events.schema)


@query("sql_access", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def sql_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table queried as a view."""
    path = shared_dir(spark, "views")
    publish(table(spark, sf_dir, "orders"), path)
    register_views(spark, {"stratalake_orders": path})
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM stratalake_orders GROUP BY o_orderstatus")
