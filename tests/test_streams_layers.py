from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratalake.plans.gold import publish_gold, read_gold_monthly, read_gold_trips, to_gold
from stratalake.plans.layers import run_layers
from stratalake.plans.silver import optimize_silver, publish_silver, read_silver, to_silver
from stratalake.sources import tables
from stratalake.sources.feeds import FEEDS
from stratalake.streaming.ingest import append_stream, ingest_stream, read_stream_bronze
from stratalake.streaming.upsert import upsert_stream

DDL = "k int, v string"


def deliver(spark, path, data, ddl=DDL):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(path)


def test_append_stream_takes_each_file_once(spark, tmp_path):
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("l", "b", "c"))
    schema = spark.createDataFrame([], DDL).schema
    deliver(spark, landing, [(1, "a"), (2, "b")])
    for _ in range(2):
        append_stream(spark, landing, bronze, checkpoint, schema).awaitTermination()
        assert spark.read.parquet(bronze).count() == 2
    deliver(spark, landing, [(3, "c")])
    append_stream(spark, landing, bronze, checkpoint, schema).awaitTermination()
    assert rows(spark.read.parquet(bronze)) == [(1, "a"), (2, "b"), (3, "c")]


def test_ingest_stream_with_drift_and_two_streams(spark, tmp_path):
    landing, bronze = str(tmp_path / "l"), str(tmp_path / "b")
    schema = spark.createDataFrame([], DDL).schema
    deliver(spark, f"{landing}/1", [(1, "a")])
    deliver(spark, f"{landing}/2", [("2.0", "b")], "k string, v string")
    deliver(spark, f"{landing}/skip-me", [(9, "z")])
    run = lambda checkpoint, source: ingest_stream(
        spark, source, bronze, str(tmp_path / checkpoint), schema, exclude=["skip-me"], max_files=1
    ).awaitTermination()
    for _ in range(2):
        run("c1", landing)
        assert rows(read_stream_bronze(spark, bronze, schema)) == [(1, "a"), (2, "b")]
    deliver(spark, f"{landing}/3", [(3, "c")])
    run("c1", landing)
    other = str(tmp_path / "l2")
    deliver(spark, other, [(4, "d")])
    run("c2", other)
    assert rows(read_stream_bronze(spark, bronze, schema)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    """Forget the commit of the last batch, as a crash right before it would."""
    import os

    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("l", "b", "c"))
    schema = spark.createDataFrame([], DDL).schema
    deliver(spark, landing, [(1, "a")])
    ingest_stream(spark, landing, bronze, checkpoint, schema).awaitTermination()
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")
    deliver(spark, landing, [(2, "b")])
    ingest_stream(spark, landing, bronze, checkpoint, schema).awaitTermination()
    assert rows(read_stream_bronze(spark, bronze, schema)) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("partition", ["n", "v"])
def test_upsert_stream(spark, tmp_path, partition):
    landing, silver, checkpoint = (str(tmp_path / n) for n in ("l", "s", "c"))
    ddl = "k int, v string, n int"
    schema = spark.createDataFrame([], ddl).schema
    prepare = lambda df: df.filter("k > 0")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        upsert_stream(stream, silver, ["k"], checkpoint, partition, ["n"], prepare=prepare).awaitTermination()

    deliver(spark, landing, [(1, "a", 1), (1, "a", 2), (-5, "a", 1), (2, "b", 1)], ddl)
    run()
    deliver(spark, landing, [(2, "b", 7), (3, "c", 1)], ddl)
    run()
    run()
    assert rows(tables.read_partitions(spark, silver, partition, schema)) == [(1, "a", 2), (2, "b", 7), (3, "c", 1)]


def trip(name, spark, ntz=False, **values):
    feed = FEEDS[name].with_ntz() if ntz else FEEDS[name]
    names = [f.name for f in feed.schema.fields]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], feed.schema)


def test_silver_rules(spark):
    feed = FEEDS["yellow"]
    at = datetime(2023, 5, 1, 8)
    a = trip("yellow", spark, VendorID=1, tpep_pickup_datetime=at, store_and_fwd_flag=" n ", total_amount=1.0)
    b = trip("yellow", spark, VendorID=1, tpep_pickup_datetime=at, total_amount=2.0)
    c = trip("yellow", spark, VendorID=2, passenger_count=3)
    union = a.union(b).union(c).withColumn("fare_amount", F.lit("7.5"))
    results = {tuple(rows(to_silver(union.repartition(n), feed, as_of="2024-01-01 00:00:00"))) for n in (1, 4)}
    assert len(results) == 1
    out = to_silver(union, feed, as_of="2024-01-01 00:00:00")
    assert out.columns == [f.name.lower() for f in feed.schema.fields] + ["data_ingestao", "ano_mes"]
    got = {r.vendorid: r for r in out.collect()}
    assert len(got) == 2
    assert got[1].ano_mes == "202305" and got[1].passenger_count is None and got[1].fare_amount == "7.5"
    # Passengers tie (null), distances tie (0.0): the flag decides, descending.
    assert got[1].store_and_fwd_flag == "desconhecido" and got[1].total_amount == 2.0
    assert got[2].ano_mes == "190001" and got[2].tpep_pickup_datetime == datetime(1900, 1, 1)
    assert got[2].data_ingestao == datetime(2024, 1, 1)


def test_silver_publish_and_optimize(spark, tmp_path):
    feed, path = FEEDS["fhv"], str(tmp_path / "fhv")
    at, later = datetime(2023, 5, 1), datetime(2023, 6, 1)
    first = trip("fhv", spark, dispatching_base_num="b1", pickup_datetime=at, SR_Flag=1).union(
        trip("fhv", spark, dispatching_base_num="b1", pickup_datetime=later, SR_Flag=2)
    )
    publish_silver(first, feed, path)
    publish_silver(trip("fhv", spark, dispatching_base_num=" B1", pickup_datetime=at, SR_Flag=9), feed, path)
    view = lambda: rows(read_silver(spark, feed, path).select("dispatching_base_num", "ano_mes", "sr_flag"))
    assert view() == [("B1", "202305", 9), ("B1", "202306", 2)]
    assert tables.partition_values(spark, path, "ano_mes", 2) == ["202305"]
    optimize_silver(spark, feed, path, ["202306"])
    assert tables.partition_values(spark, path, "ano_mes", 3) == ["202306"]
    assert view() == [("B1", "202305", 9), ("B1", "202306", 2)]
    assert read_silver(spark, feed, path, ["202306"]).count() == 1


@pytest.mark.parametrize("optimize", [False, True])
def test_layers_are_incremental(spark, tmp_path, optimize):
    landing = {name: str(tmp_path / "landing" / name) for name in ("yellow", "hvfhv")}
    lake = str(tmp_path / "lake")
    may, june = datetime(2023, 5, 1, 8), datetime(2023, 6, 1, 8)
    write = lambda name, **v: trip(name, spark, **v).coalesce(1).write.mode("append").parquet(landing[name])
    write("yellow", VendorID=1, tpep_pickup_datetime=may, total_amount=10.0, passenger_count=2, PULocationID=1, DOLocationID=1)
    write("yellow", VendorID=2, tpep_pickup_datetime=june, total_amount=30.0, passenger_count=4, PULocationID=1, DOLocationID=1)
    write("hvfhv", hvfhs_license_num="hv0003", pickup_datetime=may, base_passenger_fare=5.0, PULocationID=2, DOLocationID=2)
    run = lambda: run_layers(spark, landing, lake, optimize=optimize)
    out = run()
    columns = ["ano_mes", "service_type", "provider", "qtd_corridas", "faturamento_total"]
    monthly = lambda t: rows(t["gold_monthly"].select(*columns))
    assert monthly(out) == [
        ("202305", "hvfhv", "Uber", 1, 5.0), ("202305", "yellow", "yellow", 1, 10.0), ("202306", "yellow", "yellow", 1, 30.0),
    ]
    assert rows(out["report"]) == [("media_passageiros", "8", 2.0), ("media_total_amount", "yellow", 20.0)]
    # Nothing new: nothing is written.
    gold = tables.versions(spark, f"{lake}/gold/trips")
    assert monthly(run()) == monthly(out) and tables.versions(spark, f"{lake}/gold/trips") == gold
    # A correction for May rewrites May and leaves June alone.
    write("yellow", VendorID=1, tpep_pickup_datetime=may, total_amount=11.0, passenger_count=6, PULocationID=1, DOLocationID=1)
    out = run()
    assert ("202305", "yellow", "yellow", 1, 11.0) in monthly(out) and len(monthly(out)) == 3
    assert tables.partition_values(spark, f"{lake}/gold/trips", "ano_mes", gold[-1] + 1) == ["202305"]
    assert spark.sql("select count(*) n from gold_trips").first().n == 3


def test_a_bad_feed_stops_no_other(spark, tmp_path):
    landing, lake = {n: str(tmp_path / "landing" / n) for n in ("green", "fhv")}, str(tmp_path / "lake")
    fhv = {"dispatching_base_num": "B1", "pickup_datetime": datetime(2023, 5, 1, 8)}
    columns = [F.lit(fhv.get(f.name)).cast(f.dataType).alias(f.name) for f in FEEDS["fhv"].schema.fields]
    spark.range(1).select(*columns).write.parquet(landing["fhv"])
    spark.createDataFrame([(1,)], "VendorID int").coalesce(1).write.parquet(landing["green"])
    for _ in range(2):
        out = run_layers(spark, landing, lake)
        assert [r.service_type for r in out["gold_monthly"].collect()] == ["fhv"]
        ((feed, error),) = rows(out["errors"])
        assert feed == "green" and "lacks the declared columns" in error
        assert not tables.table_exists(spark, f"{lake}/silver_done/green") and not tables.table_exists(spark, f"{lake}/gold_done/green")


def test_clustered_gold_is_written_once(spark, tmp_path):
    at = [datetime(2023, m, d, 8) for m in (5, 6) for d in range(1, 11)]
    silver = {"fhv": to_silver(spark.createDataFrame([("b", t, t, d, None, None, None) for d, t in enumerate(at)], FEEDS["fhv"].schema), FEEDS["fhv"])}
    trips, monthly = str(tmp_path / "trips"), str(tmp_path / "monthly")
    publish_gold(spark, to_gold(silver), trips, monthly, optimize=True)
    assert tables.newest_parts(spark, trips) == 1 and tables.newest_parts(spark, monthly) == 2
    assert sorted(r.pickup_datetime for r in read_gold_trips(spark, trips).collect()) == at
    assert read_gold_monthly(spark, monthly).agg(F.sum("qtd_corridas")).first()[0] == 20


def test_silver_and_gold_by_month_need_few_files(spark, tmp_path):
    """Rows of a month lie together after one shuffle, so no task writes to all months."""
    feed, lake, landing = FEEDS["fhv"], str(tmp_path / "lake"), str(tmp_path / "landing")
    months = [datetime(2020 + n // 12, n % 12 + 1, 1) for n in range(24)]
    moments = [F.lit(m).cast("timestamp") for m in months]
    raw = spark.range(0, 4800, 1, 8).select(
        F.concat(F.lit("b"), F.col("id")).alias("dispatching_base_num"),
        F.element_at(F.array(*moments), (F.col("id") % 24 + 1).cast("int")).alias("pickup_datetime"),
        F.lit(None).cast("timestamp").alias("dropOff_datetime"),
        *[F.col("id").alias(c) for c in ("PUlocationID", "DOlocationID", "SR_Flag")],
        F.lit("a").alias("Affiliated_base_number"),
    )
    raw.write.parquet(landing)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        out = run_layers(spark, {"fhv": landing}, lake)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert out["gold_trips"].count() == 4800 and out["silver_fhv"].count() == 4800
    for table in (f"{lake}/silver/fhv", f"{lake}/gold/trips", f"{lake}/gold/monthly"):
        names = [r.file for r in tables.part_files(spark, table).collect()]
        assert 24 <= len(names) <= 24 + 8 and all(n.endswith(".zstd.parquet") for n in names), table
