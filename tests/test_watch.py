"""Streams without repeats, counts of the silver write, sketches, differences of tables, feeds side by side, SQL functions."""

import threading
import time
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from stratalake.functions.sql import register_functions, register_month_of_service
from stratalake.operators.difference import differing_keys, differing_parts, digest_tree
from stratalake.operators.sketches import column_sketches, drift, merged_sketches, sketch_profile
from stratalake.plans.side_by_side import run_side_by_side
from stratalake.plans.silver import publish_counted_silver, read_silver, to_silver
from stratalake.sources import tables
from stratalake.sources.feeds import FEEDS
from stratalake.streaming.upsert import upsert_stream

DDL = "k int, v string, m string"


def test_repeats_never_reach_the_upsert(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    reached = []

    def counting(batch):
        reached.append(batch.count())
        return batch

    def deliver(*given):
        spark.createDataFrame(list(given), DDL).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(DDL).parquet(landing)
        reached.clear()
        upsert_stream(stream, path, ["k"], checkpoint, "m", derived_from=None, prepare=counting, repeats_within="10 days").awaitTermination()
        return sum(reached)

    assert deliver((1, "a", "x"), (2, "b", "x"), (1, "a", "x"), (None, None, None)) == 3
    # After a restart: repeats of the first delivery are known, corrections pass.
    assert deliver((1, "a", "x"), (2, "B", "x"), (None, None, None), (3, "c", "y")) == 2
    schema = spark.createDataFrame([], DDL).schema
    assert rows(tables.read_partitions(spark, path, "m", schema)) == sorted([(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (None, None, None)], key=repr)


def test_counts_of_the_silver_write(spark, tmp_path):
    feed, path = FEEDS["fhv"], str(tmp_path / "fhv")
    may, june = datetime(2023, 5, 1), datetime(2023, 6, 1)
    given = [("b", may, None, "7", "x", 1, "A"), ("b", may, None, "7", "8", 1, None), (None, june, june, "x1", None, 1, "A"), ("c", None, june, "1", "2", 1, "A")]
    names = ["dispatching_base_num", "pickup_datetime", "dropOff_datetime", "PUlocationID", "DOlocationID", "SR_Flag", "Affiliated_base_number"]
    bronze = spark.createDataFrame(given, "a string, b timestamp, c timestamp, d string, e string, f bigint, g string").toDF(*names)
    got = {tuple(r[:3]): r[3] for r in publish_counted_silver(bronze, feed, path, "2024-01-01 00:00:00")}
    assert got == {
        (None, "dispatching_base_num", "fillers"): 1, (None, "pickup_datetime", "fillers"): 1, (None, "dropoff_datetime", "fillers"): 2,
        (None, "affiliated_base_number", "fillers"): 1, (None, "pulocationid", "cast_failures"): 1, (None, "dolocationid", "cast_failures"): 1,
        ("190001", None, "rows"): 1, ("190001", None, "filled_rows"): 1, ("202305", None, "rows"): 2, ("202305", None, "filled_rows"): 2,
        ("202305", None, "failed_rows"): 1, ("202305", None, "collapsed"): 1, ("202306", None, "rows"): 1, ("202306", None, "filled_rows"): 1,
        ("202306", None, "failed_rows"): 1,
    }
    assert rows(read_silver(spark, feed, path)) == rows(to_silver(bronze, feed, "2024-01-01 00:00:00"))
    assert publish_counted_silver(bronze.filter("SR_Flag = 9"), feed, path) == []


def test_sketches_merge_and_stay_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("m"), (F.col("id") % 6).alias("day"), (F.col("id") * 7919 % 50_021).alias("v"), (F.col("id") % 9_000).cast("string").alias("s"))
    days = column_sketches(df, ["m", "day"], ["v", "s"])
    got = {(r.m, r.column_name): r for r in sketch_profile(merged_sketches(days, ["m"])).collect()}
    for m in (0, 1):
        own = df.filter(f"m = {m}")
        low, exact, high, distinct = own.agg(F.percentile("v", 0.48), F.percentile("v", 0.5), F.percentile("v", 0.52), F.count_distinct("v")).first()
        assert low < got[m, "v"].q50 < high and got[m, "v"].n_values == 30_000 and exact
        assert got[m, "v"].n_distinct == pytest.approx(distinct, rel=0.06) and got[m, "s"].n_distinct == pytest.approx(4_500, rel=0.06)
        assert got[m, "s"].q50 is None
    moved = spark.range(3000).select((F.col("id") % 3).alias("m"), F.when(F.col("id") % 3 < 2, F.col("id") % 100).otherwise(F.col("id") % 100 + 100).cast("double").alias("v"), F.lit(None).cast("int").alias("none"))
    steps = {(r.m, r.column_name): (r.previous, r.drift) for r in drift(column_sketches(moved, ["m"], ["v", "none"]), "m").collect()}
    assert steps[0, "v"] == (None, None) and steps[1, "none"] == (0, None)
    assert steps[1, "v"][1] < 0.05 and 0.45 < steps[2, "v"][1] < 0.6
    odd = spark.createDataFrame([(1, float("nan")), (1, None), (1, 2.0)], "m int, v double")
    (row,) = sketch_profile(column_sketches(odd, ["m"], ["v"])).collect()
    assert (row.n_values, row.n_nulls, row.n_distinct, row.q50) == (2, 1, 2, 2.0)
    assert column_sketches(odd.filter("m = 2"), ["m"], ["v"]).count() == 0


def test_only_differing_partitions_are_read(spark):
    old = [(i, f"v{i}", f"m{i % 5}") for i in range(200)] + [(None, "n", None), (None, "n2", "m4"), (7, "twice", "m2")]
    new = [r for r in old if r[0] != 13]
    new = [(k, "other" if k == 28 else v, m) for k, v, m in new] + [(500, "new", "m3")]
    new[new.index((None, "n", None))] = (None, "changed", None)
    a, b = (spark.createDataFrame(x, DDL).repartition(3) for x in (old, new))
    asked = []

    def reader(df):
        def read(parts):
            asked.append(parts)
            wanted = [p for p in parts if p is not None]
            return df.filter(F.col("m").isin(wanted) | (F.col("m").isNull() if None in parts else F.lit(False)))

        return read

    trees = [digest_tree(df, "m", ["k"], ["k", "v"], buckets=16) for df in (a, b)]
    got = differing_keys(*trees, reader(a), reader(b), "m", ["k"], ["k", "v"], buckets=16)
    assert rows(got) == sorted([(13, "removed"), (28, "changed"), (500, "added"), (None, "changed")], key=repr)
    assert asked == [[None, "m3"], [None, "m3"]] and differing_parts(trees[0], trees[0]) == []
    assert differing_keys(trees[0], trees[0], reader(a), reader(a), "m", ["k"], ["k", "v"], buckets=16).count() == 0


def test_feeds_overlap_and_fail_alone(spark):
    both, lines = threading.Barrier(2, timeout=60), {}

    def work(name):
        both.wait()  # each waits for the other: they are under way at the same time
        lines[name] = (spark.sparkContext.getLocalProperty("spark.scheduler.pool"), list(spark.sparkContext.getJobTags()))
        return spark.range(10).count()

    def bad():
        raise ValueError("no such feed")

    results, errors = run_side_by_side(spark, {"one": lambda: work("one"), "two": lambda: work("two"), "bad": bad}, 2)
    assert results == {"one": 10, "two": 10} and list(errors) == ["bad"] and isinstance(errors["bad"], ValueError)
    assert lines["one"][0] == "one" and lines["two"][0] == "two" and not set(lines["one"][1]) & set(lines["two"][1])
    assert not spark.sparkContext.getJobTags() and run_side_by_side(spark, {}, 4) == ({}, {})


def test_a_failure_cancels_only_its_own_jobs(spark):
    from pyspark import InheritableThread

    started, ended = threading.Event(), {}

    def leaves_a_job():
        def job():
            started.set()
            try:
                spark.range(0, 400_000_000, 1, 64).selectExpr("max(sha2(cast(id as string), 512)) x").collect()
                ended["job"] = "done"
            except Exception:
                ended["job"] = "cancelled"

        thread = InheritableThread(target=job, session=spark)
        thread.start()
        started.wait(30)
        time.sleep(2)
        ended["thread"] = thread
        raise RuntimeError("the feed fails while its job runs")

    def good():
        time.sleep(1)
        return spark.range(0, 200_000, 1, 4).selectExpr("max(sha2(cast(id as string), 512)) x").count()

    results, errors = run_side_by_side(spark, {"bad": leaves_a_job, "good": good}, 2)
    ended["thread"].join(60)
    assert results == {"good": 1} and list(errors) == ["bad"] and ended["job"] == "cancelled"


def test_sql_functions_say_what_the_columns_say(spark, tmp_path):
    from stratalake.functions import masks
    from stratalake.functions.dates import year_month
    from stratalake.functions.digests import row_digest

    names = register_functions(spark, "t_")
    assert "t_mask_cpf" in names
    df = spark.createDataFrame([("123.456.789-00", datetime(2023, 5, 1)), ("12", None), (None, datetime(1999, 12, 31, 23)), ("joão@x.com", None)], "v string, at timestamp_ntz")
    df.createOrReplaceTempView("t_values")
    got = spark.sql("select t_mask_cpf(v), t_mask_email(v), t_mask_phone(v), t_text_hash(v), t_row_hash(array(v, v)), t_year_month(at) from t_values")
    v = F.col("v")
    want = df.select(masks.cpf(v), masks.email(v), masks.phone(v), masks.sha256(v), row_digest([v, v]), year_month(F.col("at")))
    assert rows(got) == rows(want) and "Python" not in plan(got)
    path = str(tmp_path / "trips")
    spark.createDataFrame([("yellow", "202305", 1), ("yellow", "202306", 2), ("green", "202305", 3)], "service_type string, ano_mes string, n int").write.partitionBy("ano_mes").parquet(path)
    spark.read.schema("service_type string, n int, ano_mes string").parquet(path).createOrReplaceTempView("t_trips")
    register_month_of_service(spark, "t_trips", "t_month_of_service")
    out = spark.sql("select n from t_month_of_service('yellow', '202305')")
    assert "PartitionFilters: [isnotnull(ano_mes" in plan(out) and rows(out) == [(1,)]
