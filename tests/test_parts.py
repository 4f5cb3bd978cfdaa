"""Tables of partitions: what a version costs, compaction, Bloom filters, partition pruning."""

import os

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from queries import feeds, writes
from stratalake.sources import tables

SF_DIR = "/root/testdata/sf0.001"
DDL = "k bigint, v string, m string"


def data_files(spark, path):
    return {r.file: r.bytes for r in tables.part_files(spark, path).collect() if r.file}


def test_opening_a_table_costs_the_same_after_many_versions(spark, tmp_path, monkeypatch):
    path, listed = str(tmp_path / "t"), []
    known = tables.matching

    def counted(*args):
        found = known(*args)
        listed.append(len(found))
        return found

    def cost():
        listed.clear()
        assert tables.read_partitions(spark, path, "m", schema).count() == 2
        return len(listed), sum(listed)

    first = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], DDL)
    schema = first.schema
    for _ in range(2):
        tables.upsert_partitions(first, path, "m", ["k"])
    monkeypatch.setattr(tables, "matching", counted)
    before = cost()
    for i in range(8):
        tables.upsert_partitions(spark.createDataFrame([(1, f"a{i}", "x")], DDL), path, "m", ["k"], derived_from="k")
    assert cost() == before and len(os.listdir(tables.parts_path(path))) == 2
    assert rows(tables.read_partitions(spark, path, "m", schema)) == [(1, "a7", "x"), (2, "b", None)]
    assert tables.changed_partitions(spark, path, 2) == ["x"] and tables.changed_partitions(spark, path, 0) == [None, "x"]


def test_a_partition_without_rows_is_no_directory(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], DDL), path, "m", ["k"])
    tables.upsert_partitions(spark.createDataFrame([(1, "A", "y")], DDL), path, "m", ["k"])
    assert rows(tables.read_partitions(spark, path, "m", spark.createDataFrame([], DDL).schema)) == [(1, "A", "y"), (2, "b", "y")]
    assert tables.partition_values(spark, path, "m", 2) == ["x", "y"] and not os.path.exists(f"{tables.version_dir(path, 2)}/m=x")
    # Data without its small table does not count, and its number is taken again.
    spark.range(3).select(F.col("id").alias("k"), F.lit("lost").alias("v"), F.lit("z").alias("m")).write.partitionBy("m").parquet(tables.version_dir(path, 3))
    assert tables.read_partitions(spark, path, "m", spark.createDataFrame([], DDL).schema).count() == 2
    tables.publish_partitions(spark.createDataFrame([(9, "z", "z")], DDL), path, "m")
    assert rows(tables.read_partitions(spark, path, "m", spark.createDataFrame([], DDL).schema).filter("m = 'z'")) == [(9, "z", "z")]


def test_compaction_leaves_big_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(0, 60_000, 1, 1).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a/b %").alias("m"))
    small = spark.range(60_000, 60_900, 1, 9).select(F.col("id").alias("k"), F.lit("s").alias("v"), F.when(F.col("id") % 3 > 0, F.lit("a/b %")).alias("m"))
    tables.publish_partitions(big.unionByName(small), path, "m")
    before, read = data_files(spark, path), lambda: tables.read_partitions(spark, path, "m", big.schema)
    want = rows(read().groupBy("m").agg(F.count("*"), F.sum("k")))
    assert len(before) == 19
    assert tables.compact_partitions(spark, path, "m", big.schema, target=1 << 20) == 16
    after = data_files(spark, path)
    assert len(after) == 3 and {f for f, size in before.items() if size > 1 << 19} <= set(after)
    assert rows(read().groupBy("m").agg(F.count("*"), F.sum("k"))) == want
    assert tables.changed_partitions(spark, path, 1) == []  # no rows changed
    assert tables.compact_partitions(spark, path, "m", big.schema, target=1 << 20) == 0 and data_files(spark, path) == after
    # In several writes, and for one partition only.
    tables.publish_partitions(small, path, "m")
    assert tables.compact_partitions(spark, path, "m", big.schema, target=1 << 20, max_files=2, only=[None]) == 8
    assert len(data_files(spark, path)) == 10 and read().count() == 900


def scanned(df):
    """Rows that the scan of a collected plan read."""
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("bloom", [True, False])
def test_few_keys_read_few_row_groups(spark, tmp_path, bloom):
    path = str(tmp_path / "t")
    df = spark.range(0, 40_000, 1, 20).select(F.xxhash64("id").alias("k"), F.col("id").cast("string").alias("v"), F.lit("x").alias("m"))
    tables.publish_partitions(df.repartition(20, F.col("v")), path, "m", bloom=["k"] if bloom else [])
    wanted = [r.k for r in df.filter("v in ('17', '25000')").collect()]
    found = tables.read_partitions(spark, path, "m", df.schema).filter(F.col("k").isin([*wanted, 123456789]))
    assert sorted(r.v for r in found.collect()) == ["17", "25000"]
    assert (scanned(found) < 40_000 / 2) == bloom
    source = spark.createDataFrame([(k, "new", "x") for k in wanted], DDL)
    looked_up = tables.rows_with_keys(tables.read_partitions(spark, path, "m", df.schema), source, ["k"])
    assert sorted(r.v for r in looked_up.collect()) == ["17", "25000"]
    many = tables.rows_with_keys(tables.read_partitions(spark, path, "m", df.schema), source, ["k"], limit=1)
    assert sorted(r.v for r in many.collect()) == ["17", "25000"]


def test_null_keys_are_looked_up(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None, "n", "x"), (1, "a", "x"), (2, None, "y")], DDL)
    tables.upsert_partitions(df, path, "m", ["k", "v"], bloom=True)
    tables.upsert_partitions(spark.createDataFrame([(None, "n", "z"), (2, None, "z")], DDL), path, "m", ["k", "v"], bloom=True)
    assert rows(tables.read_partitions(spark, path, "m", df.schema)) == sorted([(None, "n", "z"), (2, None, "z"), (1, "a", "x")], key=repr)


def test_the_report_prunes_partitions(spark):
    text = plan(writes.report_from_published(spark, SF_DIR))
    scans = [line for line in text.splitlines() if "FileScan" in line and "passenger_count" in line]
    assert scans and all("PartitionFilters: [" in s and "EndsWith(ano_mes" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_groups_of_silver_are_summed_after_the_shuffle(spark):
    """Trips are narrower than the sums of a group, and most groups have few trips."""
    text = plan(feeds.gold_monthly_from_silver(spark, SF_DIR))
    assert "partial_sum" in text[: text.index("Exchange")]
    assert text.count("Exchange rangepartitioning") == 5
