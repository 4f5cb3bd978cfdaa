import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.operators import dedup
from stratalake.operators.frequent import split_frequent

CALM = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SMALL = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]), st.integers(0, 3)), max_size=25)
DDL = "k string, o int, v int"


def best(data, least=False):
    """Brute force: one row per key."""
    def rank(row):
        order = row[1] if row[1] is not None else (float("inf") if least else float("-inf"))
        return (-order if least else order, row[2])

    out = {}
    for row in data:
        if row[0] not in out or rank(row) > rank(out[row[0]]):
            out[row[0]] = row
    return sorted(out.values(), key=repr)


@CALM
@given(SMALL)
def test_latest_and_min_match_brute_force(spark, data):
    for parts in (1, 5):
        df = spark.createDataFrame(data, DDL).repartition(parts)
        assert rows(dedup.keep_latest(df, ["k"], "o")) == best(data)
        assert rows(dedup.keep_min(df, ["k"], "o")) == best(data, least=True)
    once = dedup.keep_latest(df, ["k"], "o")
    assert rows(dedup.keep_latest(once, ["k"], "o")) == rows(once)


def test_null_targets(spark):
    df = spark.createDataFrame([("a", None), ("a", 3), ("a", 1)], "k string, v int")
    assert rows(dedup.keep_min(df, ["k"], "v")) == [("a", 1)]
    assert rows(dedup.keep_min(df, ["k"], "v", nulls="spark")) == [("a", None)]
    assert rows(dedup.keep_max(df, ["k"], "v")) == [("a", 3)]


def test_order_column_may_be_a_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, t int, p string")
    for parts in (1, 2, 3):
        assert rows(dedup.keep_latest(df.repartition(parts), ["k", "t"], "t")) == [("a", 1, "y")]
    assert rows(dedup.keep_latest(df.select("k", "t"), ["k", "t"], "t")) == [("a", 1)]


def test_helper_name_does_not_clash(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 2, 8)], "k string, __rank int, rn int")
    assert rows(dedup.keep_max(df, ["k"], "rn")) == [("a", 2, 8)]


def test_maps_do_not_break_ties_by_chance(spark):
    df = spark.createDataFrame([("a", {"x": 1}), ("a", {"x": 2})], "k string, m map<string,int>")
    assert rows(dedup.keep_latest(df, ["k"], "k")) == [("a", {"x": 2})]


def test_drop_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, None), (None, None)], "k string, v int")
    assert rows(dedup.drop_duplicates(df)) == sorted([("a", 1), ("a", 2), (None, None)], key=repr)
    assert rows(dedup.drop_duplicates(df, ["k"])) == sorted([("a", 2), (None, None)], key=repr)


def test_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(AnalysisException):
        dedup.keep_latest(df, ["zz"], "a")
    with pytest.raises(ValueError):
        dedup.keep_one(df, ["a"], ["a"], nulls="first")


def test_a_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedup.keep_latest(df, ["k"], "id"))
    assert text.count("WindowGroupLimit") == 2
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_hot_key_ships_one_row_per_task(spark):
    """A third of the rows share a key; the shuffle carries none of them twice per task."""
    df = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (F.col("id") * 7).alias("v")
    )
    out = dedup.keep_latest(df, ["k"], "v")
    got = out.filter("k = -1").first()
    assert got.v == 29997 * 7 and out.count() == 20001


def test_ranged_keeps_the_same_rows_in_one_shuffle(spark):
    """A third of the rows have one key; the others stay in ranges of the key they are written by."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 700).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).cast("string").alias("j"),
        (F.col("id") * 37 % 101).alias("v"),
        "id",
    )
    out = dedup.keep_one_ranged(df, ["j", "k"], ["v"], "k")
    assert rows(out) == rows(dedup.keep_one(df, ["j", "k"], ["v"]))
    frequent, rest = split_frequent(df, ["j", "k"])
    assert frequent.select("j", "k").distinct().collect() == [(None, None)] and frequent.count() == 1000 and rest.count() == 2000
    few = dedup.keep_one_ranged(df.filter("k is not null"), ["j", "k"], ["v"], "k")
    assert plan(few).count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan(few)
    held = few.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    assert all(a.high <= b.low for a, b in zip(held, held[1:]))
    assert dedup.keep_one_ranged(df.filter("id < 0"), ["j", "k"], ["v"], "k").count() == 0
