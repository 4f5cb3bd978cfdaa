from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from stratalake.functions.casting import text_to_bigint
from stratalake.operators import clean
from stratalake.operators.quality import preview, profile, quality_report, schema_rows
from stratalake.operators.schema import cast_via_string, enforce_schema, lower_names
from stratalake.sources.feeds import FEEDS


def ddl(text):
    return T.StructType.fromDDL(text)


def test_text_to_bigint(spark, either_mode):
    texts = ["1.0", "1.9", "-1.9", "1.0E10", "9007199254740993", "9223372036854775807", " 7 ", "", "x", None, "1e99", "."]
    df = spark.createDataFrame([(t,) for t in texts], "a string").select(text_to_bigint(F.col("a")).alias("n"))
    assert [r.n for r in df.collect()] == [
        1, 1, -1, 10000000000, 9007199254740993, 9223372036854775807, 7, None, None, None, None, None,
    ]


def test_enforce_schema_casts_orders_and_drops(spark, either_mode):
    df = spark.createDataFrame([("1.0", "x", 2.9, "2024-02-30"), (None, "3.5", None, "2024-02-29")], "B string, a string, c double, d string")
    out = enforce_schema(df, ddl("a double, b int, C bigint, d date"))
    assert out.schema.simpleString() == "struct<a:double,b:int,C:bigint,d:date>"
    assert rows(out) == rows(spark.createDataFrame([(None, 1, 2, None), (3.5, None, None, date(2024, 2, 29))], out.schema))


def test_enforce_schema_casing_is_taken_from_the_schema(spark):
    df = spark.createDataFrame([("2.5",)], "airport_fee string")
    out = enforce_schema(df, ddl("Airport_fee double"))
    assert out.columns == ["Airport_fee"] and out.first()[0] == 2.5


def test_enforce_schema_missing_and_ambiguous(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(AnalysisException, match="b"):
        enforce_schema(df, ddl("a int, b string"))
    assert rows(enforce_schema(df, ddl("a int, b string"), on_missing="null")) == [(1, None)]
    with pytest.raises(ValueError):
        enforce_schema(df, ddl("a int"), on_missing="skip")
    twice = spark.createDataFrame([(1, 2)], "Ab int, aB int")
    with pytest.raises(AnalysisException, match="ambiguous"):
        enforce_schema(twice, ddl("AB int"))


def test_odd_column_names(spark):
    df = spark.createDataFrame([(" a ", 1)], "`x.y` string, `b``c` int")
    assert rows(clean.trim_strings(df)) == [("a", 1)]
    assert rows(enforce_schema(df, T.StructType().add("x.y", "string").add("b`c", T.LongType()))) == [(" a ", 1)]


def test_cast_via_string(spark, either_mode):
    df = spark.createDataFrame([(17.0, 1.0e10), (None, 3.7)], "a double, b double")
    assert rows(cast_via_string(df, ddl("a bigint, b bigint"))) == rows(
        spark.createDataFrame([(17, 10000000000), (None, 3)], "a bigint, b bigint")
    )


def test_lower_names(spark):
    assert lower_names(spark.createDataFrame([(1, 2)], "VendorID int, X int")).columns == ["vendorid", "x"]
    with pytest.raises(AnalysisException, match="clash"):
        lower_names(spark.createDataFrame([(1, 2)], "a int, A int"))


def test_feed_schemas():
    sizes = {name: len(feed.schema.fields) for name, feed in FEEDS.items()}
    assert sizes == {"yellow": 19, "green": 20, "fhv": 7, "hvfhv": 24}
    assert FEEDS["yellow"].schema["fare_amount"].dataType == T.StringType()
    assert FEEDS["yellow"].schema["VendorID"].dataType == T.LongType()
    ntz = FEEDS["fhv"].with_ntz().schema
    assert [f.dataType.simpleString() for f in ntz.fields][1:3] == ["timestamp_ntz"] * 2
    for feed in FEEDS.values():
        lower = [f.name.lower() for f in feed.schema.fields]
        assert set(feed.keys) | {feed.pickup} | set(feed.cluster_by) <= set(lower)


MIXED = "s string, i int, b bigint, d double, day date, t timestamp, n timestamp_ntz"


def mixed(spark):
    return spark.createDataFrame([(None,) * 7, (" v\t ", 1, 2, 3.0, date(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 1, 2))], MIXED)


def test_standard_clean(spark, either_mode):
    out = clean.standard_clean(mixed(spark))
    assert out.schema.simpleString() == mixed(spark).schema.simpleString()
    old = datetime(1900, 1, 1)
    assert rows(out) == sorted(
        [
            ("desconhecido", 0, None, 0.0, date(1900, 1, 1), old, old),
            ("v\t", 1, 2, 3.0, date(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 1, 2)),
        ],
        key=repr,
    )


def test_fill_by_type_touches_only_its_type(spark):
    filled = {k: clean.fill_by_type(mixed(spark), k).filter("d is null or s is null").first() for k in clean.TYPES}
    assert filled["int"].i == 0 and filled["int"].b is None
    assert filled["bigint"].b == 0 and filled["bigint"].i is None
    assert filled["timestamp"].t == datetime(1900, 1, 1) and filled["timestamp"].n is None
    assert clean.fill_by_type(mixed(spark), "timestamp_ntz").filter("n = timestamp_ntz'1900-01-01 00:00:00'").count() == 1
    assert clean.fill_by_type(mixed(spark), "string", "none").filter("s = 'none'").count() == 1


def test_fill_nulls(spark, either_mode):
    df = spark.createDataFrame([("7", None), (None, "a"), ("x", "b")], "n string, s string")
    # A value that does not convert is not missing, so it is not filled.
    assert [r.n for r in clean.fill_nulls(df, ["n"], "int").collect()] == [7, 0, None]
    assert [r.n for r in clean.fill_nulls(df, ["N"], "double", 1.5).collect()] == [7.0, 1.5, None]
    assert [r.s for r in clean.fill_nulls(df, ["s"], "string").collect()] == ["desconhecido", "a", "b"]
    with pytest.raises(ValueError):
        clean.fill_nulls(df, ["n"], "decimal", 1)
    with pytest.raises(ValueError):
        clean.fill_by_type(df, "boolean")
    with pytest.raises(AnalysisException):
        clean.fill_nulls(df, ["zz"], "int")


def test_trim_and_upper(spark):
    df = spark.createDataFrame([("  a b  ", 1), ("\tc\t", 2), ("   ", 3)], "s string, n int")
    assert [r.s for r in clean.trim_strings(df).collect()] == ["a b", "\tc\t", ""]
    assert [r.s for r in clean.trim_strings(df, blank_to_null=True).collect()] == ["a b", "\tc\t", None]
    assert [r.s for r in clean.upper_strings(df).collect()] == ["  A B  ", "\tC\t", "   "]


def _to_utc(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 1, 5), datetime(2024, 3, 10, 2, 30))], "n timestamp_ntz, gap timestamp_ntz")
    out = clean.to_utc(df, ["n"], "America/New_York")
    assert out.schema["n"].dataType == T.TimestampNTZType()
    assert out.first().n == datetime(2024, 7, 1, 9)
    assert clean.to_utc(df, ["n", "gap"]).first() == df.first()


def test_to_utc(spark):
    _to_utc(spark)
    aware = spark.sql("select timestamp '2024-07-01 05:00:00' as t")
    assert clean.to_utc(aware, ["t"], "America/New_York").first().t == datetime(2024, 7, 1, 9)


def test_to_utc_does_not_depend_on_the_session_zone(spark, zone):
    _to_utc(spark)


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(1, "b", None), (3, "a", None), (None, None, None)], "n int, s string, d date")
    got = {r.column_name: r for r in profile(df).collect()}
    assert tuple(got["n"])[1:] == ("int", 2, 1, 2.0, pytest.approx(2**0.5), "1", "3")
    assert tuple(got["s"])[1:] == ("string", 2, 1, None, None, "a", "b")
    assert tuple(got["d"])[1:] == ("date", 0, 3, None, None, None, None)
    assert preview(df).count() == 1
    assert [tuple(r) for r in schema_rows(df).collect()] == [
        (0, "n", "int", True), (1, "s", "string", True), (2, "d", "date", True),
    ]


def test_quality_report(spark, either_mode):
    df = spark.createDataFrame(
        [(1, "x", "desconhecido"), (1, "2.0", None), (2, None, "v"), (None, "3", "v"), (None, "4", "v")],
        "k int, n string, s string",
    )
    got = {(r.column_name, r.check): r.n for r in quality_report(df, ddl("k bigint, N int, z string"), ["k"]).collect()}
    assert got == {
        (None, "rows"): 5,
        ("k", "nulls"): 2,
        ("n", "nulls"): 1,
        ("s", "nulls"): 1,
        ("n", "sentinels"): 0,
        ("s", "sentinels"): 1,
        ("k", "missing_column"): 0,
        ("N", "missing_column"): 0,
        ("z", "missing_column"): 1,
        ("k", "cast_failures"): 0,
        ("N", "cast_failures"): 1,
        ("k", "duplicate_keys"): 2,
    }
    empty = {(r.column_name, r.check): r.n for r in quality_report(df.filter("false"), keys=["k"]).collect()}
    assert set(empty.values()) == {0}
