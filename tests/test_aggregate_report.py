import math
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.fixed import MONTHLY_KEYS, MONTHLY_MEASURES
from stratalake.operators import aggregate
from stratalake.operators.aggregate import hourly_mean, mean_of_group_totals, monthly_aggregate, monthly_aggregate_ranged, monthly_mean
from stratalake.operators.conform import code_label, conform, typed_null, union_all
from stratalake.plans.gold import to_gold
from stratalake.plans.inspect import inspect_feeds
from stratalake.plans.report import report, report_lines, write_report
from stratalake.sources.feeds import FEEDS

TRIPS = (
    "pickup_datetime timestamp_ntz, pulocationid bigint, dolocationid bigint, trip_distance double, "
    "total_amount double, service_type string, provider string, ano_mes string"
)


def trips(spark):
    t = [datetime(2023, 5, d) for d in (1, 2, 3, 4)]
    return spark.createDataFrame(
        [
            (t[0], 1, 10, 1.0, 10.1, "yellow", "yellow", "202305"),
            (t[1], 1, 10, None, 20.2, "yellow", "yellow", "202305"),
            (t[2], None, 11, 3.0, None, "yellow", "yellow", "202305"),
            (t[3], 2, 11, None, None, "fhv", "fhv", "202305"),
        ],
        TRIPS,
    )


@pytest.mark.parametrize("scale", [None, 2])
def test_monthly_aggregate(spark, either_mode, scale):
    out = monthly_aggregate(trips(spark), scale=scale)
    assert out.columns == MONTHLY_KEYS + MONTHLY_MEASURES
    got = {(r.service_type, r.pulocationid): tuple(r)[5:] for r in out.collect()}
    one, two, three, four = (datetime(2023, 5, d) for d in (1, 2, 3, 4))
    assert got[("yellow", 1)] == (2, 1, 1, 1.0, pytest.approx(30.3), 1.0, pytest.approx(15.15), 1.0, 20.2, one, two)
    assert got[("yellow", None)] == (1, 0, 1, 3.0, None, 3.0, None, 3.0, None, three, three)
    assert got[("fhv", 2)] == (1, 1, 1, None, None, None, None, None, None, four, four)


def test_distinct_places(spark):
    coarse = monthly_aggregate(trips(spark), ["ano_mes"]).first()
    assert (coarse.locais_embarque, coarse.locais_desembarque) == (2, 2)
    assert monthly_aggregate(trips(spark), ["ano_mes"], approximate=True).first().locais_embarque == 2
    assert "Expand" not in plan(monthly_aggregate(trips(spark)))


def test_exact_sums_do_not_depend_on_partitioning(spark):
    df = spark.range(20000).select(
        F.lit(datetime(2024, 1, 1)).alias("pickup_datetime"),
        F.lit(1).cast("bigint").alias("pulocationid"),
        F.lit(1).cast("bigint").alias("dolocationid"),
        (F.col("id") / 100).alias("trip_distance"),
        ((F.col("id") * 37 % 100000) / 100).alias("total_amount"),
        F.lit("s").alias("service_type"),
        F.lit("p").alias("provider"),
        F.lit("202401").alias("ano_mes"),
    )
    results = {tuple(monthly_aggregate(df.repartition(n), scale=2).first()) for n in (1, 3, 7)}
    assert len(results) == 1
    assert results.pop()[8] == sum(range(20000)) / 100


def test_means(spark):
    groups = spark.createDataFrame([("y", 10.0), ("y", 20.0), ("g", 99.0), ("y", None)], "s string, total double")
    assert rows(mean_of_group_totals(groups, "total", "m", F.col("s") == "y")) == [(15.0,)]
    months = monthly_mean(trips(spark), "pickup_datetime", "total_amount", "m")
    assert rows(months) == [("202305", pytest.approx(15.15))]
    with pytest.raises(AnalysisException):
        mean_of_group_totals(groups, "absent", "m")


def test_hourly_mean(spark):
    data = [(datetime(2023, 5, 1, 3), 1), (datetime(2022, 5, 9, 3), 4), (datetime(2023, 5, 1, 0), None), (datetime(2023, 6, 1, 3), 9)]
    df = spark.createDataFrame(data, "t timestamp_ntz, n bigint")
    assert [tuple(r) for r in hourly_mean(df, "t", "n", "m", 5).collect()] == [(0, None), (3, 2.5)]
    assert [tuple(r) for r in hourly_mean(df, "t", "n", "m", 5, 2023).collect()] == [(0, None), (3, 1.0)]
    assert [tuple(r) for r in hourly_mean(df, "t", "n", "m").collect()] == [(0, None), (3, pytest.approx(14 / 3))]
    absent = hourly_mean(df, "t", "zz", "m", 5)
    assert absent.collect() == [] and absent.schema.simpleString() == "struct<hora:int,m:double>"


def test_conform_and_labels(spark):
    df = spark.createDataFrame([("HV0002",), ("HV0003",), ("HV0004",), ("HV0005",), ("HV9999",), (None,)], "code string")
    labels = {"HV0002": "Juno", "HV0003": "Uber", "HV0004": "Via", "HV0005": "Lyft"}
    got = [r.p for r in df.select(code_label(F.col("code"), labels, "Other").alias("p")).collect()]
    assert got == ["Juno", "Uber", "Via", "Lyft", "Other", "Other"]
    assert {r.p for r in df.select(code_label(F.col("code"), {}, "Other").alias("p")).collect()} == {"Other"}
    out = conform(df, {"c": "CODE", "n": ("code", "int"), "z": typed_null("double"), "k": F.lit("k")})
    assert out.schema.simpleString() == "struct<c:string,n:int,z:double,k:string>"
    with pytest.raises(AnalysisException):
        conform(df, {"c": "nope"})
    both = union_all(out.select("c"), out.select("k", "c").limit(1), spark.createDataFrame([("x",)], "c string"))
    assert both.columns == ["c", "k"] and both.count() == 8


def feed_rows(spark, name, **values):
    schema = FEEDS[name].with_ntz().schema
    lower = [f.name.lower() for f in schema.fields]
    df = spark.createDataFrame([tuple(values.get(n) for n in lower)], schema)
    return df.toDF(*lower)


def test_gold_layout(spark):
    at = datetime(2023, 5, 6, 7)
    silver = {
        "yellow": feed_rows(spark, "yellow", tpep_pickup_datetime=at, total_amount=5.0, trip_distance=2.0, pulocationid=3),
        "green": feed_rows(spark, "green", lpep_pickup_datetime=at, total_amount=6.0),
        "fhv": feed_rows(spark, "fhv", pickup_datetime=at, dropoff_datetime=at, dolocationid=4),
        "hvfhv": feed_rows(spark, "hvfhv", pickup_datetime=at, hvfhs_license_num="HV0005", trip_miles=1.5, base_passenger_fare=7.0),
    }
    out = to_gold(silver)
    assert out.schema.simpleString() == (
        "struct<pickup_datetime:timestamp_ntz,dropoff_datetime:timestamp_ntz,pulocationid:bigint,dolocationid:bigint,"
        "trip_distance:double,total_amount:double,service_type:string,provider:string,ano_mes:string>"
    )
    assert rows(out) == sorted(
        [
            (at, None, 3, None, 2.0, 5.0, "yellow", "yellow", "202305"),
            (at, None, None, None, None, 6.0, "green", "green", "202305"),
            (at, at, None, 4, None, None, "fhv", "fhv", "202305"),
            (at, None, None, None, 1.5, 7.0, "hvfhv", "Lyft", "202305"),
        ],
        key=repr,
    )


def test_report(spark, tmp_path):
    monthly = spark.createDataFrame([("yellow", 10.0), ("yellow", 15.0), ("green", 1.0)], "service_type string, faturamento_total double")
    data = [(datetime(2023, 5, 1, 0), 1), (datetime(2023, 5, 1, 0), 2), (datetime(2023, 5, 1, 13), 1)]
    yellow = spark.createDataFrame(data, "tpep_pickup_datetime timestamp_ntz, passenger_count bigint")
    assert rows(report(monthly, yellow)) == [
        ("media_passageiros", "0", 1.5), ("media_passageiros", "13", 1.0), ("media_total_amount", "yellow", 12.5),
    ]
    write_report(report_lines(monthly, yellow), str(tmp_path / "report"))
    text = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert text == [
        "VALIDAÇÃO DAS MÉTRICAS ANALÍTICAS",
        "===============================",
        "",
        "[2] Média de total_amount dos Yellow Taxis: 12.5",
        "",
        "[3] Média de passageiros por hora do dia (maio):",
        "Hora 0: média = 1.50",
        "Hora 13: média = 1.00",
    ]
    without = report_lines(monthly, yellow.drop("passenger_count")).orderBy("line_no").collect()
    assert without[-1].line == "[3] Coluna passenger_count não disponível no dataset yellow."


def test_inspection_isolates_failures(spark):
    good = feed_rows(spark, "fhv", sr_flag=1)
    out = inspect_feeds({"fhv": good, "green": spark.range(1)})
    assert out["fhv"]["profile"].count() == 7 and out["fhv"]["first"].count() == 1
    assert isinstance(out["green"], AnalysisException)


def test_scaled_sums_lose_nothing(spark, either_mode):
    """Values that are no exact number of cents are summed as doubles; nothing wraps."""
    one = lambda values: spark.createDataFrame([(v,) for v in values], "x double").agg(aggregate._total("x", 2).alias("t"), aggregate._mean("x", 2).alias("m")).first()
    assert one([9e16] * 200).t == pytest.approx(1.8e19, rel=1e-12)
    assert math.isnan(one([1.0, float("nan"), 1e18, 2.0]).t)
    assert one([float("inf"), 1.0]).t == float("inf")
    assert tuple(one([0.1] * 10 + [-0.25, None])) == (0.75, 0.75 / 11)
    assert one([1e18, 1.5]).t == 1e18 + 1.5 and one([None]).t is None


def test_ranged_aggregate_is_one_narrow_shuffle(spark):
    trips = spark.range(4000).select(
        F.timestamp_seconds(F.lit(1682899200) + F.col("id") * 997).alias("pickup_datetime"),
        F.lit("not needed").alias("dropoff_datetime"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 41).alias("pulocationid"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("dolocationid"),
        (F.col("id") % 10 / 10).alias("trip_distance"),
        F.when(F.col("id") % 5 != 0, F.col("id") / 100).alias("total_amount"),
        F.when(F.col("id") % 3 < 5, F.concat(F.lit("f"), F.col("id") % 1)).alias("service_type"),
        F.concat(F.lit("p"), F.col("id") % 2).alias("provider"),
        F.when(F.col("id") % 2 == 0, F.lit("190001")).otherwise(F.concat(F.lit("20230"), (F.col("id") % 4).cast("string"))).alias("ano_mes"),
    )
    assert rows(monthly_aggregate_ranged(trips, 2)) == rows(monthly_aggregate(trips, scale=2))
    out = monthly_aggregate_ranged(trips.filter("ano_mes > '2'"), 2)
    text = plan(out)
    assert text.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in text
    months = out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("ano_mes").alias("low"), F.max("ano_mes").alias("high")).orderBy("low").collect()
    assert all(a.high <= b.low for a, b in zip(months, months[1:]))
