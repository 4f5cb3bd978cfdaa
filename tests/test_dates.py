from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException

from stratalake.operators import dates


def moments(spark, kind="timestamp_ntz"):
    values = [datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 1, 31), datetime(2024, 1, 31, 10), datetime(2024, 3, 10, 2, 30), None]
    return spark.createDataFrame([(v,) for v in values], f"t {kind}")


def test_year_month_and_parts(spark):
    df = dates.with_date_parts(dates.with_year_month(moments(spark), "t"), "T", "p_")
    assert rows(df.select("ano_mes", "p_ano", "p_mes", "p_dia")) == sorted(
        [("202312", 2023, 12, 31), ("202401", 2024, 1, 31), ("202401", 2024, 1, 31), ("202403", 2024, 3, 10), (None,) * 4], key=repr
    )
    with pytest.raises(AnalysisException):
        dates.with_year_month(df, "nope")


def test_wall_clock_months_do_not_depend_on_the_session_zone(spark, zone):
    test_year_month_and_parts(spark)


def test_stamps(spark):
    df = spark.range(1)
    out = dates.with_update_time(dates.with_ingestion_time(df, as_of="2024-01-02 03:04:05"), as_of=datetime(2024, 1, 1))
    assert out.columns == ["id", "data_ingestao", "data_atualizacao"]
    assert out.first()[1:] == (datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 1))
    now = dates.with_ingestion_time(df).first().data_ingestao
    assert now.year >= 2024


def test_parsing_gives_null_for_bad_text(spark, either_mode):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("x",), (None,)], "a string")
    assert [r.a for r in dates.parse_dates(df, "a").collect()] == [date(2024, 2, 29), None, None, None]
    out = dates.parse_timestamps(df, "a", "yyyy-MM-dd", into="t")
    assert [r.t for r in out.collect()] == [datetime(2024, 2, 29), None, None, None]
    assert out.columns == ["a", "t"]
    br = spark.createDataFrame([("31/12/2023 10:00",)], "a string")
    assert dates.parse_timestamps(br, "a", "dd/MM/yyyy HH:mm").first().a == datetime(2023, 12, 31, 10)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_date_range_end(spark, kind):
    df = moments(spark, kind)
    assert dates.in_date_range(df, "t", "2024-01-31", "2024-01-31").count() == 1
    assert dates.in_date_range(df, "t", "2024-01-31", "2024-01-31", whole_days=True).count() == 2
    assert dates.in_date_range(df, "t", "2023-12-31", "2024-01-31", whole_days=True).count() == 3


def test_date_range_on_dates(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    assert dates.in_date_range(df, "d", "2024-01-01", "2024-01-02").count() == 2
    assert dates.in_date_range(df, "d", "2024-01-01", "2024-01-02", whole_days=True).count() == 2


def test_month_filter(spark):
    assert dates.in_month(moments(spark), "t", 1).count() == 2
    assert dates.in_month(moments(spark), "t", 12, 2023).count() == 1
    assert dates.in_month(moments(spark), "t", 12, 2024).count() == 0


def test_ranges_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for df in (
        dates.in_date_range(events, "ts", "2024-01-05", "2024-01-06", whole_days=True),
        dates.in_month(events, "ts", 1, 2024),
    ):
        text = plan(df)
        assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
