"""The jobs: same layers as the functions, status by feeds that failed, usable again and again."""

from datetime import datetime

import pytest
from conftest import rows

from stratalake import jobs
from stratalake.plans.gold import read_gold_monthly
from stratalake.sources.feeds import FEEDS


def deliver(spark, path, feed, **values):
    schema = FEEDS[feed].schema
    spark.createDataFrame([tuple(values.get(c) for c in schema.names)], schema).coalesce(1).write.mode("append").parquet(path)


def test_layers_report_and_inspection(spark, tmp_path, capsys):
    lake, out, look = (str(tmp_path / n) for n in ("lake", "report", "look"))
    yellow, green = str(tmp_path / "yellow"), str(tmp_path / "green")
    at = datetime(2023, 5, 3, 8)
    deliver(spark, yellow, "yellow", VendorID=1, tpep_pickup_datetime=at, total_amount=10.0, passenger_count=2, PULocationID=1, DOLocationID=1)
    spark.createDataFrame([(1,)], "VendorID int").coalesce(1).write.parquet(green)
    given = ["layers", "--lake", lake, "--scale", "2", "--count-quality", f"yellow={yellow}"]
    for _ in range(2):
        assert jobs.main(given, spark) == 0
        assert rows(read_gold_monthly(spark, f"{lake}/gold/monthly").select("service_type", "qtd_corridas", "faturamento_total")) == [("yellow", 1, 10.0)]
    assert rows(spark.read.parquet(f"{lake}/quality").select("feed").distinct()) == [("yellow",)]
    assert jobs.main([*given, f"green={green}"], spark) == 1
    assert "green" in capsys.readouterr().err
    assert jobs.main(["report", "--lake", lake, "--out", out, "--month", "5"], spark) == 0
    text = [r.value for r in spark.read.text(out).collect()]
    assert any(line.endswith("10.0") for line in text) and len(text) == 7
    assert jobs.main(["inspect", "--out", look, f"yellow={yellow}", f"green={tmp_path}/nothing"], spark) == 1
    assert spark.read.json(f"{look}/yellow/schema").count() == len(FEEDS["yellow"].schema)
    assert spark.read.json(f"{look}/yellow/profile").count() > 0


@pytest.mark.parametrize("argv", [[], ["layers", "--lake", "x"], ["layers", "--lake", "x", "red=y"], ["layers", "--lake", "x", "yellow"], ["report", "--lake", "x", "--out", "y", "--month", "13"]])
def test_bad_arguments(argv):
    with pytest.raises(SystemExit):
        jobs.arguments(argv)
