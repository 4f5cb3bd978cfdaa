"""Aggregates on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.feeds import monthly_sql
from queries.registry import query, table
from stratalake.fixed import YEAR_MONTH
from stratalake.operators.aggregate import hourly_mean, mean_of_group_totals, monthly_aggregate, monthly_mean
from stratalake.operators.conform import conform, union_all
from stratalake.operators.dates import with_year_month

LINE_TRIPS_SQL = """SELECT l_shipdate AS pickup_datetime, nullif(l_partkey % 50, 0) AS pulocationid,
    l_suppkey AS dolocationid, l_quantity AS trip_distance, l_extendedprice AS total_amount,
    l_returnflag AS service_type, l_linestatus AS provider, strftime(l_shipdate, '%Y%m') AS ano_mes FROM lineitem"""


@query("gold_by_location", monthly_sql(LINE_TRIPS_SQL))
def gold_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = conform(
        table(spark, sf_dir, "lineitem"),
        {
            "pickup_datetime": "l_shipdate",
            "pulocationid": F.expr("nullif(l_partkey % 50, 0)"),
            "dolocationid": "l_suppkey",
            "trip_distance": "l_quantity",
            "total_amount": "l_extendedprice",
            "service_type": "l_returnflag",
            "provider": "l_linestatus",
        },
    )
    return monthly_aggregate(with_year_month(trips, "pickup_datetime"), scale=2)


@query(
    "mean_of_customer_totals",
    """SELECT CAST(sum(total) AS DOUBLE) / count(*) AS mean_total FROM
       (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey)""",
)
def mean_of_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )
    return mean_of_group_totals(totals, "total", "mean_total", scale=2)


@query(
    "monthly_mean",
    """SELECT strftime(o_orderdate, '%Y%m') AS ano_mes,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS mean_price
       FROM orders GROUP BY 1""",
)
def monthly_mean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_mean(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "mean_price", YEAR_MONTH, scale=2)


@query(
    "hourly_mean",
    """SELECT CAST(hour(ts) AS BIGINT) AS hora, CAST(sum(user_id) AS DOUBLE) / count(user_id) AS mean_user
       FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00' GROUP BY 1""",
)
def hourly_mean_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hourly_mean(table(spark, sf_dir, "events"), "ts", "user_id", "mean_user", 1, 2024, scale=0)
    return df.withColumn("hora", F.col("hora").cast("bigint"))


ALL_SQL = """SELECT ts AS moment, user_id AS passengers FROM events
    UNION ALL SELECT l_shipdate + to_minutes(l_orderkey % 1440), l_suppkey FROM lineitem"""


@query(
    "hourly_mean_all",
    f"""SELECT CAST(hour(moment) AS BIGINT) AS hora, CAST(sum(passengers) AS DOUBLE) / count(passengers) AS mean_passengers
        FROM ({ALL_SQL}) WHERE month(moment) = 1 GROUP BY 1""",
)
def hourly_mean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = conform(table(spark, sf_dir, "events"), {"moment": "ts", "passengers": "user_id"})
    minutes = F.expr("l_shipdate + make_dt_interval(0, 0, cast(l_orderkey % 1440 as int))")
    lines = conform(table(spark, sf_dir, "lineitem"), {"moment": minutes, "passengers": "l_suppkey"})
    df = hourly_mean(union_all(events, lines), "moment", "passengers", "mean_passengers", 1, scale=0)
    return df.withColumn("hora", F.col("hora").cast("bigint"))


@query(
    "hourly_mean_absent_column",
    "SELECT CAST(0 AS BIGINT) AS hora, CAST(0 AS DOUBLE) AS mean_value FROM events WHERE false",
)
def hourly_mean_absent_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hourly_mean(table(spark, sf_dir, "events"), "ts", "passenger_count", "mean_value", 1)
    return df.withColumn("hora", F.col("hora").cast("bigint"))
