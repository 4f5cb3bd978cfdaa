"""Roll-ups from published states, states kept up to date by changes, and sums of odd values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.aggregates import LINE_TRIPS_SQL
from queries.feeds import BY_MONTH, RAW_SQL, gold_sql, gold_trips, monthly_sql, ntz_feed, raw_feed, silver, silver_sql
from queries.registry import query, table
from stratalake.fixed import MONTHLY_KEYS
from stratalake.operators.aggregate import monthly_aggregate
from stratalake.operators.rollup import SIGN, maintained_states, place_bitmaps, roll_up, states_to_monthly, trip_states, upsert_images
from stratalake.operators.upsert import upsert
from stratalake.plans.gold import to_gold
from stratalake.plans.silver import to_silver
from stratalake.sources.storage import shared_dir
from stratalake.sources.tables import publish, read_table


def published(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    publish(df, path)
    return read_table(df.sparkSession, path, df.schema)


@query("gold_by_month_from_monthly", monthly_sql(gold_sql(RAW_SQL), BY_MONTH))
def gold_by_month_from_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coarser aggregate from what is published beside the monthly one: no trip is read."""
    states = published(trip_states(gold_trips(spark, sf_dir)), "states")
    bitmaps = published(place_bitmaps(states, ["ano_mes", "service_type", "provider"]), "bitmaps")
    return roll_up(states, bitmaps, BY_MONTH)


# A second delivery of the green feed: half of the orders with another amount, some at another minute, some without a distance.
AGAIN = {
    "total_amount": "case when o_orderkey % 4 = 0 then o_totalprice + 1 when o_orderkey % 4 = 2 then o_totalprice - 1000 else o_totalprice end",
    "trip_distance": "case when o_orderkey % 6 = 0 then null else cast(o_custkey % 40 as double) end",
    "VendorID": "case when o_orderkey % 10 = 0 then 9 else o_custkey % 2 + 1 end",
}


def again_sql() -> str:
    source = silver_sql("green", "(SELECT * FROM orders WHERE o_orderkey % 2 = 0)", AGAIN)
    keys = "s.vendorid IS NOT DISTINCT FROM t.vendorid AND s.lpep_pickup_datetime IS NOT DISTINCT FROM t.lpep_pickup_datetime"
    return f"""WITH t AS ({silver_sql("green")}), s AS ({source}) SELECT * FROM s
        UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {keys})"""


@query("gold_by_deltas", monthly_sql(gold_sql({"green": again_sql()})))
def gold_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly states that take in the before- and after-images of an upsert."""
    feed = ntz_feed("green")
    before = silver(spark, sf_dir, "green")
    given = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0")
    source = to_silver(raw_feed(spark, sf_dir, "green", given, AGAIN), feed, F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"))
    states = published(trip_states(to_gold({"green": before})), "states")
    images = upsert_images(before, source, feed.keys)
    signed = to_gold({"green": images.filter(f"{SIGN} > 0")}).withColumn(SIGN, F.lit(1)).unionByName(to_gold({"green": images.filter(f"{SIGN} < 0")}).withColumn(SIGN, F.lit(-1)))
    current = published(upsert(before, source, feed.keys, source_unique=True), "silver")
    return states_to_monthly(maintained_states(states, published(signed, "images"), to_gold({"green": current})))


# Distances that are no numbers or too large for whole units, here and there.
ODD = "CASE WHEN l_orderkey % 401 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_orderkey % 397 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN l_orderkey % 101 = 0 THEN 1e18 ELSE l_quantity END"
ODD_TRIPS = LINE_TRIPS_SQL.replace("l_quantity AS trip_distance", f"{ODD} AS trip_distance")
KIND = "CASE WHEN isnan({c}) THEN 'nan' WHEN abs({c}) = CAST('Infinity' AS DOUBLE) THEN 'infinite' ELSE 'number' END"
FINITE = "CASE WHEN isnan({c}) OR abs({c}) = CAST('Infinity' AS DOUBLE) THEN NULL ELSE {c} END"


def _odd_columns(c: str) -> str:
    return f"{KIND.format(c=c)} AS {c}_kind, {FINITE.format(c=c)} AS {c}"


ODD_OUT = f"ano_mes, service_type, provider, qtd_corridas, {_odd_columns('distancia_total')}, {_odd_columns('max_distancia')}"


@query(
    "gold_monthly_odd_values",
    f"""SELECT {ODD_OUT} FROM (
        SELECT ano_mes, service_type, provider, count(*) AS qtd_corridas, max(trip_distance) AS max_distancia,
               coalesce(CAST(sum(CASE WHEN abs(trip_distance) < 1e13 THEN CAST(trip_distance AS DECIMAL(18,2)) END) AS DOUBLE), 0)
               + coalesce(sum(CASE WHEN abs(trip_distance) < 1e13 THEN NULL ELSE trip_distance END), 0) AS distancia_total
        FROM ({ODD_TRIPS}) GROUP BY ano_mes, service_type, provider)""",
)
def gold_monthly_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not finite and very large distances: sums by whole units lose nothing."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_shipdate as pickup_datetime", "nullif(l_partkey % 50, 0) as pulocationid", "l_suppkey as dolocationid", f"{ODD} as trip_distance",
        "l_extendedprice as total_amount", "l_returnflag as service_type", "l_linestatus as provider", "date_format(l_shipdate, 'yyyyMM') as ano_mes",
    )
    return monthly_aggregate(rows, ["ano_mes", "service_type", "provider"], scale=2).selectExpr(*_split(ODD_OUT))


def _split(columns: str) -> list[str]:
    """The columns of a select list without commas inside its expressions' parentheses."""
    out, depth = [""], 0
    for ch in columns:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [o.strip() for o in out]


PLAIN = ["distancia_total", "faturamento_total", "media_distancia", "media_valor"]


@query("gold_monthly_plain", f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in PLAIN)}) FROM ({monthly_sql(LINE_TRIPS_SQL)})")
def gold_monthly_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain double sums and means, rounded."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_shipdate as pickup_datetime", "nullif(l_partkey % 50, 0) as pulocationid", "l_suppkey as dolocationid", "l_quantity as trip_distance",
        "l_extendedprice as total_amount", "l_returnflag as service_type", "l_linestatus as provider", "date_format(l_shipdate, 'yyyyMM') as ano_mes",
    )
    return monthly_aggregate(rows, MONTHLY_KEYS).withColumns({c: F.round(c, 4) for c in PLAIN})
