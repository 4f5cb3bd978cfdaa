"""Trip feeds derived from the given tables, and the silver and gold queries.

Every feed is a projection of a whole table. Its columns are stated once, as
expressions both engines read the same way; the two dialects differ only in
how minutes are added. Nulls, padding and mixed case are put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.registry import query, table
from stratalake.fixed import MONTHLY_KEYS
from stratalake.operators.aggregate import monthly_aggregate, monthly_aggregate_ranged
from stratalake.operators.schema import enforce_schema, lower_names
from stratalake.plans.gold import to_gold
from stratalake.plans.inspect import inspect
from stratalake.plans.report import hourly_answer, report, report_lines, total_answer
from stratalake.plans.silver import cleaned, to_silver, to_silver_by_month
from stratalake.sources.feeds import FEEDS

AS_OF = "2024-06-01 00:00:00"


def plus(base: str, minutes: str) -> tuple[str, str]:
    """``base`` plus minutes, as (Spark, DuckDB) text."""
    return (
        f"{base} + make_dt_interval(0, 0, cast({minutes} as int))",
        f"{base} + to_minutes(cast({minutes} as bigint))",
    )


def missing_if(test: str, pair: tuple[str, str]) -> tuple[str, str]:
    return tuple(f"case when {test} then null else {text} end" for text in pair)


SOURCES = {"yellow": "lineitem", "green": "orders", "fhv": "events", "hvfhv": "lineitem"}
RAW: dict[str, dict[str, str | tuple[str, str]]] = {
    "yellow": {
        "VendorID": "nullif(l_suppkey % 7, 0)",
        "tpep_pickup_datetime": missing_if("l_orderkey % 97 = 0", plus("l_shipdate", "l_orderkey % 1440")),
        "tpep_dropoff_datetime": missing_if("l_partkey % 53 = 0", plus("l_shipdate", "l_orderkey % 1440 + l_quantity")),
        "passenger_count": "nullif(cast(l_linenumber as bigint), 7)",
        "trip_distance": "nullif(l_quantity, 13)",
        "RatecodeID": "l_suppkey % 6",
        "store_and_fwd_flag": "'  ' || lower(nullif(l_returnflag, 'N')) || ' '",
        "PULocationID": "l_partkey % 265",
        "DOLocationID": "nullif(l_suppkey % 265, 3)",
        "payment_type": "cast(l_linenumber as bigint)",
        "fare_amount": "cast(cast(l_quantity as bigint) as varchar(20))",
        "extra": "l_tax",
        "mta_tax": "l_discount",
        "tip_amount": "nullif(l_tax, 0.05)",
        "tolls_amount": "nullif(l_discount, 0.05)",
        "improvement_surcharge": "l_quantity",
        "total_amount": "nullif(l_extendedprice, 0.0)",
        "congestion_surcharge": "nullif(l_quantity, 2)",
        "Airport_fee": "nullif(l_quantity, 3)",
    },
    "green": {
        "VendorID": "o_custkey % 2 + 1",
        "lpep_pickup_datetime": plus("o_orderdate", "o_custkey % 1440"),
        "lpep_dropoff_datetime": missing_if("o_orderkey % 31 = 0", plus("o_orderdate", "o_custkey % 1440 + 20")),
        "store_and_fwd_flag": "nullif(o_orderstatus, 'F')",
        "RatecodeID": "o_orderkey % 6",
        "PULocationID": "o_custkey % 265",
        "DOLocationID": "nullif(o_orderkey % 265, 7)",
        "passenger_count": "nullif(o_orderkey % 6, 0)",
        "trip_distance": "cast(nullif(o_custkey % 40, 0) as double)",
        "fare_amount": "o_totalprice",
        "extra": "cast(o_orderkey % 3 as double)",
        "mta_tax": "cast(o_orderkey % 2 as double)",
        "tip_amount": "cast(o_custkey % 9 as double)",
        "tolls_amount": "cast(nullif(o_custkey % 5, 0) as double)",
        "ehail_fee": "cast(null as double)",
        "improvement_surcharge": "cast(o_orderkey % 4 as double)",
        "total_amount": "o_totalprice",
        "payment_type": "o_orderkey % 5",
        "trip_type": "nullif(o_orderkey % 3, 0)",
        "congestion_surcharge": "cast(nullif(o_orderkey % 7, 0) as double)",
    },
    "fhv": {
        "dispatching_base_num": "' ' || event_type",
        "pickup_datetime": missing_if("event_id % 89 = 0", ("ts", "ts")),
        "dropOff_datetime": missing_if("event_id % 17 = 0", plus("ts", "event_id % 90")),
        "PUlocationID": "nullif(user_id % 265, 0)",
        "DOlocationID": "nullif(event_id % 265, 0)",
        "SR_Flag": "nullif(event_id % 5, 0)",
        "Affiliated_base_number": "nullif(event_type, 'click') || '  '",
    },
    "hvfhv": {
        "hvfhs_license_num": "'HV000' || nullif(cast(l_linenumber as varchar(2)), '6')",
        "dispatching_base_num": "' b' || l_linestatus",
        "originating_base_num": "nullif(l_returnflag, 'R')",
        "request_datetime": plus("l_shipdate", "l_partkey % 1440 - 9"),
        "on_scene_datetime": missing_if("l_suppkey % 3 = 0", plus("l_shipdate", "l_partkey % 1440 - 2")),
        "pickup_datetime": plus("l_shipdate", "l_partkey % 1440"),
        "dropoff_datetime": plus("l_shipdate", "l_partkey % 1440 + l_quantity"),
        "PULocationID": "l_partkey % 265",
        "DOLocationID": "l_suppkey % 265",
        "trip_miles": "l_quantity",
        "trip_time": "cast(l_quantity as bigint) * 60",
        "base_passenger_fare": "nullif(l_extendedprice, 0.0)",
        "tolls": "nullif(l_tax, 0.01)",
        "bcf": "l_discount",
        "sales_tax": "l_tax",
        "congestion_surcharge": "nullif(l_tax, 0.02)",
        "airport_fee": "nullif(l_tax, 0.03)",
        "tips": "l_discount",
        "driver_pay": "l_quantity",
        "shared_request_flag": "l_returnflag",
        "shared_match_flag": "lower(l_linestatus)",
        "access_a_ride_flag": "nullif(l_linestatus, 'O')",
        "wav_request_flag": "' n '",
        "wav_match_flag": "l_returnflag || l_linestatus",
    },
}


def raw_feed(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None, changed: dict[str, str] | None = None) -> DataFrame:
    """The feed from its whole table, or from ``rows`` of it, with some columns ``changed``."""
    exprs = [f"{e if isinstance(e, str) else e[0]} as {c}" for c, e in {**RAW[name], **(changed or {})}.items()]
    return (table(spark, sf_dir, SOURCES[name]) if rows is None else rows).selectExpr(*exprs)


def raw_sql(name: str, rows: str | None = None, changed: dict[str, str] | None = None) -> str:
    exprs = ", ".join(f"{e if isinstance(e, str) else e[1]} AS {c}" for c, e in {**RAW[name], **(changed or {})}.items())
    return f"SELECT {exprs} FROM {rows or SOURCES[name]}"


# DuckDB text of the cleaning rules, by declared type.
CLEAN_SQL = {
    "string": "coalesce(trim(upper({c}), ' '), 'desconhecido')",
    "double": "coalesce({c}, 0.0)",
    "timestamp_ntz": "coalesce({c}, TIMESTAMP '1900-01-01 00:00:00')",
    "bigint": "{c}",
}


def ntz_feed(name: str):
    return FEEDS[name].with_ntz()


def silver_sql(name: str, rows: str | None = None, changed: dict[str, str] | None = None) -> str:
    feed = ntz_feed(name)
    fields = [(f.name, f.name.lower(), f.dataType.simpleString()) for f in feed.schema.fields]
    clean = ", ".join(f"{CLEAN_SQL[t].format(c=c)} AS {low}" for c, low, t in fields)
    rest = ", ".join(f"{low} DESC NULLS LAST" for _, low, _ in fields if low not in feed.keys)
    return f"""
        SELECT *, TIMESTAMP '{AS_OF}' AS data_ingestao, strftime({feed.pickup}, '%Y%m') AS ano_mes
        FROM (SELECT {clean} FROM ({raw_sql(name, rows, changed)}))
        QUALIFY row_number() OVER (PARTITION BY {", ".join(feed.keys)} ORDER BY {rest}) = 1
    """


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return to_silver(raw_feed(spark, sf_dir, name), ntz_feed(name), as_of)


def _register_silver(name: str) -> None:
    query(f"silver_{name}", silver_sql(name))(lambda spark, sf_dir: silver(spark, sf_dir, name))


for _name in FEEDS:
    _register_silver(_name)


def typed_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All feeds with declared types and lower-case names, not yet cleaned."""
    return {n: lower_names(enforce_schema(raw_feed(spark, sf_dir, n), ntz_feed(n).schema)) for n in FEEDS}


def gold_part(service: str, body: str, columns: tuple[str, str, str, str], provider: str) -> str:
    pickup, dropoff, distance, amount = columns
    return f"""
        SELECT {pickup} AS pickup_datetime, {dropoff} AS dropoff_datetime, pulocationid AS pulocationid,
               dolocationid AS dolocationid, CAST({distance} AS DOUBLE) AS trip_distance,
               CAST({amount} AS DOUBLE) AS total_amount, '{service}' AS service_type, {provider} AS provider,
               strftime({pickup}, '%Y%m') AS ano_mes
        FROM ({body})"""


def gold_sql(bodies: dict[str, str]) -> str:
    """The trips table in SQL, over one text per feed."""
    licence = """CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber'
        WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' ELSE 'Other' END"""
    yellow = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "total_amount")
    green = ("lpep_pickup_datetime", "lpep_dropoff_datetime", "trip_distance", "total_amount")
    fhv = ("pickup_datetime", "dropoff_datetime", "NULL", "NULL")
    hvfhv = ("pickup_datetime", "dropoff_datetime", "trip_miles", "base_passenger_fare")
    feeds = {"yellow": (yellow, "'yellow'"), "green": (green, "'green'"), "fhv": (fhv, "'fhv'"), "hvfhv": (hvfhv, licence)}
    return " UNION ALL ".join(gold_part(name, bodies[name], *given) for name, given in feeds.items() if name in bodies)


def monthly_sql(trips: str, keys: list[str] = MONTHLY_KEYS) -> str:
    def total(c: str) -> str:
        return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"

    return f"""
        SELECT {", ".join(keys)}, count(*) AS qtd_corridas,
               count(DISTINCT pulocationid) AS locais_embarque, count(DISTINCT dolocationid) AS locais_desembarque,
               {total("trip_distance")} AS distancia_total, {total("total_amount")} AS faturamento_total,
               {total("trip_distance")} / count(trip_distance) AS media_distancia,
               {total("total_amount")} / count(total_amount) AS media_valor,
               max(trip_distance) AS max_distancia, max(total_amount) AS max_valor,
               min(pickup_datetime) AS min_data, max(pickup_datetime) AS max_data
        FROM ({trips}) GROUP BY {", ".join(keys)}"""


RAW_SQL = {name: raw_sql(name) for name in FEEDS}
SILVER_SQL = {name: silver_sql(name) for name in FEEDS}


@query("gold_trips", gold_sql(RAW_SQL))
def gold_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(typed_feeds(spark, sf_dir))


@query("gold_monthly", monthly_sql(gold_sql(RAW_SQL)))
def gold_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_aggregate(gold_trips(spark, sf_dir), scale=2)


@query("gold_monthly_from_silver", monthly_sql(gold_sql(SILVER_SQL)))
def gold_monthly_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds before the removal of repeats say which groups are frequent."""
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    raw = {n: raw_feed(spark, sf_dir, n) for n in FEEDS}
    unique = {n: to_silver_by_month(df, ntz_feed(n), as_of) for n, df in raw.items()}
    like = to_gold({n: cleaned(df, ntz_feed(n)) for n, df in raw.items()})
    return monthly_aggregate_ranged(to_gold(unique), scale=2, like=like)


BY_MONTH = ["ano_mes", "service_type"]


@query("gold_by_month", monthly_sql(gold_sql(RAW_SQL), BY_MONTH))
def gold_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarser keys, so the two place counts are true distinct counts."""
    return monthly_aggregate(gold_trips(spark, sf_dir), BY_MONTH, scale=2)


HOURS_SQL = """SELECT CAST(hour(tpep_pickup_datetime) AS BIGINT) AS hora, avg(passenger_count) AS media_passageiros
    FROM ({yellow}) WHERE month(tpep_pickup_datetime) = 5 GROUP BY 1"""


@query("hourly_passengers", HOURS_SQL.format(yellow=SILVER_SQL["yellow"]))
def hourly_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_answer(silver(spark, sf_dir, "yellow")).withColumn("hora", F.col("hora").cast("bigint"))


TOTAL_SQL = f"""SELECT CAST(sum(CAST(faturamento_total AS DECIMAL(18,2))) AS DOUBLE) / count(faturamento_total)
    AS media_total_amount FROM ({monthly_sql(gold_sql(RAW_SQL))}) WHERE service_type = 'yellow'"""


@query("mean_of_group_totals", TOTAL_SQL)
def mean_of_yellow_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_answer(gold_monthly(spark, sf_dir), scale=2)


HOURS_IN_MAY = HOURS_SQL.format(yellow=SILVER_SQL["yellow"])


@query(
    "report_rows",
    f"""SELECT 'media_total_amount' AS metric, 'yellow' AS key, media_total_amount AS value FROM ({TOTAL_SQL})
        UNION ALL SELECT 'media_passageiros', CAST(hora AS VARCHAR), media_passageiros FROM ({HOURS_IN_MAY})""",
)
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(gold_monthly(spark, sf_dir), silver(spark, sf_dir, "yellow"), scale=2)


@query(
    "report_text",
    f"""SELECT 1 AS line_no, 'VALIDAÇÃO DAS MÉTRICAS ANALÍTICAS' AS line UNION ALL SELECT 2, '==============================='
        UNION ALL SELECT 3, '' UNION ALL SELECT 5, ''
        UNION ALL SELECT 4, '[2] Média de total_amount dos Yellow Taxis: ' || CAST(media_total_amount AS VARCHAR) FROM ({TOTAL_SQL})
        UNION ALL SELECT 6, '[3] Média de passageiros por hora do dia (maio):'
        UNION ALL SELECT 7 + hora, printf('Hora %d: média = %.2f', hora, media_passageiros) FROM ({HOURS_IN_MAY})""",
)
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = report_lines(gold_monthly(spark, sf_dir), silver(spark, sf_dir, "yellow"), scale=2)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


@query(
    "inspect_fhv",
    f"""WITH raw AS ({raw_sql("fhv")}) """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS type, count({c}) AS n_values, count(*) - count({c}) AS n_nulls,
            {f"round(avg({c}), 3)" if number else "CAST(NULL AS DOUBLE)"} AS mean,
            {f"round(stddev({c}), 3)" if number else "CAST(NULL AS DOUBLE)"} AS stddev,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM raw"""
        for c, kind, number in (
            ("dispatching_base_num", "string", False),
            ("pickup_datetime", "timestamp_ntz", False),
            ("dropOff_datetime", "timestamp_ntz", False),
            ("PUlocationID", "bigint", True),
            ("DOlocationID", "bigint", True),
            ("SR_Flag", "bigint", True),
            ("Affiliated_base_number", "string", False),
        )
    ),
)
def inspect_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile an inspection of landing data gives."""
    out = inspect(raw_feed(spark, sf_dir, "fhv"), ntz_feed("fhv").schema)["profile"]
    return out.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3)})
