"""Schema, cleaning and date queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from queries.registry import query, table
from stratalake.operators import clean, dates
from stratalake.operators.quality import profile, quality_report
from stratalake.operators.schema import cast_via_string, enforce_schema, lower_names

# Orders with missing values put in; the same text runs in both engines.
HOLES = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "nullif(o_custkey, 7)",
    "o_orderstatus": "nullif(o_orderstatus, 'F')",
    "o_totalprice": "case when o_orderkey % 5 = 0 then null else o_totalprice end",
    "o_orderdate": "case when o_orderkey % 13 = 0 then null else o_orderdate end",
    "o_orderpriority": "case when o_custkey % 3 = 0 then '  ' || lower(o_orderpriority) || ' ' else o_orderpriority end",
    "items": "cast(nullif(o_orderkey % 4, 0) as int)",
    "due": "case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end",
}
HOLES_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in HOLES.items()) + " FROM orders"


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {c}" for c, e in HOLES.items()])


@query(
    "fill_nulls",
    f"""SELECT * REPLACE (coalesce(o_orderstatus, 'desconhecido') AS o_orderstatus,
                          coalesce(o_orderpriority, 'desconhecido') AS o_orderpriority) FROM ({HOLES_SQL})""",
)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_nulls(holes(spark, sf_dir), ["o_orderstatus", "o_orderpriority"], "string")


@query(
    "fill_by_type",
    f"""SELECT * REPLACE (coalesce(o_totalprice, -1.0) AS o_totalprice, coalesce(items, 0) AS items,
                          coalesce(due, DATE '1900-01-01') AS due) FROM ({HOLES_SQL})""",
)
def fill_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = clean.fill_by_type(holes(spark, sf_dir), "double", -1.0)
    return clean.fill_by_type(clean.fill_by_type(df, "int"), "date")


@query("trim_strings", "SELECT p_partkey, trim(p_name, ' ') AS p_name, p_brand, p_type FROM part")
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    padded = part.withColumns({c: F.concat(F.lit("  "), c, F.lit(" ")) for c in ("p_name", "p_brand", "p_type")})
    return clean.trim_strings(padded)


@query(
    "lower_names_upper_values",
    "SELECT c_custkey, upper(c_name) AS c_name, c_acctbal, upper(c_mktsegment) AS c_mktsegment FROM customer",
)
def lower_names_upper_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").toDF("C_CustKey", "C_Name", "C_NationKey", "C_AcctBal", "C_MktSegment")
    return clean.upper_strings(lower_names(df.drop("C_NationKey")))


@query("to_utc", "SELECT event_id, ts + INTERVAL 3 HOUR AS ts FROM events")
def to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.to_utc(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts"], "-03:00")


@query(
    "standard_clean",
    f"""SELECT o_orderkey, o_custkey, coalesce(trim(o_orderstatus, ' '), 'desconhecido') AS o_orderstatus,
               coalesce(o_totalprice, 0.0) AS o_totalprice,
               coalesce(o_orderdate, TIMESTAMP '1900-01-01 00:00:00') AS o_orderdate,
               coalesce(trim(o_orderpriority, ' '), 'desconhecido') AS o_orderpriority,
               coalesce(items, 0) AS items, coalesce(due, DATE '1900-01-01') AS due FROM ({HOLES_SQL})""",
)
def standard_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.standard_clean(holes(spark, sf_dir))


# Events as texts, some of them not convertible.
TEXTS = {
    "event_id": "case when event_id % 7 = 0 then 'n/a' when event_id % 5 = 0 "
    "then cast(event_id as varchar(20)) || '.9' else cast(event_id as varchar(20)) end",
    "user_id": "cast(user_id as varchar(20)) || '.0'",
    "VALUE": "case when event_id % 9 = 0 then '' else cast(cast(event_id as decimal(12,2)) as varchar(20)) end",
    "day": "case when event_id % 4 = 0 then '2024-13-45' else cast(cast(ts as date) as varchar(10)) end",
    "event_type": "event_type",
}
TEXTS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in TEXTS.items()) + " FROM events"


@query(
    "schema_cast",
    f"""SELECT CAST(trunc(TRY_CAST(event_id AS DOUBLE)) AS BIGINT) AS event_id,
               CAST(trunc(TRY_CAST(user_id AS DOUBLE)) AS BIGINT) AS user_id,
               TRY_CAST("VALUE" AS DOUBLE) AS value, TRY_CAST(day AS DATE) AS day, event_type FROM ({TEXTS_SQL})""",
)
def schema_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "events").selectExpr(*[f"{e} as {c}" for c, e in TEXTS.items()])
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, value double, day date, event_type string")
    return enforce_schema(texts, schema)


@query(
    "cast_via_string",
    """SELECT l_orderkey, CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
              CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice, l_returnflag, l_shipdate FROM lineitem""",
)
def cast_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = "l_orderkey bigint, l_quantity bigint, l_extendedprice bigint, l_returnflag string, l_shipdate timestamp_ntz"
    return cast_via_string(table(spark, sf_dir, "lineitem"), T.StructType.fromDDL(ddl))


@query("year_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS ano_mes FROM orders")
def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.with_year_month(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "ano_mes")


@query(
    "date_parts",
    "SELECT o_orderkey, year(o_orderdate) AS o_ano, month(o_orderdate) AS o_mes, day(o_orderdate) AS o_dia FROM orders",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dates.with_date_parts(table(spark, sf_dir, "orders"), "o_orderdate", "o_")
    return df.select("o_orderkey", *[F.col(c).cast("bigint").alias(c) for c in ("o_ano", "o_mes", "o_dia")])


STAMP = "TIMESTAMP_NTZ '2024-06-01 12:00:00'"


@query(
    "audit_times",
    """SELECT r_regionkey, r_name, TIMESTAMP '2024-06-01 12:00:00' AS data_ingestao,
              TIMESTAMP '2024-06-01 12:00:00' AS data_atualizacao FROM region""",
)
def audit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dates.with_ingestion_time(table(spark, sf_dir, "region"), as_of=F.expr(STAMP))
    return dates.with_update_time(df, as_of=F.expr(STAMP))


DAY_TEXT = """case when o_orderkey % 11 = 0 then 'soon' when o_orderkey % 7 = 0 then '1999-02-30'
              else cast(cast(o_orderdate as date) as varchar(10)) end"""


@query(
    "parse_dates",
    f"""SELECT o_orderkey, day_text, CAST(try_strptime(day_text, '%Y-%m-%d') AS DATE) AS day,
               try_strptime(day_text || ' 10:20:30', '%Y-%m-%d %H:%M:%S') AS moment
        FROM (SELECT o_orderkey, {DAY_TEXT} AS day_text FROM orders)""",
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DAY_TEXT} as day_text")
    df = dates.parse_dates(df, "day_text", into="day").withColumn("moment", F.expr("day_text || ' 10:20:30'"))
    return dates.parse_timestamps(df, "moment", ntz=True)


@query(
    "date_range",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'",
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.in_date_range(table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-20")


@query(
    "date_range_whole_days",
    "SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def date_range_whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.in_date_range(table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-20", whole_days=True)


@query("month_filter", "SELECT * FROM orders WHERE month(o_orderdate) = 5")
def month_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.in_month(table(spark, sf_dir, "orders"), "o_orderdate", 5)


@query("month_of_year_filter", "SELECT * FROM orders WHERE month(o_orderdate) = 12 AND year(o_orderdate) = 1997")
def month_of_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.in_month(table(spark, sf_dir, "orders"), "o_orderdate", 12, 1997)


def _count_sql(column: str, check: str, test: str) -> str:
    return f"SELECT '{column}' AS column_name, '{check}' AS \"check\", count(*) FILTER (WHERE {test}) AS n FROM holes"


QUALITY_DDL = "o_orderkey bigint, o_orderpriority bigint, o_comment string"
QUALITY_SQL = (
    f"WITH holes AS ({HOLES_SQL}) SELECT CAST(NULL AS VARCHAR) AS column_name, 'rows' AS \"check\", count(*) AS n FROM holes"
    + "".join(" UNION ALL " + _count_sql(c, "nulls", f"{c} IS NULL") for c in HOLES)
    + "".join(" UNION ALL " + _count_sql(c, "sentinels", f"{c} = 'desconhecido'") for c in ("o_orderstatus", "o_orderpriority"))
    + " UNION ALL " + _count_sql("o_orderdate", "sentinels", "o_orderdate = TIMESTAMP '1900-01-01 00:00:00'")
    + " UNION ALL " + _count_sql("due", "sentinels", "due = DATE '1900-01-01'")
    + " UNION ALL SELECT 'o_orderkey', 'missing_column', 0 UNION ALL SELECT 'o_orderpriority', 'missing_column', 0"
    + " UNION ALL SELECT 'o_comment', 'missing_column', 1"
    + " UNION ALL " + _count_sql("o_orderkey", "cast_failures", "false")
    + " UNION ALL "
    + _count_sql("o_orderpriority", "cast_failures", "o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL")
    + """ UNION ALL SELECT 'o_custkey,due', 'duplicate_keys', count(*) - (SELECT count(*) FROM
          (SELECT DISTINCT o_custkey, due FROM holes)) FROM holes"""
)


@query("quality_report", QUALITY_SQL)
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(holes(spark, sf_dir), T.StructType.fromDDL(QUALITY_DDL), ["o_custkey", "due"])


def _profile_sql(column: str, kind: str, number: bool) -> str:
    mean, deviation = (f"avg({column})", f"stddev({column})") if number else ("NULL", "NULL")
    return f"""SELECT '{column}' AS column_name, '{kind}' AS type, count({column}) AS n_values,
        count(*) - count({column}) AS n_nulls, CAST(round({mean}, 3) AS DOUBLE) AS mean,
        CAST(round({deviation}, 3) AS DOUBLE) AS stddev, CAST(min({column}) AS VARCHAR) AS min_value,
        CAST(max({column}) AS VARCHAR) AS max_value FROM holes"""


PROFILE_SQL = f"WITH holes AS ({HOLES_SQL}) " + " UNION ALL ".join(
    _profile_sql(c, kind, number)
    for c, kind, number in (
        ("o_orderkey", "bigint", True),
        ("o_custkey", "bigint", True),
        ("o_orderstatus", "string", False),
        ("o_totalprice", "double", True),
        ("o_orderdate", "timestamp_ntz", False),
        ("o_orderpriority", "string", False),
        ("items", "int", True),
        ("due", "date", False),
    )
)


@query("profile", PROFILE_SQL)
def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = profile(holes(spark, sf_dir))
    return df.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3)})
