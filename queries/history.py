"""Upsert and slowly-changing-dimension queries on the customer table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from queries.registry import query, table
from stratalake.operators.scd import apply_scd2
from stratalake.operators.scd_late import apply_changes
from stratalake.operators.upsert import upsert

CUSTOMER = {"c_name": "c_name", "c_nationkey": "c_nationkey"}

# Customer 5 has no key; every third customer is new in the changed table.
TARGET = {
    "k": "nullif(c_custkey, 5)",
    **CUSTOMER,
    "c_acctbal": "c_acctbal",
    "c_mktsegment": "case when c_custkey % 10 = 4 then null else c_mktsegment end",
}
CHANGED = {
    "k": "case when c_custkey % 3 = 0 then c_custkey + 10000000 else nullif(c_custkey, 5) end",
    **CUSTOMER,
    "c_acctbal": "case when c_custkey % 4 = 0 then c_acctbal + 1 else c_acctbal end",
    "c_mktsegment": "case when c_custkey % 10 = 7 then null else c_mktsegment end",
}


def _sql(columns: dict[str, str], more: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + more + " FROM customer"


def _frame(spark: SparkSession, sf_dir: str, columns: dict[str, str], *more: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[f"{e} as {c}" for c, e in columns.items()], *more)


@query(
    "upsert_customers",
    f"""WITH t AS ({_sql(TARGET)}), s AS ({_sql(CHANGED)}) SELECT * FROM s
        UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k IS NOT DISTINCT FROM t.k)""",
)
def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(_frame(spark, sf_dir, TARGET), _frame(spark, sf_dir, CHANGED), ["k"])


# The source repeats every key: the greatest balance per key wins.
@query(
    "upsert_with_repeats",
    f"""WITH t AS ({_sql(TARGET)}), s AS (
          SELECT * FROM ({_sql(CHANGED)} UNION ALL SELECT * REPLACE (c_acctbal - 5 AS c_acctbal) FROM ({_sql(CHANGED)}))
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY c_acctbal DESC) = 1)
        SELECT * FROM s
        UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k IS NOT DISTINCT FROM t.k)""",
)
def upsert_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _frame(spark, sf_dir, CHANGED)
    lower = source.selectExpr("k", "c_name", "c_nationkey", "c_acctbal - 5 as c_acctbal", "c_mktsegment")
    return upsert(_frame(spark, sf_dir, TARGET), source.unionByName(lower), ["k"], order_by=["c_acctbal"])


VALIDITY = {
    "current": "date '2020-01-01' AS data_inicio, date '2400-12-31' AS data_fim, 1 AS registro_ativo",
    "past": "date '2019-01-01' AS data_inicio, date '2020-01-01' AS data_fim, 0 AS registro_ativo",
}
PAST = {**TARGET, "c_acctbal": "c_acctbal - 100"}
HISTORY_SQL = f"{_sql(TARGET, ', ' + VALIDITY['current'])} UNION ALL {_sql(PAST, ', ' + VALIDITY['past'])}"
COLUMNS = ", ".join(TARGET)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _frame(spark, sf_dir, TARGET, *VALIDITY["current"].split(", "))
    return current.unionByName(_frame(spark, sf_dir, PAST, *VALIDITY["past"].split(", ")))


@query(
    "scd2_apply",
    f"""WITH h AS ({HISTORY_SQL}), c AS ({_sql(CHANGED)}), a AS (SELECT * FROM h WHERE registro_ativo = 1),
        j AS (SELECT c.*, a.k IS NULL AND a.data_inicio IS NULL AS isnew,
                     a.c_acctbal IS DISTINCT FROM c.c_acctbal OR a.c_mktsegment IS DISTINCT FROM c.c_mktsegment AS chg
              FROM c LEFT JOIN a ON c.k IS NOT DISTINCT FROM a.k),
        changed AS (SELECT k FROM j WHERE NOT isnew AND chg)
        SELECT * FROM h WHERE registro_ativo = 0
        UNION ALL SELECT * REPLACE (DATE '2024-03-01' AS data_fim, 0 AS registro_ativo) FROM a
                  WHERE EXISTS (SELECT 1 FROM changed WHERE changed.k IS NOT DISTINCT FROM a.k)
        UNION ALL SELECT {COLUMNS}, DATE '2024-03-01', DATE '2400-12-31', 1 FROM j WHERE isnew OR chg
        UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM changed WHERE changed.k IS NOT DISTINCT FROM a.k)""",
)
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_scd2(
        history(spark, sf_dir), _frame(spark, sf_dir, CHANGED), ["k"], ["c_acctbal", "c_mktsegment"], "2024-03-01"
    )


@query(
    "scd2_change_set",
    f"""WITH h AS ({HISTORY_SQL}), c AS ({_sql(CHANGED)}), a AS (SELECT * FROM h WHERE registro_ativo = 1),
        j AS (SELECT c.*, a.k IS NULL AS isnew,
                     coalesce(a.c_acctbal <> c.c_acctbal, false) OR coalesce(a.c_mktsegment <> c.c_mktsegment, false) AS chg
              FROM c LEFT JOIN a ON c.k = a.k)
        SELECT * FROM h WHERE registro_ativo = 0
        UNION ALL SELECT a.* REPLACE (DATE '2024-03-01' AS data_fim, 0 AS registro_ativo)
                  FROM a JOIN j ON a.k = j.k WHERE NOT j.isnew AND j.chg
        UNION ALL SELECT {COLUMNS}, DATE '2024-03-01', DATE '2400-12-31', 1 FROM j WHERE isnew OR chg""",
)
def scd2_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_scd2(
        history(spark, sf_dir),
        _frame(spark, sf_dir, CHANGED),
        ["k"],
        ["c_acctbal", "c_mktsegment"],
        "2024-03-01",
        null_safe=False,
        keep_unchanged=False,
    )


# Dated changes: one before, one inside and one after the current interval, two of them on one day, some without any change.
LATE = {
    "early": ("date '2019-06-15'", "c_acctbal + 5", "c_custkey % 3 = 0"),
    "inside": ("date '2022-02-02'", "case when c_custkey % 5 = 0 then c_acctbal else c_acctbal + 7 end", "c_custkey % 2 = 0"),
    "again": ("date '2022-02-02'", "c_acctbal + 9", "c_custkey % 4 = 0"),
    "late": ("date '2021-03-01'", "c_acctbal + 1", "c_custkey % 6 = 0"),
    "new": ("date '2018-01-01'", "c_acctbal", "c_custkey % 7 = 0"),
}


def _late_columns(name: str) -> list[str]:
    day, balance, _ = LATE[name]
    key = "c_custkey + 10000000" if name == "new" else "nullif(c_custkey, 5)"
    columns = {**TARGET, "k": key, "c_acctbal": balance, "day": day, "seq": str(list(LATE).index(name))}
    return [f"{e} AS {c}" for c, e in columns.items()]


LATE_SQL = " UNION ALL ".join(f"SELECT {', '.join(_late_columns(n))} FROM customer WHERE {LATE[n][2]}" for n in LATE)


@query(
    "scd2_late_changes",
    f"""WITH h AS ({HISTORY_SQL}), c AS ({LATE_SQL}),
        points AS (
            SELECT {COLUMNS}, data_inicio AS d, 1 AS kind, NULL AS seq FROM h
            UNION ALL SELECT {COLUMNS}, data_fim, 0, NULL FROM h WHERE data_fim < DATE '2400-12-31'
            UNION ALL SELECT {COLUMNS}, day, 2, seq FROM c),
        single AS (SELECT *, (kind = 0)::VARCHAR || '|' || CASE WHEN kind = 0 THEN '' ELSE coalesce(c_acctbal::VARCHAR, '-') || '|' || coalesce(c_mktsegment, '-') END AS v
            FROM points QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY kind DESC, seq DESC NULLS LAST, c_name DESC, c_acctbal DESC) = 1),
        compared AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY d) AS before FROM single),
        begun AS (SELECT * FROM compared WHERE (before IS NOT NULL OR kind <> 0) AND before IS DISTINCT FROM v),
        ended AS (SELECT *, lead(d) OVER (PARTITION BY k ORDER BY d) AS e FROM begun)
        SELECT {COLUMNS}, d AS data_inicio, coalesce(e, DATE '2400-12-31') AS data_fim, CASE WHEN e IS NULL THEN 1 ELSE 0 END AS registro_ativo
        FROM ended WHERE kind <> 0""",
)
def scd2_late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes with their own dates, out of order and twice on one day."""
    customer = table(spark, sf_dir, "customer")
    parts = [customer.filter(LATE[n][2]).selectExpr(*_late_columns(n)) for n in LATE]
    return apply_changes(history(spark, sf_dir), reduce(DataFrame.unionByName, parts), ["k"], ["c_acctbal", "c_mktsegment"], "day", order_by=["seq"])
