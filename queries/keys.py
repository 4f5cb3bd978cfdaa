"""De-duplication, hashing, masking and code-list queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.registry import query, table
from stratalake.fixed import OTHER_PROVIDER
from stratalake.operators import dedup, hashing, masking
from stratalake.operators.conform import code_label, conform, typed_null, union_all


def _first_sql(source: str, keys: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


LINE_REST = """l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
    l_returnflag DESC, l_linestatus DESC"""


@query("dedup_latest", _first_sql("lineitem", "l_orderkey, l_linenumber", f"l_shipdate DESC, {LINE_REST}"))
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


# Events whose value is missing for some rows.
EVENTS = "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value) FROM events"
EVENT_REST = "event_id DESC, ts DESC, props DESC"


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("value", F.expr("case when event_id % 3 = 0 then null else value end"))


@query("dedup_max", _first_sql(f"({EVENTS})", "user_id, event_type", f"value DESC NULLS LAST, {EVENT_REST}"))
def dedup_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_max(gappy_events(spark, sf_dir), ["user_id", "event_type"], "value")


@query("dedup_min", _first_sql(f"({EVENTS})", "user_id, event_type", f"value ASC NULLS LAST, {EVENT_REST}"))
def dedup_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_min(gappy_events(spark, sf_dir), ["user_id", "event_type"], "value")


@query("dedup_min_nulls_first", _first_sql(f"({EVENTS})", "user_id, event_type", f"value ASC NULLS FIRST, {EVENT_REST}"))
def dedup_min_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_min(gappy_events(spark, sf_dir), ["user_id", "event_type"], "value", nulls="spark")


@query("drop_exact_duplicates", "SELECT DISTINCT text, lang, source FROM documents")
def drop_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicates(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query(
    "drop_duplicates_by_subset",
    _first_sql("documents", "text", "n_chars DESC, doc_id DESC, lang DESC, source DESC"),
)
def drop_duplicates_by_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicates(table(spark, sf_dir, "documents"), ["text"], order_by=["n_chars"])


HASHED = ["event_id", "ts", "user_id", "event_type", "props"]


@query("row_hash", "SELECT *, sha256(concat_ws('|', event_id, ts, user_id, event_type, props)) AS row_hash FROM events")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.with_row_hash(table(spark, sf_dir, "events"), HASHED)


@query(
    "row_hash_null_safe",
    r"""SELECT c_custkey, sha256(concat_ws('|', CAST(c_custkey AS VARCHAR),
               coalesce(replace(replace(seg, '\', '\\'), '|', '\|'), '\N'),
               replace(replace(c_name || '|\', '\', '\\'), '|', '\|'))) AS row_hash
        FROM (SELECT *, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)""",
)
def row_hash_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
        F.concat("c_name", F.lit("|\\")).alias("name"),
    )
    return hashing.with_row_hash(df, ["c_custkey", "seg", "name"], null_token="N").select("c_custkey", "row_hash")


def _fingerprint_sql(source: str, cols: str) -> str:
    lanes = []
    for i in range(4):
        word = f"CAST('0x' || substr(h, {15 * i + 1}, 15) AS BIGINT)"
        lanes += [f"sum({word} & 1048575)", f"sum(({word} >> 20) & 1048575)", f"sum({word} >> 40)"]
    lanes.append("sum(CAST('0x' || substr(h, 61, 4) AS BIGINT))")
    return f"""SELECT count(*) AS n_rows, sha256(concat_ws('-', count(*), {", ".join(lanes)})) AS dataset_hash
        FROM (SELECT sha256(concat_ws('|', {cols})) AS h FROM {source})"""


@query("dataset_fingerprint", _fingerprint_sql("events", ", ".join(HASHED)))
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.dataset_fingerprint(table(spark, sf_dir, "events"), HASHED)


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dataset_fingerprint_lineitem", _fingerprint_sql("lineitem", ", ".join(LINE_KEYS)))
def dataset_fingerprint_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.dataset_fingerprint(table(spark, sf_dir, "lineitem"), LINE_KEYS)


PEOPLE = {
    "c_custkey": "c_custkey",
    "cpf": "case when c_custkey % 4 = 0 then null else lpad(cast(c_custkey * 7919 as varchar(20)), 9, '0') || '-00' end",
    "mail": "lower(c_name) || '@mail.com'",
    "phone": "cast(c_custkey * 31 as varchar(20))",
}
PEOPLE_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in PEOPLE.items()) + " FROM customer"


@query(
    "mask_all",
    rf"""SELECT *, '***.' || substr(regexp_replace(cpf, '\D', '', 'g'), 4, 3) || '.***-**' AS cpf_masked,
                left(mail, 3) || '***@***.com' AS mail_masked, '***-' || right(phone, 4) AS phone_masked,
                sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey_hash, sha256(mail) AS mail_hash
         FROM ({PEOPLE_SQL})""",
)
def mask_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").selectExpr(*[f"{e} as {c}" for c, e in PEOPLE.items()])
    return masking.mask_all(people, ["cpf"], ["mail"], ["phone"], ["c_custkey", "mail"])


@query(
    "provider_map",
    """SELECT l_orderkey, l_linenumber,
              CASE l_returnflag WHEN 'A' THEN 'Uber' WHEN 'R' THEN 'Lyft' ELSE 'Other' END AS provider FROM lineitem""",
)
def provider_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = code_label(F.col("l_returnflag"), {"A": "Uber", "R": "Lyft"}, OTHER_PROVIDER)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("provider"))


@query(
    "conform_union",
    """SELECT l_orderkey AS id, l_shipdate AS moment, l_extendedprice AS amount, 'line' AS kind, l_returnflag AS flag
       FROM lineitem UNION ALL
       SELECT o_orderkey, o_orderdate, CAST(trunc(o_totalprice) AS DOUBLE), 'order', NULL FROM orders UNION ALL
       SELECT event_id, ts, NULL, 'event', NULL FROM events""",
)
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = conform(
        table(spark, sf_dir, "lineitem"),
        {"id": "l_orderkey", "moment": "l_shipdate", "amount": "l_extendedprice", "kind": F.lit("line"), "flag": "l_returnflag"},
    )
    whole = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("bigint"))
    orders = conform(
        whole, {"id": "o_orderkey", "moment": "o_orderdate", "amount": ("price", "double"), "kind": F.lit("order")}
    )
    events = conform(
        table(spark, sf_dir, "events"),
        {"id": "event_id", "moment": "ts", "amount": typed_null("double"), "kind": F.lit("event")},
    )
    return union_all(lines, orders, events)
