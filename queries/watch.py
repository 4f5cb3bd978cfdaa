"""Counts of quality, sketches and drift, differences of tables, inspection, SQL functions, streams without repeats."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from queries.feeds import AS_OF, ntz_feed, raw_feed, raw_sql, silver_sql
from queries.keys import PEOPLE, PEOPLE_SQL
from queries.registry import query, table
from queries.writes import MOVED, moved_events
from stratalake.functions.sql import register_functions
from stratalake.operators.dates import with_year_month
from stratalake.operators.difference import differing_keys, digest_tree
from stratalake.operators.quality import preview, profile, schema_rows
from stratalake.operators.sketches import column_sketches, drift, merged_sketches, sketch_profile
from stratalake.plans.inspect import inspect
from stratalake.plans.silver import COUNTS, publish_counted_silver
from stratalake.sources.feeds import FEEDS
from stratalake.sources.storage import shared_dir
from stratalake.sources.tables import publish, publish_partitions, read_partitions, read_table
from stratalake.streaming.upsert import without_repeats

# Places of the fhv feed arrive as texts, some of them no numbers.
BAD = {"yellow": {}, "fhv": {"PUlocationID": "case when event_id % 11 = 0 then 'x' else cast(user_id % 265 as varchar(9)) end"}}


ROWS_OF = {"fillers": "filled_rows", "cast_failures": "failed_rows"}


def quality_sql(name: str) -> str:
    feed, changed = ntz_feed(name), BAD[name]
    month = next(f"strftime(coalesce({n}, TIMESTAMP '1900-01-01 00:00:00'), '%Y%m')" for n in feed.schema.names if n.lower() == feed.pickup)
    checks = ["SELECT ano_mes, NULL AS column_name, 'rows' AS check, count(*) AS n FROM raw GROUP BY ano_mes"]
    flags = {"fillers": {f.name: f"{f.name} IS NULL" for f in feed.schema.fields if f.dataType.simpleString() != "bigint"}}
    flags["cast_failures"] = {c: f"{c} IS NOT NULL AND TRY_CAST({c} AS BIGINT) IS NULL" for c in changed}
    for check, tests in flags.items():
        checks += [f"SELECT NULL, '{c.lower()}', '{check}', count(*) FILTER ({test}) FROM raw" for c, test in tests.items()]
        some = " OR ".join(f"({test})" for test in tests.values()) or "false"
        checks.append(f"SELECT ano_mes, NULL, '{ROWS_OF[check]}', count(*) FILTER ({some}) FROM raw GROUP BY ano_mes")
    checks.append("SELECT ano_mes, NULL, 'collapsed', n - k FROM (SELECT ano_mes, count(*) AS n FROM raw GROUP BY 1) JOIN (SELECT ano_mes, count(*) AS k FROM kept GROUP BY 1) USING (ano_mes)")
    kept = silver_sql(name)  # the changed column is no key
    return f"""SELECT '{name}' AS feed, * FROM (WITH raw AS (SELECT *, {month} AS ano_mes FROM ({raw_sql(name, None, changed)})), kept AS ({kept})
        SELECT * FROM ({" UNION ALL ".join(checks)}) WHERE n > 0)"""


@query("layers_quality_counts", " UNION ALL ".join(map(quality_sql, BAD)))
def layers_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed and month, what was counted while silver was written."""
    rows = []
    for name, changed in BAD.items():
        raw = raw_feed(spark, sf_dir, name, changed=changed)
        counts = publish_counted_silver(raw, ntz_feed(name), shared_dir(spark, "counted"), F.lit(AS_OF).cast("timestamp_ntz"))
        rows += [(name, *count) for count in counts]
    return spark.createDataFrame(rows, f"feed string, {COUNTS}")


WATCHED = ["o_totalprice", "o_custkey", "o_orderstatus"]
GAP_SQL = """SELECT m.ano_mes, list_max(list_transform(range(0, 101), lambda i:
        abs(a.s[greatest(1, (i * len(a.s) + 99) // 100)] - b.s[greatest(1, (i * len(b.s) + 99) // 100)])))
        / (greatest(a.s[-1], b.s[-1]) - least(a.s[1], b.s[1])) AS drift
    FROM m JOIN sorted a ON a.ano_mes = m.ano_mes JOIN sorted b ON b.ano_mes = m.previous"""


def drift_sql(c: str) -> str:
    number = c != "o_orderstatus"
    return f"""SELECT ano_mes, '{c}' AS column_name, n_values, 0 AS n_nulls, n_distinct, previous, {"round(drift, 6)" if number else "NULL::DOUBLE"} AS drift
        FROM (WITH own AS (SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, {c} AS v FROM orders),
            m AS (SELECT ano_mes, count(*) AS n_values, count(DISTINCT v) AS n_distinct, lag(ano_mes) OVER (ORDER BY ano_mes) AS previous FROM own GROUP BY ano_mes),
            sorted AS (SELECT ano_mes, list_sort(list(v)) AS s FROM own GROUP BY ano_mes),
            gap AS ({GAP_SQL if number else "SELECT NULL AS ano_mes, NULL AS drift"})
            SELECT m.*, CASE WHEN previous IS NOT NULL THEN drift END AS drift FROM m LEFT JOIN gap USING (ano_mes))"""


@query("profile_drift", " UNION ALL ".join(map(drift_sql, WATCHED)))
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts per month and the drift from the month before, from sketches per day that are merged."""
    orders = with_year_month(table(spark, sf_dir, "orders"), "o_orderdate").withColumn("day", F.dayofmonth("o_orderdate"))
    path = shared_dir(spark, "sketches")
    publish(column_sketches(orders, ["ano_mes", "day"], WATCHED), path)
    moved = drift(merged_sketches(read_table(spark, path), ["ano_mes"]), "ano_mes")
    kept = sketch_profile(moved)
    return kept.select("ano_mes", "column_name", "n_values", "n_nulls", "n_distinct", "previous", F.round("drift", 6).alias("drift"))


# The second version of the orders: some of 1996 cost more, some of March 1996 are gone, some of May 1997 are new.
MORE, GONE, NEW = "o_orderkey % 7 = 0 and ano_mes like '1996%'", "o_orderkey % 11 = 0 and ano_mes = '199603'", "o_orderkey % 13 = 0 and ano_mes = '199705'"


@query(
    "fingerprint_diff",
    f"""WITH a AS (SELECT *, strftime(o_orderdate, '%Y%m') AS ano_mes FROM orders),
        b AS (SELECT * REPLACE (CASE WHEN {MORE} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM a WHERE NOT ({GONE})
              UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM a WHERE {NEW})
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change
        FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_totalprice IS DISTINCT FROM b.o_totalprice""",
)
def fingerprint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that differ between two published versions, by their digest trees."""
    root = shared_dir(spark, "difference")
    old = with_year_month(table(spark, sf_dir, "orders"), "o_orderdate")
    new = old.filter(f"not ({GONE})").withColumn("o_totalprice", F.expr(f"case when {MORE} then o_totalprice + 1 else o_totalprice end"))
    new = new.unionByName(old.filter(NEW).withColumn("o_orderkey", F.col("o_orderkey") + 1000000000))
    trees, readers = [], []
    for name, df in (("old", old), ("new", new)):
        publish_partitions(df, f"{root}/{name}", "ano_mes")
        publish(digest_tree(read_partitions(spark, f"{root}/{name}", "ano_mes", df.schema), "ano_mes", ["o_orderkey"], df.columns), f"{root}/{name}_tree")
        trees.append(read_table(spark, f"{root}/{name}_tree"))
        readers.append(lambda parts, name=name: read_partitions(spark, f"{root}/{name}", "ano_mes", old.schema, parts))
    return differing_keys(*trees, *readers, "ano_mes", ["o_orderkey"], old.columns)


@query(
    "sql_masked_view",
    rf"""SELECT c_custkey, '***.' || substr(regexp_replace(cpf, '\D', '', 'g'), 4, 3) || '.***-**' AS cpf_masked,
                left(mail, 3) || '***@***.com' AS mail_masked, '***-' || right(phone, 4) AS phone_masked, sha256(mail) AS mail_hash,
                sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), mail)) AS row_hash
         FROM ({PEOPLE_SQL})""",
)
def sql_masked_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view masked by SQL functions."""
    stem = f"masked_{uuid.uuid4().hex}"
    register_functions(spark, f"{stem}_")
    table(spark, sf_dir, "customer").selectExpr(*[f"{e} as {c}" for c, e in PEOPLE.items()]).createOrReplaceTempView(stem)
    return spark.sql(f"""SELECT c_custkey, {stem}_mask_cpf(cpf) AS cpf_masked, {stem}_mask_email(mail) AS mail_masked, {stem}_mask_phone(phone) AS phone_masked,
        {stem}_text_hash(mail) AS mail_hash, {stem}_row_hash(array(cast(c_custkey as string), mail)) AS row_hash FROM {stem}""")


@query("stream_dedup", f"SELECT * FROM events UNION ALL {MOVED}")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come again, in the same delivery and in one after a restart, pass once."""
    root = shared_dir(spark, "stream-dedup")
    landing, out, checkpoint = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events")
    for delivery in (events, events.unionByName(moved_events(spark, sf_dir)).unionByName(moved_events(spark, sf_dir))):
        delivery.write.mode("append").parquet(landing)
        stream = without_repeats(spark.readStream.schema(events.schema).parquet(landing), "30 days")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


@query(
    "inspect_schema",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feed, {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS type, true AS nullable FROM region WHERE r_regionkey = 0"
        for name in FEEDS
        for i, f in enumerate(ntz_feed(name).schema.fields)
    ),
)
def inspect_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schemas of all feeds as an inspection shows them."""
    found = [schema_rows(inspect_typed(spark, sf_dir, n)).select(F.lit(n).alias("feed"), F.col("position").cast("bigint").alias("position"), "column_name", "type", F.lit(True).alias("nullable")) for n in FEEDS]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def inspect_typed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return inspect(raw_feed(spark, sf_dir, name), ntz_feed(name).schema)["first"]


@query("inspect_first_row", "SELECT count(*) AS n_rows, count(*) FILTER (known) AS n_known FROM (SELECT true AS known FROM orders LIMIT 1)")
def inspect_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row preview: whichever row it is, it is one of the table."""
    orders = table(spark, sf_dir, "orders")
    first = preview(orders)
    return first.join(orders, orders.columns, "left").agg(F.count("*").alias("n_rows"), F.count("o_orderkey").alias("n_known"))


def inspect_sql(name: str) -> str:
    def one(c: str, kind: str) -> str:
        number, double = kind in ("bigint", "double"), kind == "double"
        mean, deviation = (f"round(avg({c}), 3)", f"round(stddev({c}), 3)") if number else ("CAST(NULL AS DOUBLE)",) * 2
        low, high = ("NULL", "NULL") if double else (f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)")
        return f"SELECT '{c}' AS column_name, '{kind}' AS type, count({c}) AS n_values, count(*) - count({c}) AS n_nulls, {mean} AS mean, {deviation} AS stddev, {low} AS min_value, {high} AS max_value FROM raw"

    return f"WITH raw AS ({raw_sql(name)}) " + " UNION ALL ".join(one(f.name, f.dataType.simpleString()) for f in ntz_feed(name).schema.fields)


def _register_inspection(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = inspect(raw_feed(spark, sf_dir, name), ntz_feed(name).schema)["profile"]
        texts = {c: F.when(F.col("type") != "double", F.col(c)) for c in ("min_value", "max_value")}  # doubles are written otherwise in SQL
        return out.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3), **texts})

    query(f"inspect_{name}", inspect_sql(name))(run)


for _name in ("yellow", "green", "hvfhv"):
    _register_inspection(_name)


@query(
    "profile_distinct",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS near, count({c}) AS n_values FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")),
)
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct counts of the profile: near the exact ones, three of their stated errors at most."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in orders.columns])))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.15 * F.col("exact")
    return profile(orders, distinct=True).join(exact, "column_name").select("column_name", near.alias("near"), "n_values")
