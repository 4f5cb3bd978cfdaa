"""Masks, hashes and months as SQL functions, so views and reports in SQL need no Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratalake.fixed import CPF_HEAD, CPF_TAIL, EMAIL_TAIL, HASH_SEPARATOR, PHONE_HEAD

# Name -> parameters, type of the result, expression. The expressions say what functions.masks and functions.dates say.
FUNCTIONS = {
    "mask_cpf": ("value STRING", "STRING", rf"concat('{CPF_HEAD}', substring(regexp_replace(value, '\\D', ''), 4, 3), '{CPF_TAIL}')"),
    "mask_email": ("value STRING", "STRING", f"concat(left(value, 3), '{EMAIL_TAIL}')"),
    "mask_phone": ("value STRING", "STRING", f"concat('{PHONE_HEAD}', right(value, 4))"),
    "text_hash": ("value STRING", "STRING", "sha2(value, 256)"),
    "row_hash": ("texts ARRAY<STRING>", "STRING", f"sha2(concat_ws('{HASH_SEPARATOR}', texts), 256)"),
    "year_month": ("moment TIMESTAMP_NTZ", "STRING", "date_format(moment, 'yyyyMM')"),
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Define the functions in the session, as temporary SQL functions; returns their names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {kind} RETURN {body}")
    return [prefix + name for name in FUNCTIONS]


def register_month_of_service(spark: SparkSession, view: str, name: str = "month_of_service") -> None:
    """Define a table function ``name(service, month)``: the rows of a view of trips, or of the monthly aggregate, of one
    service and month. The month reaches the scan, so a table partitioned by it reads that partition only."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema.fields)
    names = ", ".join(f"v.`{c}`" for c in spark.table(view).columns)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(service STRING, month STRING) RETURNS TABLE ({columns}) "
        f"RETURN SELECT {names} FROM {view} v WHERE v.service_type = {name}.service AND v.ano_mes = {name}.month"
    )
