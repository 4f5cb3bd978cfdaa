"""Layered lake tables on PySpark: ingest, clean, de-duplicate, upsert, keep
history, unify feeds, aggregate and report."""

from stratalake.operators.aggregate import hourly_mean, mean_of_group_totals, monthly_aggregate, monthly_mean
from stratalake.operators.clean import (
    fill_by_type,
    fill_nulls,
    standard_clean,
    to_utc,
    trim_strings,
    upper_strings,
)
from stratalake.operators.conform import code_label, conform, typed_null, union_all
from stratalake.operators.dates import (
    in_date_range,
    in_month,
    parse_dates,
    parse_timestamps,
    with_date_parts,
    with_ingestion_time,
    with_update_time,
    with_year_month,
)
from stratalake.operators.dedup import drop_duplicates, keep_latest, keep_max, keep_min, keep_one
from stratalake.operators.hashing import (
    dataset_fingerprint,
    dataset_hash_value,
    with_row_hash,
)
from stratalake.operators.masking import hash_column, mask_all, mask_cpf, mask_email, mask_phone
from stratalake.operators.quality import preview, profile, quality_report, schema_rows
from stratalake.operators.scd import apply_scd2
from stratalake.operators.schema import cast_via_string, enforce_schema, lower_names
from stratalake.operators.upsert import upsert
from stratalake.plans.gold import publish_gold, read_gold_monthly, read_gold_trips, to_gold
from stratalake.plans.inspect import inspect, inspect_feeds
from stratalake.plans.layers import run_layers
from stratalake.plans.report import hourly_answer, report, report_lines, total_answer, write_report
from stratalake.plans.silver import optimize_silver, publish_silver, read_silver, to_silver
from stratalake.sources.feeds import FEEDS, Feed
from stratalake.sources.files import (
    append_parquet,
    ingest_files,
    list_files,
    load_files,
    pending_files,
    read_bronze,
    read_ledger,
    read_parquet,
)
from stratalake.sources.layout import (
    analyze_table,
    cluster_write,
    clustered,
    optimize_for_reads,
    partitioned_write,
    rebalanced,
)
from stratalake.sources.tables import (
    publish,
    publish_partitions,
    read_partitions,
    read_table,
    register_views,
    table_exists,
    upsert_partitions,
)
from stratalake.streaming.ingest import append_stream, ingest_stream, read_stream_bronze
from stratalake.streaming.upsert import silver_stream, upsert_stream

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("operators", "plans", "sources", "streaming", "functions", "fixed")]
