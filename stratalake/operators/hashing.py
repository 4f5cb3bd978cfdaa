"""Row hashes and whole-table hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratalake.functions.digests import LANES, lane_sums, row_digest
from stratalake.functions.names import column, fresh_name, require_columns

DATASET_HASH = "dataset_hash"


def with_row_hash(
    df: DataFrame, cols: Sequence[str], name: str = "row_hash", null_token: str | None = None
) -> DataFrame:
    cols = require_columns(df, cols)
    return df.withColumn(name, row_digest([column(c) for c in cols], null_token))


def dataset_fingerprint(df: DataFrame, cols: Sequence[str], null_token: str | None = None) -> DataFrame:
    """One row: ``n_rows`` and a SHA-256 text for the multiset of rows.

    Row hashes are added up piece by piece, so the work is one map-side
    aggregate: no sort, no shuffle of rows, nothing collected. Two tables with
    the same rows in any order agree. For change detection; an adversary who
    can choose rows freely needs the exact form.
    """
    cols = require_columns(df, cols)
    digest = fresh_name(df, "digest")
    hashed = df.select(row_digest([column(c) for c in cols], null_token).alias(digest))
    lanes = [s.alias(f"lane_{i}") for i, s in enumerate(lane_sums(F.col(digest)))]
    sums = hashed.agg(F.count("*").alias("n_rows"), *lanes)
    parts = [F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ["n_rows"] + [f"lane_{i}" for i in range(LANES)]]
    return sums.select("n_rows", F.sha2(F.concat_ws("-", *parts), 256).alias(DATASET_HASH))


def dataset_hash_value(df: DataFrame, cols: Sequence[str]) -> str:
    """The fingerprint as a Python text."""
    return dataset_fingerprint(df, cols).first()[DATASET_HASH]
