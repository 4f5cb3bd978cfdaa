"""Keyed upsert as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.names import column, quoted, require_columns
from stratalake.operators.dedup import keep_one


def same_keys(left: str, right: str, keys: Sequence[str], null_safe: bool = True) -> Column:
    """Equality of all keys between two aliased sides; still a hash join."""
    pairs = [(F.col(f"{left}.{quoted(k)}"), F.col(f"{right}.{quoted(k)}")) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    source_unique: bool = False,
) -> DataFrame:
    """Source rows replace target rows of the same key; all others stay.

    Null keys match each other. The source is reduced to one row per key first
    (the greatest by ``order_by``, then by the other columns) unless
    ``source_unique`` says it already is. The target side of the anti join is
    the streamed one, so a key that is frequent there is split by adaptive
    execution; a small source is broadcast when its measured size allows.
    """
    keys = require_columns(target, keys)
    names = require_columns(source, target.columns)
    rows = source.select(
        *[column(n).cast(f.dataType).alias(f.name) for n, f in zip(names, target.schema.fields)]
    )
    if not source_unique:
        rows = keep_one(rows, keys, list(order_by))
    matched = rows.select(*[column(k) for k in keys]).alias("s")
    kept = target.alias("t").join(matched, same_keys("t", "s", keys), "left_anti")
    return kept.unionByName(rows)
