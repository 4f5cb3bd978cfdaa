"""Null-safe equality in parts that plain equality and partitioning understand.

``a <=> b`` is planned over expressions of its own, so rows that are already
partitioned by the key are shuffled again for the join. Spelled out as ordinary
columns, the same parts serve a window, an aggregate and a join alike.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T


def _stand_in(dtype: T.DataType) -> Column | None:
    """Some value of the type; which one does not matter."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return None


def match_parts(cols: Mapping[str, Column], types: Mapping[str, T.DataType], stem: str) -> dict[str, Column]:
    """Columns that are never null and equal exactly where ``cols`` are ``<=>``."""
    parts = {}
    for i, (name, c) in enumerate(cols.items()):
        value = _stand_in(types[name])
        if isinstance(types[name], (T.FloatType, T.DoubleType)):
            # As text, as Spark rewrites floating keys and then loses track of
            # their partitioning; adding zero turns -0.0 into 0.0.
            c, value = (c + F.lit(0).cast(types[name])).cast("string"), F.lit("")
        if value is None:
            parts[f"{stem}{i}"] = F.struct(c)
        else:
            parts[f"{stem}{i}"] = F.coalesce(c, value)
            parts[f"{stem}{i}_null"] = c.isNull()
    return parts
