"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def year_month(c: Column) -> Column:
    """'yyyyMM' text, from integer parts (no formatter, no zone conversion)."""
    digits = (F.year(c) * 100 + F.month(c)).cast("string")
    return F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)


def zone_to_utc(c: Column, dtype: T.DataType, source_tz: str) -> Column:
    """Wall-clock time of ``source_tz`` as UTC, keeping the column type."""
    if source_tz.upper() in ("UTC", "ETC/UTC", "Z"):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), c)
    return F.to_utc_timestamp(c, source_tz)


def stamp(as_of: object | None) -> Column:
    """``current_timestamp`` unless a fixed instant (or a Column) is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
