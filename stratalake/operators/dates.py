"""Date columns, parsing and date-range filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.fixed import DAY, INGESTED_AT, MONTH, UPDATED_AT, YEAR, YEAR_MONTH
from stratalake.functions.dates import stamp, year_month
from stratalake.functions.names import column, require_columns


def with_ingestion_time(df: DataFrame, name: str = INGESTED_AT, as_of: object | None = None) -> DataFrame:
    return df.withColumn(name, stamp(as_of))


def with_update_time(df: DataFrame, name: str = UPDATED_AT, as_of: object | None = None) -> DataFrame:
    return df.withColumn(name, stamp(as_of))


def with_year_month(df: DataFrame, base: str, name: str = YEAR_MONTH) -> DataFrame:
    (base,) = require_columns(df, [base])
    return df.withColumn(name, year_month(column(base)))


def with_date_parts(df: DataFrame, base: str, prefix: str = "") -> DataFrame:
    (base,) = require_columns(df, [base])
    c = column(base)
    return df.withColumns({prefix + YEAR: F.year(c), prefix + MONTH: F.month(c), prefix + DAY: F.dayofmonth(c)})


def parse_timestamps(
    df: DataFrame, name: str, fmt: str = "yyyy-MM-dd HH:mm:ss", into: str | None = None, ntz: bool = False
) -> DataFrame:
    """Text to timestamp; text that does not follow ``fmt`` becomes null."""
    (name,) = require_columns(df, [name])
    parsed = F.try_to_timestamp(column(name), F.lit(fmt))
    return df.withColumn(into or name, parsed.cast("timestamp_ntz") if ntz else parsed)


def parse_dates(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd", into: str | None = None) -> DataFrame:
    """Text to date; text that does not follow ``fmt`` becomes null."""
    (name,) = require_columns(df, [name])
    return df.withColumn(into or name, F.try_to_date(column(name), fmt))


def in_date_range(df: DataFrame, name: str, start: str, end: str, whole_days: bool = False) -> DataFrame:
    """Rows with ``start <= name <= end``, as a filter Parquet can skip by.

    The bounds are dates, so for a timestamp the last day counts at midnight
    only; ``whole_days=True`` takes all of it.
    """
    (name,) = require_columns(df, [name])
    c, dtype = column(name), df.schema[name].dataType
    kind = dtype if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) else T.DateType()

    def bound(value: str, days: int = 0) -> Column:
        day = F.lit(value).cast("date")
        return (F.date_add(day, days) if days else F.lit(value)).cast(kind)

    upper = c < bound(end, 1) if whole_days else c <= bound(end)
    return df.filter((c >= bound(start)) & upper)


def in_month(df: DataFrame, name: str, month: int, year: int | None = None) -> DataFrame:
    """Rows of one month; with a ``year`` the filter reaches the Parquet scan."""
    (name,) = require_columns(df, [name])
    c = column(name)
    if year is None:
        return df.filter(F.month(c) == month)
    kind = df.schema[name].dataType
    after = (year + 1, 1) if month == 12 else (year, month + 1)
    first, nxt = (F.lit(f"{y:04d}-{m:02d}-01").cast(kind) for y, m in ((year, month), after))
    return df.filter((c >= first) & (c < nxt))
