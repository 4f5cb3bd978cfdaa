"""The two reported answers, as rows and as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.fixed import (
    HOUR,
    MEAN_PASSENGERS,
    MEAN_TOTAL,
    REPORT_HOUR_LINE,
    REPORT_HOURS,
    REPORT_NO_PASSENGERS,
    REPORT_RULE,
    REPORT_TITLE,
    REPORT_TOTAL,
    YEAR_MONTH,
)
from stratalake.functions.names import lookup
from stratalake.operators.aggregate import hourly_mean, mean_of_group_totals

PICKUP, PASSENGERS = "tpep_pickup_datetime", "passenger_count"


def total_answer(monthly: DataFrame, service: str = "yellow", scale: int | None = None) -> DataFrame:
    """Mean over the monthly groups of one service of their total revenue."""
    return mean_of_group_totals(monthly, "faturamento_total", MEAN_TOTAL, F.col("service_type") == service, scale)


def hourly_answer(yellow: DataFrame, month: int = 5, year: int | None = None) -> DataFrame:
    """Mean passengers by hour of day in one month.

    Silver is partitioned by month, so the month also selects the partitions to read.
    """
    if YEAR_MONTH in yellow.columns:
        own = F.col(YEAR_MONTH)
        yellow = yellow.filter(own.endswith(f"{month:02d}") if year is None else own == f"{year:04d}{month:02d}")
    return hourly_mean(yellow, PICKUP, PASSENGERS, MEAN_PASSENGERS, month, year)


def report(
    monthly: DataFrame, yellow: DataFrame, month: int = 5, year: int | None = None, scale: int | None = None
) -> DataFrame:
    """Rows ``(metric, key, value)``: one total, one row per hour."""
    total = total_answer(monthly, scale=scale).select(
        F.lit(MEAN_TOTAL).alias("metric"), F.lit("yellow").alias("key"), F.col(MEAN_TOTAL).alias("value")
    )
    hours = hourly_answer(yellow, month, year).select(
        F.lit(MEAN_PASSENGERS).alias("metric"),
        F.col(HOUR).cast("string").alias("key"),
        F.col(MEAN_PASSENGERS).alias("value"),
    )
    return total.unionByName(hours)


def report_lines(
    monthly: DataFrame, yellow: DataFrame, month: int = 5, year: int | None = None, scale: int | None = None
) -> DataFrame:
    """The text form: ``line_no`` and ``line``, at most one line per hour."""

    def line(df: DataFrame, number: Column | int, text: Column | str) -> DataFrame:
        return df.select(
            (number if isinstance(number, Column) else F.lit(number)).cast("int").alias("line_no"),
            (text if isinstance(text, Column) else F.lit(text)).alias("line"),
        )

    total = total_answer(monthly, scale=scale)
    head = [(1, REPORT_TITLE), (2, REPORT_RULE), (3, "")]
    parts = [line(total, n, text) for n, text in head]
    parts.append(line(total, 4, F.concat(F.lit(REPORT_TOTAL), F.coalesce(F.col(MEAN_TOTAL).cast("string"), F.lit("None")))))
    parts.append(line(total, 5, ""))
    if lookup(yellow.columns, PASSENGERS) is None:
        parts.append(line(total, 6, REPORT_NO_PASSENGERS))
    else:
        hours = hourly_answer(yellow, month, year)
        parts.append(line(total, 6, REPORT_HOURS))
        parts.append(
            line(hours, F.col(HOUR) + 7, F.format_string(REPORT_HOUR_LINE, F.col(HOUR), F.col(MEAN_PASSENGERS)))
        )
    return reduce(DataFrame.unionByName, parts)


def write_report(lines: DataFrame, path: str) -> None:
    """One text file in line order; a report has at most thirty lines."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)
