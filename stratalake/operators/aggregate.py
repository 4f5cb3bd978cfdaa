"""Monthly and hourly aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.fixed import HOUR, MONTHLY_KEYS, YEAR_MONTH
from stratalake.functions.dates import year_month
from stratalake.functions.names import column, lookup, require_columns
from stratalake.operators.dates import in_month
from stratalake.operators.frequent import split_frequent


def _distinct(name: str, keys: Sequence[str], approximate: bool) -> Column:
    c = column(name)
    if name in keys:
        # Within a group of its own key a column has one value, or none if null.
        return F.max(F.when(c.isNull(), F.lit(0)).otherwise(F.lit(1))).cast("bigint")
    return F.approx_count_distinct(c) if approximate else F.countDistinct(c)


# Whole numbers below EXACT are exact in a double. They are summed as two lanes of LANE and fewer bits, so that no sum of
# less than some 10**10 rows can leave 64 bits.
EXACT, LANE = 2.0**53, 2.0**26


def _total(name: str, scale: int | None) -> Column:
    """Sum; with ``scale``, of whole units, which is exact in any order. Values that are no exact whole number of units
    (not finite, or too large) are summed as doubles and added, so none is lost."""
    c = column(name).cast("double") if scale is not None else column(name)
    if scale is None:
        return F.sum(c)
    unit = F.lit(float(10**scale))
    whole = F.rint(c * unit)
    fits = F.abs(whole) < F.lit(EXACT)
    high = F.floor(whole / F.lit(LANE))
    lanes = [F.sum(F.when(fits, v).cast("bigint")).cast("decimal(38,0)") for v in (high, whole - high * F.lit(LANE))]
    exact = (lanes[0] * F.lit(int(LANE)).cast("decimal(10,0)") + lanes[1]).cast("double") / unit
    rest = F.sum(F.when(~fits, c))
    return F.coalesce(exact + rest, exact, rest)


def _mean(name: str, scale: int | None) -> Column:
    return F.avg(column(name)) if scale is None else _total(name, scale) / F.count(column(name))


def monthly_aggregate(
    trips: DataFrame,
    keys: Sequence[str] = tuple(MONTHLY_KEYS),
    scale: int | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Trip counts, places, distances and revenue per group.

    ``scale`` sums distances and amounts as whole numbers of that many decimal
    digits: the result is then the same to the last bit however rows are
    partitioned.
    A place column that is itself a group key costs no distinct count.
    """
    keys = require_columns(trips, keys)
    return trips.groupBy(*[column(k) for k in keys]).agg(
        F.count("*").alias("qtd_corridas"),
        _distinct("pulocationid", keys, approximate).alias("locais_embarque"),
        _distinct("dolocationid", keys, approximate).alias("locais_desembarque"),
        _total("trip_distance", scale).alias("distancia_total"),
        _total("total_amount", scale).alias("faturamento_total"),
        _mean("trip_distance", scale).alias("media_distancia"),
        _mean("total_amount", scale).alias("media_valor"),
        F.max("trip_distance").alias("max_distancia"),
        F.max("total_amount").alias("max_valor"),
        F.min("pickup_datetime").alias("min_data"),
        F.max("pickup_datetime").alias("max_data"),
    )


def monthly_aggregate_ranged(trips: DataFrame, scale: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """As ``monthly_aggregate`` by its own keys, with the groups left in ranges of the keys, month first, so that they can
    be written by month without a second shuffle.

    Trips go to the task of their range in one narrow shuffle; those of
    frequent groups are combined before theirs. ``like`` as in ``split_frequent``.
    """
    keys = require_columns(trips, MONTHLY_KEYS)
    used = require_columns(trips, ["trip_distance", "total_amount", "pickup_datetime"])
    frequent, rest = split_frequent(trips.select(*map(column, [*keys, *used])), keys, like)
    groups = monthly_aggregate(rest.repartitionByRange(*map(column, keys)), keys, scale)
    return groups if frequent is None else groups.unionByName(monthly_aggregate(frequent, keys, scale))


def mean_of_group_totals(
    groups: DataFrame, total: str, name: str, where: Column | None = None, scale: int | None = None
) -> DataFrame:
    """One row: the plain mean of group totals (every group weighs the same)."""
    require_columns(groups, [total])
    rows = groups if where is None else groups.filter(where)
    return rows.agg(_mean(total, scale).alias(name))


def monthly_mean(
    df: DataFrame, ts: str, value: str, name: str, month: str = YEAR_MONTH, scale: int | None = None
) -> DataFrame:
    """Mean of ``value`` per month."""
    ts, value = require_columns(df, [ts, value])
    return df.groupBy(year_month(column(ts)).alias(month)).agg(_mean(value, scale).alias(name))


def hourly_mean(
    df: DataFrame,
    ts: str,
    value: str,
    name: str,
    month: int | None = None,
    year: int | None = None,
    hour: str = HOUR,
    scale: int | None = None,
) -> DataFrame:
    """Mean of ``value`` by hour of day, ordered; optionally of one month (of
    every year unless ``year`` is given). Empty when ``value`` is absent."""
    (ts,) = require_columns(df, [ts])
    found = lookup(df.columns, value)
    rows = df if month is None else in_month(df, ts, month, year)
    if found is None:
        rows = rows.select(column(ts), F.lit(None).cast("double").alias(value)).filter(F.lit(False))
    out = rows.groupBy(F.hour(column(ts)).alias(hour)).agg(_mean(found or value, scale).alias(name))
    return out.orderBy(hour)
