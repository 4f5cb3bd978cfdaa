"""Deterministic de-duplication.

Every form is ``row_number() == 1`` over a total order, the shape Spark turns
into a group limit on both sides of the shuffle: a map task sends at most one
row per key, so a key holding most of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.functions.names import column, fresh_name, require_columns
from stratalake.operators.frequent import split_frequent


def unorderable(dtype: T.DataType) -> bool:
    """Whether values of the type have no order (maps, variants and what holds them)."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return unorderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(unorderable(f.dataType) for f in dtype.fields)
    return False


def _ordered(c: Column, direction: str, nulls: str) -> Column:
    if nulls == "last":
        return c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last()
    return c.asc() if direction == "asc" else c.desc()


def keep_one(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], direction: str = "desc", nulls: str = "last"
) -> DataFrame:
    """The first row per key by ``order_by``; nulls count as a key value.

    Ties are broken by all remaining columns, descending, so the survivor does
    not depend on partitioning. ``nulls="last"`` never prefers a null over a
    value; ``nulls="spark"`` uses Spark's own null order.
    """
    if direction not in ("asc", "desc") or nulls not in ("last", "spark"):
        raise ValueError(f"bad direction {direction!r} or nulls {nulls!r}")
    keys, order_by = require_columns(df, keys), require_columns(df, order_by)
    order = [_ordered(column(c), direction, nulls) for c in order_by if c not in keys]
    for f in df.schema.fields:
        if f.name not in keys and f.name not in order_by:
            c = F.to_json(column(f.name)) if unorderable(f.dataType) else column(f.name)
            order.append(c.desc_nulls_last())
    if not order:
        return df.dropDuplicates(keys)
    rank = fresh_name(df, "rank")
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def keep_one_ranged(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], along: str) -> DataFrame:
    """As ``keep_one``, with the rows left in ranges of the key ``along``, so that they can be written by anything that
    ascends with it and need no second shuffle for that.

    Rows of a range go to its task before they are reduced; those of frequent
    keys are reduced by ``keep_one`` on their own.
    """
    keys, (along,) = require_columns(df, keys), require_columns(df, [along])
    frequent, rest = split_frequent(df, keys)
    ranges = [column(along), *[column(k) for k in keys if k != along]]
    kept = keep_one(rest.repartitionByRange(*ranges), keys, order_by)
    return kept if frequent is None else kept.unionByName(keep_one(frequent, keys, order_by))


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], nulls: str = "last") -> DataFrame:
    return keep_one(df, keys, [order_by] if isinstance(order_by, str) else order_by, "desc", nulls)


def keep_max(df: DataFrame, keys: Sequence[str], by: str, nulls: str = "last") -> DataFrame:
    return keep_one(df, keys, [by], "desc", nulls)


def keep_min(df: DataFrame, keys: Sequence[str], by: str, nulls: str = "last") -> DataFrame:
    return keep_one(df, keys, [by], "asc", nulls)


def drop_duplicates(
    df: DataFrame, subset: Iterable[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Distinct rows, or one row per ``subset`` (first by ``order_by`` descending,
    then by the remaining columns)."""
    if subset is None:
        return df.dropDuplicates()
    return keep_one(df, list(subset), list(order_by))
