"""Mergeable sketches of columns per group, and drift between groups.

A sketch row holds, for one group and one column, the number of values and nulls, a quantile sketch (KLL) and a distinct
count sketch (HLL). Rows of groups merge into rows of coarser groups without reading the data again. With K = 1,000 a rank
is off by less than 0.4 % with 99 % confidence (exact up to about K values); with LG_K = 12 a distinct count by about 1.6 %
(one standard deviation; all but exact up to a few hundred values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.functions.bits import as_ordered
from stratalake.functions.names import column, require_columns

K, LG_K = 1000, 12
# Steps of the ranks at which two quantile functions are compared.
GRID = 100


def _number(c: Column, dtype: T.DataType) -> Column:
    """The value on the axis of the quantiles; texts have none."""
    return F.lit(None).cast("double") if isinstance(dtype, T.StringType) else as_ordered(c, dtype).cast("double")


def column_sketches(df: DataFrame, groups: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``groups, column_name, n_values, n_nulls, quantiles, distinct``: one map-side aggregate over the table.

    NaN is a value that counts as distinct and has no rank.
    """
    groups, cols = require_columns(df, groups), require_columns(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggregates, rows = [], []
    for i, c in enumerate(cols):
        number = _number(column(c), types[c])
        ranked = F.when(~F.isnan(number), number)
        aggregates += [
            F.count(column(c)).alias(f"n{i}"),
            F.count_if(column(c).isNull()).alias(f"z{i}"),
            F.kll_sketch_agg_double(ranked, K).alias(f"q{i}"),
            F.hll_sketch_agg(column(c).cast("string"), LG_K).alias(f"d{i}"),
        ]
        parts = {"n_values": f"n{i}", "n_nulls": f"z{i}", "quantiles": f"q{i}", "distinct": f"d{i}"}
        rows.append(F.struct(F.lit(c).alias("column_name"), *[F.col(v).alias(n) for n, v in parts.items()]))
    return df.groupBy(*map(column, groups)).agg(*aggregates).select(*map(column, groups), F.inline(F.array(*rows)))


def merged_sketches(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketch rows of coarser groups."""
    groups = require_columns(sketches, groups)
    return sketches.groupBy(*map(column, groups), "column_name").agg(
        F.sum("n_values").alias("n_values"),
        F.sum("n_nulls").alias("n_nulls"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def sketch_profile(sketches: DataFrame) -> DataFrame:
    """The sketch rows with ``n_distinct`` and the quartiles ``q25, q50, q75`` in place of the sketches; texts have none."""
    others = [column(c) for c in sketches.columns if c not in ("quantiles", "distinct")]
    known = F.kll_sketch_get_n_double("quantiles") > 0
    quartiles = [F.when(known, F.kll_sketch_get_quantile_double("quantiles", F.lit(p / 100))).alias(f"q{p}") for p in (25, 50, 75)]
    return sketches.select(*others, F.hll_sketch_estimate("distinct").alias("n_distinct"), *quartiles)


def _quantiles(sketch: str) -> Column:
    """Least, greatest and the values at GRID - 1 even ranks between."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit([i / GRID for i in range(GRID + 1)]))


def drift(sketches: DataFrame, order: str, groups: Sequence[str] = ()) -> DataFrame:
    """Each sketch row with ``previous``, the value of ``order`` in the row before it, and ``drift``: the largest gap between
    their two quantile functions, as a share of the range of both (0: the same), null where one of them has no ranks.

    The functions are compared at the least value, the greatest and GRID - 1
    ranks between; a quantile may be that of a rank beside, within the error of
    the sketch. ``groups`` are further group columns, within which ``order``
    moves.
    """
    (order,) = require_columns(sketches, [order])
    line = Window.partitionBy(*map(column, require_columns(sketches, groups)), "column_name").orderBy(column(order))
    rows = sketches.withColumns({"previous": F.lag(column(order)).over(line), "__before": F.lag("quantiles").over(line)})
    both = (F.kll_sketch_get_n_double("quantiles") > 0) & (F.kll_sketch_get_n_double("__before") > 0)
    one, other = _quantiles("quantiles"), _quantiles("__before")
    gap = F.array_max(F.zip_with(one, other, lambda a, b: F.abs(a - b)))
    span = F.greatest(F.get(one, F.lit(GRID)), F.get(other, F.lit(GRID))) - F.least(F.get(one, F.lit(0)), F.get(other, F.lit(0)))
    share = F.when(span > 0, gap / span).otherwise(F.lit(0.0))
    return rows.withColumn("drift", F.when(both, share)).drop("__before")
