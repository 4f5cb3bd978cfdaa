"""Profiles and data-quality counts, one row per column or check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.functions.casting import safe_cast
from stratalake.functions.names import column, lookup, require_columns
from stratalake.operators.clean import DEFAULTS, TYPES
from stratalake.operators.dedup import unorderable

NUMERIC = T.NumericType
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def preview(df: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` rows Spark finds."""
    return df.limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string, nullable boolean")


def _unpivot(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, distinct: bool = False) -> DataFrame:
    """Per column: count, nulls, mean, stddev, min and max as text.

    Everything comes from one aggregate over the table; mean and stddev are
    null for columns that are not numbers, min and max for nested ones.
    ``distinct`` adds ``n_distinct``, an approximate count (5 % of standard
    deviation), null for maps and the like.
    """
    aggregates, rows = [], []
    for i, f in enumerate(df.schema.fields):
        c = column(f.name)
        number = c.cast("double") if isinstance(f.dataType, NUMERIC) else F.lit(None).cast("double")
        flat = isinstance(f.dataType, (NUMERIC, T.StringType, T.BooleanType, *TIMES))
        nothing = F.lit(None).cast("string")
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.count_if(c.isNull()).alias(f"z{i}"),
            F.avg(number).alias(f"a{i}"),
            F.stddev(number).alias(f"s{i}"),
            (F.min(c).cast("string") if flat else nothing).alias(f"l{i}"),
            (F.max(c).cast("string") if flat else nothing).alias(f"h{i}"),
        ]
        if distinct:
            count = F.lit(None).cast("bigint") if unorderable(f.dataType) else F.approx_count_distinct(c)
            aggregates.append(count.alias(f"d{i}"))
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("n_values"),
                F.col(f"z{i}").alias("n_nulls"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"l{i}").alias("min_value"),
                F.col(f"h{i}").alias("max_value"),
                *([F.col(f"d{i}").alias("n_distinct")] if distinct else []),
            )
        )
    return _unpivot(df.agg(*aggregates), rows)


def _sentinel(f: T.StructField) -> Column | None:
    if f.dataType in (T.LongType(), T.IntegerType(), T.DoubleType()):
        return None
    kind = next((k for k, t in TYPES.items() if t == f.dataType), None)
    return None if kind is None else F.lit(DEFAULTS[kind]).cast(f.dataType)


def quality_report(df: DataFrame, schema: T.StructType | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per column and check: ``rows``, ``missing_column``, ``nulls``,
    ``cast_failures`` against ``schema``, ``sentinels`` (values equal to the
    fillers of text and time columns) and ``duplicate_keys`` (rows beyond the
    first per key). One aggregate over the table, and one more for the keys.
    """
    checks: list[tuple[str | None, str, Column]] = [(None, "rows", F.count("*"))]
    for f in df.schema.fields:
        c = column(f.name)
        checks.append((f.name, "nulls", F.count_if(c.isNull())))
        sentinel = _sentinel(f)
        if sentinel is not None:
            checks.append((f.name, "sentinels", F.count_if(c.eqNullSafe(sentinel))))
    for f in schema.fields if schema is not None else []:
        name = lookup(df.columns, f.name)
        checks.append((f.name, "missing_column", F.max(F.lit(int(name is None)))))
        if name is not None:
            c = column(name)
            failed = c.isNotNull() & safe_cast(c, df.schema[name].dataType, f.dataType).isNull()
            checks.append((f.name, "cast_failures", F.count_if(failed)))
    aggregates = [F.coalesce(a, F.lit(0)).cast("bigint").alias(f"c{i}") for i, (_, _, a) in enumerate(checks)]
    rows = [
        F.struct(
            F.lit(name).cast("string").alias("column_name"), F.lit(check).alias("check"), F.col(f"c{i}").alias("n")
        )
        for i, (name, check, _) in enumerate(checks)
    ]
    report = _unpivot(df.agg(*aggregates), rows)
    if not keys:
        return report
    keys = require_columns(df, keys)
    repeats = df.groupBy(*[column(k) for k in keys]).agg((F.count("*") - 1).alias("more"))
    duplicates = repeats.agg(F.coalesce(F.sum("more"), F.lit(0)).cast("bigint").alias("n"))
    return report.unionByName(
        duplicates.select(F.lit(",".join(keys)).alias("column_name"), F.lit("duplicate_keys").alias("check"), "n")
    )
