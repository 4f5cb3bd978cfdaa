"""Null filling and text cleaning; each operator is one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.fixed import FILLERS
from stratalake.functions.casting import safe_cast
from stratalake.functions.dates import zone_to_utc
from stratalake.functions.names import column, require_columns

# ``bigint`` and ``timestamp_ntz`` are separate keys: filling "int" or
# "timestamp" columns leaves them alone unless they are asked for.
TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}
DEFAULTS = {**FILLERS, "bigint": FILLERS["int"], "timestamp_ntz": FILLERS["timestamp"]}
NUMERIC = ("int", "bigint", "double")
STANDARD_KINDS = ("string", "int", "double", "date", "timestamp", "timestamp_ntz")

Rule = Callable[[T.StructField, Column], Column]


def _rewrite(df: DataFrame, rule: Rule) -> DataFrame:
    return df.select(*[rule(f, column(f.name)).alias(f.name) for f in df.schema.fields])


def _checked_kind(kind: str) -> str:
    if kind not in TYPES:
        raise ValueError(f"Unsupported type {kind!r}; choose one of {sorted(TYPES)}")
    return kind


def _filled(c: Column, source: T.DataType, kind: str, default: object | None) -> Column:
    target = TYPES[kind]
    if kind == "timestamp" and isinstance(source, T.TimestampNTZType):
        target = source
    filler = F.lit(DEFAULTS[kind] if default is None else default).cast(target)
    if kind in NUMERIC and source != target:
        # Only a missing value is filled; one that does not convert stays null.
        return F.when(c.isNotNull(), safe_cast(c, source, target)).otherwise(filler)
    return F.coalesce(c.cast(target) if kind == "string" else c, filler)


def fill_nulls(df: DataFrame, cols: Iterable[str], kind: str, default: object | None = None) -> DataFrame:
    """Fill nulls of the named columns with the filler of ``kind`` or ``default``."""
    _checked_kind(kind)
    chosen = set(require_columns(df, cols))
    return _rewrite(df, lambda f, c: _filled(c, f.dataType, kind, default) if f.name in chosen else c)


def fill_by_type(df: DataFrame, kind: str, default: object | None = None) -> DataFrame:
    """Fill nulls of every column whose type is ``kind``."""
    wanted = TYPES[_checked_kind(kind)]
    return fill_nulls(df, [f.name for f in df.schema.fields if f.dataType == wanted], kind, default)


def trim_strings(df: DataFrame, blank_to_null: bool = False) -> DataFrame:
    """Strip spaces (not tabs) around every text; blank texts stay unless asked."""

    def rule(f: T.StructField, c: Column) -> Column:
        if not isinstance(f.dataType, T.StringType):
            return c
        return F.nullif(F.trim(c), F.lit("")) if blank_to_null else F.trim(c)

    return _rewrite(df, rule)


def upper_strings(df: DataFrame) -> DataFrame:
    return _rewrite(df, lambda f, c: F.upper(c) if isinstance(f.dataType, T.StringType) else c)


def to_utc(df: DataFrame, cols: Iterable[str], source_tz: str = "UTC") -> DataFrame:
    """Read the named wall-clock times as ``source_tz`` and shift them to UTC."""
    chosen = set(require_columns(df, cols))
    return _rewrite(df, lambda f, c: zone_to_utc(c, f.dataType, source_tz) if f.name in chosen else c)


def standard_clean(df: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Trim texts, fill nulls of the standard types, bring timestamps to UTC.

    Big integers keep their nulls: a made-up identifier would join.
    """
    kinds = {TYPES[k]: k for k in STANDARD_KINDS}
    times = (T.TimestampType, T.TimestampNTZType)

    def rule(f: T.StructField, c: Column) -> Column:
        if isinstance(f.dataType, T.StringType):
            c = F.trim(c)
        kind = kinds.get(f.dataType)
        if kind is not None:
            c = _filled(c, f.dataType, kind, None)
        if isinstance(f.dataType, times):
            c = zone_to_utc(c, f.dataType, source_tz)
        return c

    return _rewrite(df, rule)
