"""Bringing several sources to one layout."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.names import column, require_columns


def conform(df: DataFrame, layout: Mapping[str, Column | str | tuple[str, str]]) -> DataFrame:
    """One projection to a target layout.

    A text names a source column, ``(name, type)`` casts it, and a Column is
    used as it is (constants, typed nulls, derived values).
    """
    out = []
    for target, source in layout.items():
        if isinstance(source, Column):
            value = source
        elif isinstance(source, tuple):
            value = column(require_columns(df, [source[0]])[0]).try_cast(source[1])
        else:
            value = column(require_columns(df, [source])[0])
        out.append(value.alias(target))
    return df.select(*out)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def code_label(c: Column, labels: Mapping[str, str], default: str) -> Column:
    """A short code list as text; unknown codes and nulls give ``default``."""
    branch = F
    for code, label in labels.items():
        branch = branch.when(c == code, F.lit(label))
    return branch.otherwise(F.lit(default)) if labels else F.lit(default)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column some input lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
