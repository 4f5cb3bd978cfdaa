"""Schema enforcement and column naming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.functions.casting import safe_cast
from stratalake.functions.names import column, lookup, require_columns


def enforce_schema(df: DataFrame, schema: T.StructType, on_missing: str = "error") -> DataFrame:
    """Cast to the declared columns, in declared order and casing; drop the rest.

    Names match without regard to case. A value that does not convert becomes
    null (``quality_report`` counts them). A declared column that is absent is
    an error, or a typed null with ``on_missing="null"``.
    """
    if on_missing not in ("error", "null"):
        raise ValueError(f"on_missing must be 'error' or 'null', not {on_missing!r}")
    if on_missing == "error":
        require_columns(df, schema.names)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        name = lookup(types, field.name)
        if name is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = safe_cast(column(name), types[name], field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def cast_via_string(df: DataFrame, schema: T.StructType) -> DataFrame:
    """As ``enforce_schema``, but every value goes through its text form, so
    all source types follow the one rule for text. Columns that have the type
    already stay as they are."""
    names = require_columns(df, schema.names)

    def through_text(name: str, target: T.DataType) -> Column:
        if df.schema[name].dataType == target:
            return column(name)
        return safe_cast(column(name).cast("string"), T.StringType(), target)

    return df.select(*[through_text(name, f.dataType).alias(f.name) for name, f in zip(names, schema.fields)])


def lower_names(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise AnalysisException(f"Lower-casing makes these names clash: {clashes}")
    return df.toDF(*names)
