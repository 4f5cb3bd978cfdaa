"""A look at landing data: schema, first row and statistics per feed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stratalake.operators.quality import preview, profile, schema_rows
from stratalake.operators.schema import cast_via_string
from stratalake.sources.feeds import FEEDS


def inspect(df: DataFrame, schema) -> dict[str, DataFrame]:
    """``schema``, ``first`` and ``profile`` of the data under a declared schema."""
    typed = cast_via_string(df, schema)
    return {"schema": schema_rows(typed), "first": preview(typed), "profile": profile(typed)}


def inspect_feeds(frames: Mapping[str, DataFrame]) -> dict[str, dict[str, DataFrame] | Exception]:
    """``inspect`` per feed; a feed that fails yields its error, the others go on."""
    out: dict[str, dict[str, DataFrame] | Exception] = {}
    for name, df in frames.items():
        try:
            out[name] = inspect(df, FEEDS[name].schema)
        except Exception as error:
            out[name] = error
    return out
