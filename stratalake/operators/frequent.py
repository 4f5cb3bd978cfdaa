"""Keys that hold a large share of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from stratalake.functions.names import column, fresh_name, quoted, require_columns

# Rows of a sample, about, and the share of them that makes a key frequent.
SAMPLE, SHARE, SEED = 20_000, 0.005, 42


def split_frequent(df: DataFrame, keys: Sequence[str], like: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame]:
    """The rows of frequent keys (nothing if there are none), and all others.

    A sample says which keys are frequent; 2 / SHARE of them at most come to
    the driver. It is taken from ``like`` if given, a DataFrame with about the
    same keys that is cheaper to read. Every row is in one of both parts
    whatever the sample holds.
    """
    keys = require_columns(df, keys)
    like = df if like is None else like
    rows = like.count()
    if not rows:
        return None, df
    n = fresh_name(df, "n")
    sample = like.select(*map(column, keys)).sample(min(1.0, SAMPLE / rows), SEED)
    counts = sample.groupBy(*map(column, keys)).agg(F.count("*").alias(n))
    found = counts.filter(F.col(n) >= max(2, SHARE * min(rows, SAMPLE))).drop(n)
    wanted = found.collect()
    if not wanted:
        return None, df
    hot = F.broadcast(df.sparkSession.createDataFrame(wanted, found.schema)).alias("s")
    same = reduce(and_, [F.col(f"t.{quoted(k)}").eqNullSafe(F.col(f"s.{quoted(k)}")) for k in keys])
    part = lambda how: df.alias("t").join(hot, same, how)
    return part("left_semi"), part("left_anti")
