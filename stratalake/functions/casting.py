"""Casts that give null for a bad value, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


# Text that is a number; the check is far cheaper than a cast that fails.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def text_to_bigint(c: Column) -> Column:
    """'1.0', '1.9' and '1.0E10' are integers too (truncated); junk is null.

    The way through a decimal keeps all 64 bits, which a double would not.
    """
    return F.when(c.rlike(NUMBER), c.try_cast("decimal(38,18)").try_cast("bigint"))


def safe_cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return c
    if isinstance(source, T.StringType) and isinstance(target, INTEGRAL):
        return text_to_bigint(c).try_cast(target)
    if isinstance(target, T.StringType):
        return c.cast(target)
    return c.try_cast(target)
