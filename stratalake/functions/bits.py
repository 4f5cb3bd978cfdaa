"""Bucket numbers and bit interleaving for multi-column clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


def as_ordered(c: Column, dtype: T.DataType) -> Column:
    """What stands for a value in comparisons with bounds: texts themselves, all else as an order-preserving number."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    return c


def spread(number: int, step: int, offset: int) -> int:
    """Bit ``i`` of the number goes to bit ``i * step + offset``."""
    out, i = 0, 0
    while number >> i:
        out |= ((number >> i) & 1) << (i * step + offset)
        i += 1
    return out


def hilbert_index(point: Sequence[int], bits: int) -> int:
    """The place of a cell, given by ``bits`` bits per axis, on the Hilbert curve: cells that follow each other touch.

    The axes are turned and mirrored level by level (Skilling's transform), which leaves a Gray code to be dealt out.
    """
    x, n = list(point), len(point)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            if x[i] >> level & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    mirror = 0
    for level in range(bits - 1, 0, -1):
        if x[-1] >> level & 1:
            mirror ^= (1 << level) - 1
    out = 0
    for level in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ mirror) >> level & 1)
    return out


def bisected(c: Column, bounds: Sequence[float | str], leaves: Sequence[int]) -> Column:
    """``leaves[n]`` for the number n of ascending ``bounds`` that are <= c.

    A balanced tree of comparisons with constants at its leaves, so whatever
    the leaves stand for costs nothing per row. Null takes the first leaf.
    """

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(leaves[lo])
        mid = (lo + hi) // 2
        return F.when(c < F.lit(bounds[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return F.coalesce(F.when(c.isNotNull(), pick(0, len(bounds))), F.lit(leaves[0])).cast("bigint")


def interleaved(cols: Sequence[Column], bounds: Sequence[Sequence[float]], bits: int) -> Column:
    """Bucket numbers of the columns with their bits dealt out in turn."""
    n = len(cols)
    if n * bits > 63:
        raise ValueError(f"{n} columns of {bits} bits do not fit into 63 bits")
    out = F.lit(0).cast("bigint")
    for k, (c, own) in enumerate(zip(cols, bounds)):
        out = out.bitwiseOR(bisected(c, own, [spread(i, n, k) for i in range(len(own) + 1)]))
    return out
