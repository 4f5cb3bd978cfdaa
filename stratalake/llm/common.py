"""What the operators share: written tables, ragged byte arrays, rolling and polynomial hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.storage import shared_dir

U64 = np.uint64


#: Rows of an Arrow batch: texts are long, and a batch is held in the JVM and in the worker at once.
BATCH = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Lets the session send at most BATCH rows at a time to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, BATCH)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table after a write to the shared folder: cuts the lineage, so that
    lost executors cost no recomputation, and is computed once."""
    spark: SparkSession = df.sparkSession
    bounded_batches(spark)
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than rows) of a text or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(wide)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(wide) else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all elements of the given ranges, range after range."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words: every bit depends on all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A pseudo-random 64-bit word for each byte value.
GEAR = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = U64(0x9FB21C651E98DF25)


class PrefixHash:
    """Hashes of byte ranges of one array, each from two entries of its prefix sums.

    The hash of a range is the sum of GEAR[byte] * BASE**position modulo 2**64, times BASE**-start,
    finalised together with the length: equal ranges have equal hashes wherever they stand.
    """

    powers = np.ones(1, U64)
    inverse = np.ones(1, U64)

    @classmethod
    def tables(cls, n: int) -> None:
        if len(cls.powers) < n:
            n = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                steps = np.full(n, BASE, U64)
                steps[0] = 1
                cls.powers = np.multiply.accumulate(steps)
                steps[1:] = U64(pow(int(BASE), -1, 1 << 64))
                cls.inverse = np.multiply.accumulate(steps)

    def __init__(self, data: np.ndarray):
        self.tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(GEAR[data] * self.powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def gear(data: np.ndarray, window: int = 16) -> np.ndarray:
    """The gear rolling hash over the last ``window`` (a power of two) bytes at each position, as uint32.

    The hash h = (h << 1) + GEAR[byte] forgets a byte once it is shifted out; only the low ``window`` bits,
    which depend on the last ``window`` bytes alone, are kept. Sums of doubling spans give it without a loop.
    """
    h = (GEAR[data] & U64(0xFFFFFFFF)).astype(np.uint32)
    span = 1
    while span < window:
        h[span:] += h[:-span] << np.uint32(span)  # the right side is built before the sum
        span *= 2
    return h & np.uint32((1 << window) - 1)


def rolling(data: np.ndarray, window: int) -> np.ndarray:
    """A 32-bit polynomial hash of the last ``window`` (a power of two) bytes at each position."""
    h = (GEAR[data] >> U64(32)).astype(np.uint32)
    span, factor = 1, 0x85EBCA6B
    while span < window:
        h[span:] += h[:-span] * np.uint32(factor)
        span, factor = 2 * span, factor * factor & 0xFFFFFFFF
    return h
