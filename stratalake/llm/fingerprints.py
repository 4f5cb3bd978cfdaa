"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last WINDOW bytes triggers the end of a piece where it is small for the block size, so piece
bounds follow the content. Each piece gives one of 64 letters. A fingerprint is ``size:letters:letters`` with the pieces
of block size b and of 2b: texts whose block sizes differ by a factor of two still have letters at a common size. At
most LETTERS letters are kept; the last one stands for all the rest of the text. Likeness is 1 - distance / length, with
the edit distance (insertions and deletions) and the total length of two letter strings of a common block size; strings
without COMMON letters in a row in common (short ones: a third of the shorter) are not alike. The block size follows the
length of the text alone.

The next document by descending id is found without one big sort: ids are cut at quantiles, each range is one sorted
group that streams through a task, and the first document of each range also goes to the range before it.

Defined results: a null text is an empty one; empty texts have the fingerprint ``3::``; equal fingerprints have likeness
1; rows with equal ids follow each other by text, null ids come last; the only row is its own next; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.functions.bits import bisected
from stratalake.functions.names import column
from stratalake.llm.common import mixed, rolling

LEAST, LETTERS, COMMON = 3, 64, 4
WINDOW, MOST = 8, 1 << 32
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Bytes that are hashed at a time.
STEP = 1 << 20


class Pieces:
    """The possible piece ends of a text (those at block size ``size``; larger sizes use some of them), the rolling hash
    at each, and a running sum of rolling hashes, whose differences are the hashes of pieces: the bytes that the first
    sums of a piece still see before it are the ones that triggered its start."""

    def __init__(self, data: np.ndarray, size: int):
        ends, values, sums, total = [], [], [], np.uint64(0)
        for at in range(0, len(data), STEP):
            before = min(at, WINDOW - 1)
            h = rolling(data[at - before : at + STEP], WINDOW)[before:]
            hit = np.flatnonzero(h < MOST // size)
            hit = hit[hit + at + 1 >= WINDOW]
            run = np.cumsum(mixed(h.astype(np.uint64))) + total
            total = run[-1]
            ends.append(hit + at + 1)
            values.append(h[hit])
            sums.append(run[hit])
        self.length, self.total = len(data), total
        self.ends, self.values, self.sums = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (ends, values, sums))

    def letters(self, size: int, most: int) -> str:
        """One letter for each piece; the last piece reaches the end of the text."""
        if not self.length:
            return ""
        own = np.flatnonzero((self.values < MOST // size) & (self.ends < self.length))[: most - 1]
        sums = np.concatenate([[np.uint64(0)], self.sums[own], [self.total]])
        ends = np.concatenate([[0], self.ends[own], [self.length]]).astype(np.uint64)
        return ALPHABET[(mixed(np.diff(sums) + np.diff(ends)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    size = LEAST
    while size * LETTERS < len(data):
        size *= 2
    pieces = Pieces(data, size)
    return f"{size}:{pieces.letters(size, LETTERS)}:{pieces.letters(2 * size, LETTERS // 2)}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step per letter of ``b``."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & places.get(letter, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def alike(a: str, b: str) -> float:
    """Likeness of two letter strings of the same block size."""
    if not a or not b:
        return 0.0
    n = max(1, min(COMMON, len(a) // 3, len(b) // 3))
    if not {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}:
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    if one == two:
        return 1.0
    (size, small, large), (other, its_small, its_large) = one.split(":"), two.split(":")
    size, other = int(size), int(other)
    if size == other:
        return max(alike(small, its_small), alike(large, its_large))
    if size == 2 * other:
        return alike(small, its_large)
    return alike(large, its_small) if other == 2 * size else 0.0


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """``range, tail, id, text``, in partitions that hold whole ranges, sorted: by descending id within a range, and
    last, with ``tail`` 1, a copy of the rows that come first in the range that follows (after the last: the first)."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [i / ranges for i in range(1, ranges)]
    cuts = sorted({float(q) for q in rows.select("id").approxQuantile("id", marks, 0.2 / ranges)}) if marks else []
    rows = rows.select(bisected(F.col("id"), cuts, range(len(cuts) + 1)).alias("range"), F.lit(0).alias("tail"), "id", "text")
    firsts = sorted((r[0], r[1]) for r in rows.groupBy("range").agg(F.max("id")).collect())
    if not firsts:
        return rows
    # ranges ascend with the ids, so the head of range i goes to range i + 1, the head of the last to the first
    heads = [(head, firsts[(i + 1) % len(firsts)][0]) for i, (_, head) in enumerate(firsts)]
    heads = spark.createDataFrame(heads, T.StructType([T.StructField("head", rows.schema["id"].dataType), T.StructField("into", T.LongType())]))
    copies = rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head"))).select(F.col("into").alias("range"), F.lit(1).alias("tail"), "id", "text")
    sorting = ["range", "tail", F.col("id").desc_nulls_last(), "text"]
    return rows.unionByName(copies).repartition(len(firsts), "range").sortWithinPartitions(*sorting)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each row.

    The edited text has the last third of the code points replaced by as many first ones of the next document.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = with_next(docs, id_col, text_col, ranges)
    kind = rows.schema["id"].dataType

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        ids = to_arrow_type(kind)
        types = [ids, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        out: list[tuple] = []

        def stream() -> Iterator[tuple]:
            for batch in batches:
                for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                    yield from zip(*(part.column(i).to_pylist() for i in range(4)))

        for _, group in groupby(stream(), key=lambda row: row[0]):
            held = None  # id, text, fingerprint of the row whose next one comes now
            for _, tail, key, text in group:
                print_ = fingerprint(text)
                if held is not None:
                    n = len(held[1])
                    edited = held[1][: n - n // 3] + text[: n // 3]
                    own = fingerprint(edited)
                    sha = hashlib.sha256(edited.encode("utf-8")).hexdigest()
                    out.append((held[0], n, sha, held[2], own, likeness(held[2], own), likeness(held[2], print_)))
                    if len(out) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out.clear()
                held = (key, text, print_)
                if tail:
                    break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    schema = f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(compare, schema)
