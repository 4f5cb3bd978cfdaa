"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of a few entries, refined in
rounds from the parts of the smallest identifiers. A vector's code is the number of the nearest entry of each part.

Orchard's search: every entry of a codebook keeps the list of all entries by distance from it. A part starts at some entry
and walks that entry's list; an entry that is nearer (or as near, with a smaller number) becomes the current one, and the
walk goes on from the start of its list. Entries that were measured are marked and not measured again. By the triangle
inequality nothing beyond twice the current distance can be nearer, so the walk stops there: the result is exact. All
parts of a block of vectors walk at once, in numpy.

A round is one pass: tasks search and add up the parts of each entry, Spark adds up the tasks' sums, and the driver gets
one row per entry, component and word of 32 bits: sums are exact whatever their size. Numbers that are too large for
64-bit distances are searched as Python integers.

Defined results: a vector that is null or holds null or non-finite components is left out. So are vectors whose length is
not the most frequent one (the smaller of two) among the positive multiples of the number of parts. The first entries are
those of the first rows by identifier (nulls last), then by vector; with fewer rows there are fewer entries. Rows without
an identifier and repeated rows take part and are returned. Unused entries stay. Labels of null are one label. Errors
beyond 64 bits are the largest long. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.functions.matching import match_parts
from stratalake.functions.names import column
from stratalake.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components that a task searches at a time.
BLOCK = 1 << 20
LARGEST = (1 << 63) - 1


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where that is too narrow. ``scale`` is a power of two."""
    scaled = np.floor(values * float(scale))
    if not len(values) or np.abs(scaled).max() < 1 << 52:
        return scaled.astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 1 << 52 else int(np.floor(v * scale)) for v in values.tolist()], object)


def fitting(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as int64 if four times any squared distance fits, else both as Python integers."""
    if points.dtype != object and books.dtype != object:
        limit = isqrt((1 << 60) // points.shape[-1]) // 2
        if max(np.abs(points).max(initial=0), np.abs(books).max(initial=0)) < limit:
            return points, books
    return points.astype(object), books.astype(object)


def narrow(books: np.ndarray) -> np.ndarray:
    """As int64 where all numbers fit."""
    return books.astype(np.int64) if all(-(1 << 62) < v < 1 << 62 for v in books.ravel().tolist()) else books


def orchard(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance: points [vectors, parts, width], books [parts, entries, width]."""
    points, books = fitting(points, books)
    n, parts, width = points.shape
    k = books.shape[1]
    between = ((books[:, :, None] - books[:, None]) ** 2).sum(3)
    lists = np.argsort(between, axis=2, kind="stable")
    apart = np.take_along_axis(between, lists, 2)
    flat, own = points.reshape(-1, width), np.tile(np.arange(parts), n)
    # The walk starts at an entry with about the same sum of components.
    current = np.empty(n * parts, np.int64)
    for p in range(parts):
        sums = books[p].sum(1)
        order = np.argsort(sums, kind="stable")
        current[p::parts] = order[np.searchsorted(sums[order], flat[p::parts].sum(1)).clip(0, k - 1)]
    best = ((flat - books[own, current]) ** 2).sum(1)
    visited = np.zeros((n * parts, k), bool)
    visited[np.arange(n * parts), current] = True
    place = np.zeros(n * parts, np.int64)
    walking = np.arange(n * parts)
    while len(walking):
        at = own[walking], current[walking], place[walking]
        within = (apart[at] <= 4 * best[walking]).astype(bool)
        walking, near = walking[within], lists[at][within]
        place[walking] += 1
        new = ~visited[walking, near]
        rows, near = walking[new], near[new]
        visited[rows, near] = True
        found = ((flat[rows] - books[own[rows], near]) ** 2).sum(1)
        better = ((found < best[rows]) | ((found == best[rows]) & (near < current[rows]))).astype(bool)
        rows = rows[better]
        current[rows], best[rows], place[rows] = near[better], found[better], 0
        walking = walking[place[walking] < k]
    return current.reshape(n, parts), best.reshape(n, parts)


def limbs(value: int) -> list[int]:
    """Words of 32 bits, lowest first, each with the sign of the number."""
    sign, rest, out = (1 if value >= 0 else -1), abs(value), []
    while rest:
        out.append(sign * (rest & 0xFFFFFFFF))
        rest >>= 32
    return out


def blocks(batches: Iterator[pa.RecordBatch], parts: int, scale: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole batches with about BLOCK components, and their parts [rows, parts, width]; vectors are the last column."""

    def ready(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        values = table.column(table.num_columns - 1).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return table, whole(values, scale).reshape(len(table), parts, -1)

    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch.column(batch.num_columns - 1).flatten())
        if size >= BLOCK:
            yield ready(held)
            held, size = [], 0
    if held:
        yield ready(held)


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> DataFrame | None:
    """``vec_id, label, vector`` of the vectors that take part, as a table; None if there are none."""
    label = F.lit(None).cast("int") if label_col is None else column(label_col)
    given = rows.select(column(id_col).alias("vec_id"), label.alias("label"), column(vector_col).alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    given = given.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: bad(x.cast("double"))))
    given = given.filter((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    usual = given.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return None if usual is None else written(given.filter(F.size("vector") == usual.length), "vectors")


def first_entries(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    values = np.array([v for r in rows for v in r.vector], np.float64)
    return whole(values, scale).reshape(len(rows), parts, -1).transpose(1, 0, 2)


def refined(vectors: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after one more round."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), object)
        counts = np.zeros((parts, entries), np.int64)
        for _, points in blocks(batches, parts, scale):
            codes, _ = orchard(points, books)
            # Far below 2**63 / rows in 64 bits, else as Python integers.
            points = points if points.dtype == object or np.abs(points).max() < 1 << 40 else points.astype(object)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, first, number = np.unique(codes[order, p], return_index=True, return_counts=True)
                sums[p, used] += np.add.reduceat(points[order, p], first, axis=0).astype(object)
                counts[p, used] += number
        out = []
        for p, e in zip(*np.nonzero(counts)):
            out.append((p, e, -1, 0, counts[p, e]))
            out += [(p, e, d, i, v) for d in range(width) for i, v in enumerate(limbs(int(sums[p, e, d])))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["part", "entry", "at", "limb", "value"])

    tasks = vectors.select("vector").mapInArrow(add, "part long, entry long, at long, limb long, value long")
    totals = tasks.groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value")).collect()
    sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), object)
    for r in totals:
        if r["at"] < 0:
            counts[r.part, r.entry] = r.value
        else:
            sums[r.part, r.entry, r["at"]] += r.value << (32 * r.limb)
    out = books.astype(object)
    for p, e in zip(*np.nonzero(counts)):
        out[p, e] = sums[p, e] // counts[p, e]
    return narrow(out)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks [parts, entries, width] of the usable vectors after the given rounds."""
    books = first_entries(vectors, parts, entries, scale)
    for _ in range(rounds):
        books = refined(vectors, books, scale)
    return books


def encoded(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error`` of each usable vector; the code has two hex digits per part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, points in blocks(batches, len(books), scale):
            codes, errors = orchard(points, books)
            texts = [bytes(c).hex() for c in codes.astype(np.uint8)]
            total = [min(LARGEST, int(e)) for e in errors.astype(object).sum(1)]
            ids = [table.column(i).combine_chunks() for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(texts, pa.string()), pa.array(total, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return vectors.mapInArrow(encode, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decoded(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector that each code stands for, as doubles of the original scale."""
    values = (books.astype(np.float64) / scale).astype(np.float64)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()], np.int64).reshape(len(batch), len(values))
            found = values[np.arange(len(values)), number].reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.float64()))], [*batch.schema.names, "vector"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema.fields)
    return codes.mapInArrow(decode, f"{kinds}, vector array<double>")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each usable row. ``entries`` is at most 256."""
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col, label_col, parts)
    if vectors is None:
        kind = rows.select(column(id_col)).schema[0].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    books = codebooks(vectors, parts, entries, rounds, scale)
    codes = written(encoded(vectors, books, scale), "codes")
    match = match_parts({"label": F.col("label")}, {"label": codes.schema["label"].dataType}, "label_")
    keyed = codes.select("vec_id", "code", "error", *[c.alias(n) for n, c in match.items()])
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = keyed.groupBy(*match).agg(total.alias("label_error"))
    joined = keyed.alias("v").join(sums.alias("s"), reduce(and_, [F.col(f"v.{n}") == F.col(f"s.{n}") for n in match]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
