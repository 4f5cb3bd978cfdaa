"""Removal of repeated passages by windows of content-defined chunks.

A gear rolling hash is taken at every word start, over the WINDOW bytes before it; a chunk starts where that hash is the
least within REACH words on both sides. The cuts depend on nearby bytes only, so an insertion moves a few chunks and
leaves all others as they were. A window is the shortest run of adjacent chunks with at least ``min_words`` words that
starts, or that ends, at a given chunk; its digest is that of all its bytes. The digest belongs to the smallest document
id that holds it. In all other documents the window is a repeat, and every chunk that lies in a repeat is cut out: what
is cut always stands in one piece in a document with a smaller id, and chunks that only other texts share, each for
itself, stay. Any run of chunks with ``min_words`` words is the union of the windows inside it, so runs that a smaller
document holds are cut from end to end. A passage of 50 words keeps its chunks but for a part of one at either end, which
is why the bound on runs is lower.

A digest has one row per document that holds it; rows are combined before the shuffle, the smallest id is an aggregate,
and the join back to the documents' windows has one row per digest on one side, so adaptive execution can split a digest
that a third of all documents hold.

Digests have 64 bits: a false repeat needs the digest of a window to collide with that of another text.

Defined results: null texts stay null, empty ones empty; rows with a null id own nothing and stay as they are; rows that
share an id count as one document and are all kept; repeats inside one document stay; white space around a removed
passage stays; text without word breaks is cut at wide characters; an empty table gives no rows. Other columns are
passed through; the helper columns have names no column of the input has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stratalake.functions.names import column, quoted
from stratalake.llm.common import PrefixHash, gear, row_blocks, strings, written

WINDOW, REACH = 16, 2
MIN_WORDS = 30
BLOCK = 2_000_000


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words start: bytes after ASCII white space, starts of texts, and wide (three- and four-byte) characters."""
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    start = ~white
    start[1:] &= white[:-1] | (data[1:] >= 0xE0)
    firsts = offsets[:-1][np.diff(offsets) > 0]
    start[firsts] = ~white[firsts]
    return np.flatnonzero(start)


def bounded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all chunks of a block of texts: bounds (one more than chunks), number of words. Texts start chunks."""
    words = word_starts(data, offsets)
    text = np.searchsorted(offsets, words, "right") - 1
    # a hash needs a whole window inside its text; all others are larger than any hash
    value = np.where(words - offsets[text] >= WINDOW, gear(data, WINDOW)[np.maximum(words - 1, 0)], 1 << WINDOW).astype(np.int64)
    far = np.full(REACH, 1 << 40, np.int64)
    padded = np.concatenate([far, value, far])
    cut = value < 1 << WINDOW
    for step in range(1, REACH + 1):
        before, after = padded[REACH - step : len(padded) - REACH - step], padded[REACH + step : len(padded) - REACH + step]
        same_before = np.concatenate([np.zeros(min(step, len(text)), bool), text[step:] == text[:-step]])
        same_after = np.concatenate([text[step:] == text[:-step], np.zeros(min(step, len(text)), bool)])
        cut &= ~same_before | (value < before)
        cut &= ~same_after | (value <= after)
    bounds = np.union1d(words[cut], offsets)
    return bounds, np.diff(np.searchsorted(words, bounds))


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all chunks of a block of texts: bounds (one more than chunks), digests, number of words."""
    bounds, held = bounded(data, offsets)
    return bounds, PrefixHash(data).of(bounds[:-1], bounds[1:]), held


def windows(data: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of a block of texts: text number, digest, first byte, end. No window leaves its text."""
    bounds, held = bounded(data, offsets)
    total = np.concatenate([[0], np.cumsum(held)])
    at = np.arange(len(held))
    text = np.searchsorted(offsets, bounds[:-1], "right") - 1
    low, high = np.searchsorted(bounds, offsets[text]), np.searchsorted(bounds, offsets[text + 1])
    # the shortest from each chunk on, and the shortest up to each chunk
    end = np.maximum(np.searchsorted(total, total[:-1] + min_words, "left"), at + 1)
    start = np.minimum(np.searchsorted(total, total[1:] - min_words, "right") - 1, at)
    on, to = end <= high, start >= low
    first, last = np.concatenate([at[on], start[to]]), np.concatenate([end[on], at[to] + 1])
    first, last = bounds[first], bounds[last]
    return np.concatenate([text[on], text[to]]), PrefixHash(data).of(first, last), first, last


def digests(docs: DataFrame, id_col: str, text_col: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``digest, doc``: one row for each distinct digest of a window of each row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column(1))
            for first, end in row_blocks(offsets, BLOCK):
                own = offsets[first : end + 1] - offsets[first]
                text, digest, _, _ = windows(data[offsets[first] : offsets[end]], own, min_words)
                order = np.lexsort((digest, text))
                digest, row = digest[order], text[order] + first
                new = np.ones(len(row), bool)
                new[1:] = (digest[1:] != digest[:-1]) | (row[1:] != row[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(digest[new].view(np.int64)), batch.column(0).take(pa.array(row[new]))], ["digest", "doc"])

    chosen = docs.select(column(id_col).alias("doc"), column(text_col).cast("string").alias("text")).filter("doc is not null and text is not null")
    return chosen.mapInArrow(cut, f"digest long, doc {chosen.schema['doc'].dataType.simpleString()}")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, digests``: of each document, the digests of windows that a document with a smaller id holds."""
    found = written(digests(docs, id_col, text_col, min_words), "chunks")
    shared = found.groupBy("digest").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).filter("owner < last")
    again = found.join(shared.select("digest", "owner"), "digest").filter("doc > owner")
    return again.groupBy("doc").agg(F.collect_list("digest").alias("digests"))


def passages(text: bytes, repeats: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """The byte spans to remove from a text, given the digests of its repeated windows: their union."""
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    _, digest, first, end = windows(data, offsets, min_words)
    again = np.isin(digest, repeats)
    spans: list[tuple[int, int]] = []
    for a, b in sorted(zip(first[again].tolist(), end[again].tolist())):
        if spans and a <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(b, spans[-1][1])
        else:
            spans.append((a, b))
    return spans


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, spans_col: str | None = None) -> DataFrame:
    """The rows with repeated passages cut out of ``text_col``; with ``spans_col``, also what was cut:
    ``array<struct<start, end>>``, in code points of the text before."""
    taken = {c.lower() for c in [*docs.columns, spans_col or ""]}
    key, held = ("_" * n + name for name, n in (("doc", 1), ("digests", 1)))
    while key in taken or held in taken:
        key, held = "_" + key, "_" + held
    found = repeated(docs, id_col, text_col, min_words).select(F.col("doc").alias(key), F.col("digests").alias(held))
    joined = docs.join(found, column(id_col) == F.col(key), "left")
    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])

    @F.arrow_udf(result)
    def cut(texts: pa.Array, repeats: pa.Array) -> pa.Array:
        out, spans = [], []
        for text, own in zip(texts, repeats):
            text, own = text.as_py(), np.array(own.as_py() or [], np.int64).view(np.uint64)
            found = passages(text.encode("utf-8"), own, min_words) if text and len(own) else []
            if found:
                raw, left, at, chars, said = text.encode("utf-8"), [], 0, 0, []
                for a, b in found:
                    kept, gone = raw[at:a].decode("utf-8"), raw[a:b].decode("utf-8")
                    said.append({"start": chars + len(kept), "end": chars + len(kept) + len(gone)})
                    left.append(kept)
                    chars, at = chars + len(kept) + len(gone), b
                text = "".join(left) + raw[at:].decode("utf-8")
            else:
                said = []
            out.append(text)
            spans.append(said)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(spans, span)], ["text", "spans"])

    done = joined.withColumn(held, cut(column(text_col).cast("string"), F.col(held)))
    columns = [F.col(f"{held}.text").alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns]
    return done.select(*columns, *([F.col(f"{held}.spans").alias(spans_col)] if spans_col else []))
