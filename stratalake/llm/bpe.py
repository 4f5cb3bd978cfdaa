"""Byte-level BPE by reuse of content-defined chunks.

A gear rolling hash cuts the texts into chunks whose bounds depend on the nearby bytes alone, so documents that share
passages share chunks. A Python worker encodes each distinct chunk once and keeps its ids in a bounded cache. At a chunk
join the ids of both sides may be wrong. A window around the join is encoded anew and grows until both of its ends are
places where the tokenizer always parts tokens, and where the ids of the two chunks part as well: from there on the ids
of the chunks are those of the whole text.

Such a place is ASCII white space after a printable ASCII character: no pattern of the pre-tokenizer holds white
space after another character, it never looks back, and no special token holds white space.

Defined results: a null text is an empty one (no ids); very long texts are cut like all others; equal rows give equal
rows; an empty table gives no rows; columns other than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.functions.names import column
from stratalake.llm.common import gear, row_blocks, strings

#: Mean bytes of a chunk, least bytes between two cuts, bytes of text held in a worker's cache.
CHUNK, APART, CACHE = 1024, 64, 16_000_000
WINDOW = 16
BLOCK = 2_000_000
#: The pre-tokenizer's pattern (a fixed value of the byte-level family).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, all others for the code points from 256 on."""
    plain = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file, with the chunk cache of this worker."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.special = {t["content"]: t["id"] for t in stated.get("added_tokens", [])}
        letters = byte_letters()
        vocabulary = {t: i for t, i in stated["model"]["vocab"].items() if t not in self.special}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
        self.bytes_of = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = token
        self.lengths = np.array([len(t) for t in self.bytes_of], np.int64)
        self.digits = [b"%d," % i for i in range(len(self.bytes_of))]
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.allowed = set(self.special)
        self.chunks: dict[bytes, tuple] = {}
        self.held = 0

    def ids(self, text: bytes) -> list[int]:
        """The ids of a piece of text. Characters above Latin Extended-B go through the slower library,
        whose character classes are the ones asked for."""
        if not text:
            return []
        said = text.decode("utf-8")
        if max(text) >= 0xCA:
            return self.library.encode(said, add_special_tokens=False).ids
        return self.fast.encode(said, allowed_special=self.allowed, disallowed_special=())

    def chunk(self, text: bytes) -> tuple[list[int], int, int, int, int]:
        """Ids; bytes and ids before the first sure place; bytes and ids before the last (-1: there is none)."""
        known = self.chunks.get(text)
        if known is None:
            ids = self.ids(text)
            data = np.frombuffer(text, np.uint8)
            white = (data[1:] == 0x20) | ((data[1:] >= 0x09) & (data[1:] <= 0x0D))
            places = np.flatnonzero(white & (data[:-1] > 0x20) & (data[:-1] < 0x7F)) + 1
            known = (ids, -1, -1, -1, -1)
            if len(places):
                ends = np.cumsum(self.lengths[np.array(ids)])
                first, last = int(places[0]), int(places[-1])
                at = np.searchsorted(ends, [first, last])
                if (ends[at] == [first, last]).all():  # the chunk's own ids part there
                    known = (ids, first, int(at[0]) + 1, last, int(at[1]) + 1)
            if len(text) <= 64 * CHUNK:
                if self.held > CACHE:
                    self.chunks.clear()
                    self.held = 0
                self.chunks[text] = known
                self.held += len(text)
        return known

    def encode(self, chunks: list[bytes]) -> list[int]:
        """The ids of a text given as its chunks."""
        out: list[int] = []
        open_text = b""  # what is not encoded for good yet: from the last sure place on
        for text in chunks:
            ids, first, first_id, last, last_id = self.chunk(text)
            if first < 0:
                open_text += text  # no sure place: the window grows over the whole chunk
                continue
            out += self.ids(open_text + text[:first])
            out += ids[first_id:last_id]
            open_text = text[last:]
        return out + self.ids(open_text)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted bounds of the chunks of all texts of a block; each text's bounds are among them.

    A cut stands where the hash of the last WINDOW bytes is small, at the start of a character,
    unless another such place lies at most APART bytes before it.
    """
    places = np.flatnonzero(gear(data, WINDOW) < (1 << WINDOW) // CHUNK) + 1
    places = places[places < len(data)]
    places = places[(data[places] & 0xC0) != 0x80]
    starts = offsets[np.searchsorted(offsets, places, "right") - 1]
    places = places[places - starts >= WINDOW]  # the window lies in one text
    places = places[np.diff(places, prepend=-APART - 1) > APART]
    return np.union1d(places, offsets)


def encoded(texts: pa.Array, path: str) -> Iterator[list[int]]:
    """The ids of each text of a column."""
    coder = codec(path)
    data, offsets = strings(texts)
    for first, end in row_blocks(offsets, BLOCK):
        block = data[offsets[first] : offsets[end]]
        own = offsets[first : end + 1] - offsets[first]
        raw, bounds = block.tobytes(), cuts(block, own)
        at = np.searchsorted(bounds, own)
        bounds = bounds.tolist()
        for row in range(end - first):
            marks = bounds[at[row] : at[row + 1] + 1]
            yield coder.encode([raw[a:b] for a, b in zip(marks, marks[1:])])


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(encoded(batch.column(1), path), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    chosen = df.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(encode, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``, of each array of ids; null ids are left out, a null array is empty."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(i for i in ids or () if i is not None) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    chosen = df.select(column(id_col).alias("id"), column(ids_col).alias("ids"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: both directions in one pass, so that ids stay in the worker."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for ids in encoded(batch.column(1), path):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(b"".join(map(coder.digits.__getitem__, ids))[:-1]).hexdigest())
                text_sha.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = df.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
