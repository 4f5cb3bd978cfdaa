"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break. In texts and roles a
backslash is put between ``<`` and ``|`` (one more if there are some already), so no control string can come from a
text, and taking one away again gives the text back; line breaks and backslashes of a role are escaped as well.

A turn is formatted by itself, so a conversation of any length may spread over tasks: rows are sorted by conversation
and turn, and each batch of rows is assembled at once. Segment lengths give the offsets of all segments, and numpy
scatters headers, texts and ends into one buffer, which is the column of formatted text. A row of the output is a
segment of a conversation: all its turns, or as many as lie in one batch; ``start_turn`` orders the segments.

Defined results: a null text is empty, a null role too; rows with equal conversation and turn are ordered by role and
text; a null turn comes first; rows with a null id are one conversation; repeated rows are repeated turns; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import ragged, strings

OPEN, BREAK, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
#: Bytes that are scattered at a time; longer segments are copied whole.
STEP, LONG = 1 << 20, 1 << 14
#: Bytes of text in one output row, but for a single longer turn.
ROW = 1 << 22


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(roles: pa.Array) -> pa.Array:
    roles = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    return escaped(roles)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescaped(role))


def scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copies the ranges of ``data`` to the places ``to``: short ones by index, in steps of bounded size."""
    for i in np.flatnonzero(lengths > LONG):
        out[to[i] : to[i] + lengths[i]] = data[starts[i] : starts[i] + lengths[i]]
    own = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    ends = np.cumsum(lengths[own])
    at = 0
    while at < len(own):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        some = own[at:stop]
        out[ragged(to[some], lengths[some])] = data[ragged(starts[some], lengths[some])]
        at = stop


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns one after the other; bounds of turns; bounds of the texts in them."""
    parts = [strings(escaped_role(roles)), strings(escaped(texts))]
    n = len(roles)
    (role, role_at), (text, text_at) = parts
    fixed = [np.frombuffer(b, np.uint8) for b in (OPEN, BREAK, CLOSE)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(f) for f in fixed)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    places = np.concatenate([[0], np.cumsum(lengths.ravel())])
    at = places[:-1].reshape(n, 5)
    out = np.empty(places[-1], np.uint8)
    for i, f in zip((0, 2, 4), fixed):
        scatter(out, at[:, i], f, np.zeros(n, np.int64), lengths[:, i])
    scatter(out, at[:, 1], role, role_at[:-1], lengths[:, 1])
    scatter(out, at[:, 3], text, text_at[:-1], lengths[:, 3])
    return out, np.append(at[:, 0], places[-1]), at[:, 3], at[:, 3] + lengths[:, 3]


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """``conv_id, start_turn, start_role, part, formatted (binary), loss (array of start, end bytes)``: segments, which are in
    order by their number ``part`` within ``start_turn`` order; see ``sorted_segments``."""
    chosen = rows.select(
        column(conv_col).alias("conv_id"), column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    ranged = chosen.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions(*order)
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    names = ["conv_id", "start_turn", "start_role", "part", "formatted", "loss"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out, bounds, text_from, text_to = assembled(batch.column(2), batch.column(3))
            ids, learn = batch.column(0), pc.equal(batch.column(2), loss_role).to_numpy(zero_copy_only=False)
            same = pc.fill_null(pc.equal(ids.slice(1), ids.slice(0, len(ids) - 1)), False).to_numpy(zero_copy_only=False)
            nulls = pc.is_null(ids).to_numpy(zero_copy_only=False)
            same = same | (nulls[1:] & nulls[:-1])
            sizes = bounds[1:-1] // ROW != bounds[:-2] // ROW
            first = np.flatnonzero(np.concatenate([[True], ~same | sizes]))
            rows_at = np.append(first, batch.num_rows)
            offsets = bounds[rows_at]
            # one buffer holds the formatted column
            formatted = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())
            row_of = np.repeat(np.arange(len(first)), np.diff(rows_at))
            spans = np.stack([text_from, text_to], 1) - offsets[row_of][:, None]
            per_row = np.bincount(row_of[learn], minlength=len(first))
            span = pa.StructArray.from_arrays([pa.array(spans[learn, 0]), pa.array(spans[learn, 1])], ["start", "end"])
            loss = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), span)
            chosen_rows = pa.array(first)
            numbers = pa.array(np.arange(part, part + len(first)))
            part += len(first)
            yield pa.RecordBatch.from_arrays([ids.take(chosen_rows), batch.column(1).take(chosen_rows), batch.column(2).take(chosen_rows), numbers, formatted, loss], names)

    schema = f"conv_id {kinds['conv_id']}, start_turn {kinds['turn']}, start_role string, part long, formatted binary, loss array<struct<start: long, end: long>>"
    return ranged.mapInArrow(assemble, schema)


def sorted_segments(formatted: DataFrame) -> DataFrame:
    """Segments of a conversation in one partition, in order. Turns of equal number and role may lie in one task only,
    so (start_turn, start_role, part) is the order of the turns."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "start_turn", "start_role", "part")


TURN = re.compile(re.escape(OPEN.decode()) + "([^\n]*)\n(.*?)" + re.escape(CLOSE.decode()), re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    return [(unescaped_role(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from the segments, which
    stream through a task: a hash of all turns needs them one after the other, but never all at once."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, False, []

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                ids = pa.array([o[0] for o in out], ids_type)
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([o[i + 1] for o in out], t) for i, t in enumerate(types))], names)
                out.clear()

        ids_type = None
        for batch in batches:
            ids_type = batch.column(0).type
            for key, raw, loss in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                if not held or key != now:
                    if held:
                        out.append((now, turns, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars))
                    now, held, turns, loss_chars, chars = key, True, 0, 0, 0
                    turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
                text = raw.decode("utf-8")
                chars += len(text)
                for role, said in read_turns(text):
                    turns += 1
                    turns_sha.update(f"{role}\n{said}\n".encode("utf-8"))
                for span in loss:
                    said = unescaped(raw[span["start"] : span["end"]].decode("utf-8"))
                    loss_chars += len(said)
                    loss_sha.update(said.encode("utf-8"))
            if len(out) >= 1000:
                yield from flush()
        if held:
            out.append((now, turns, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars))
        yield from flush()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return sorted_segments(formatted).mapInArrow(digest, schema)
