"""Packing of token sequences by non-negative least squares over a length histogram.

Every document's ids (and an end id) are cut at multiples of the window; a cut leaves full windows and one remainder.
Piece lengths are rounded up to at most 384 bins, narrow where lengths are frequent. All combinations of up to DEPTH bins
that fill the window (all but 1/1024 of it at most) are the columns of a matrix; non-negative least squares finds how often to use
each so that together they use up the histogram. Combinations of more pieces come in one at a time, each the steepest for
what the solution so far leaves, found by a bounded knapsack: short pieces take part like long ones. The counts are rounded
to what the bins hold, and what is left is solved again. The k-th piece of a bin then belongs to the combination, and to the
repetition of it, whose share of the bin covers k; the odd rest is packed best fit, longest first, in groups of bounded
size. Only the histogram (one row per length up to the window) reaches the driver, and the plan it sends back has a row per
bin of each used combination at most; ranks within a bin come from shard counts, so no task holds a whole bin, nor all of
many identical rows.

Defined results: a null or empty text is one piece with the end id alone; ids may repeat, each row is packed by itself;
very long texts are encoded whole and
cut into windows; an empty table gives no rows; columns other than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalake.functions.names import column
from stratalake.llm.bpe import byte_letters
from stratalake.llm.common import written

WINDOW, END = 4096, 2
#: Bins of lengths; depth of the enumerated combinations; share of the tokens that a solution may leave; rounds of solving.
BINS, DEPTH, CLOSE, ROUNDS = 384, 3, 0.01, 8
#: Pieces in one shard of a bin, and in one group of the greedy rest.
SHARD = 50_000
#: Words in a worker's cache.
WORDS = 200_000
#: Words that are handled here (ASCII and the letters U+00C0 to U+017F but U+0130, all of them in composed form and with
#: plain lower case), and the pieces of their lower-cased form: the tokenizer's pattern over these characters.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u017f]+|[0-9]|[^a-z0-9\u00c0-\u017f]+")
#: Python's white space that is none to the tokenizer: such texts go to the library whole.
ODD_SPACE = re.compile("[\x1c-\x1f]")


class WordCoder:
    """Ids of whole texts under a tokenizer that drops white space and never looks across it.

    Each distinct word is encoded once and kept in a bounded cache. Words of ASCII and accented Latin letters are cut
    into the tokenizer's pieces here and merged in one call for all new words: a piece ends in a zero byte that stands
    for the end mark of the vocabulary, so that plain byte-pair merging by id gives the same ids. All other words, and
    texts with odd white space, go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, mark = stated["model"], stated["model"].get("end_of_word_suffix") or ""
        added = {t["content"] for t in stated.get("added_tokens", [])}
        merged = [model["vocab"]["".join(pair)] for pair in model["merges"]]
        if not mark or merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of the merges, or words have no end mark")
        letters = byte_letters()
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in added:
                ends = len(token) > len(mark) and token.endswith(mark)
                ranks[bytes(letters[c] for c in (token[: -len(mark)] if ends else token)) + b"\0" * ends] = i
        self.merges = tiktoken.Encoding("pieces", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.last = np.zeros(max(ranks.values()) + 1, bool)
        self.last[[i for token, i in ranks.items() if len(token) > 1 and token.endswith(b"\0")]] = True

    def packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: set[str]) -> None:
        plain = [w for w in new if PLAIN.fullmatch(w) and "<|" not in w]
        if plain:
            cut = [PIECE.findall(w.lower()) for w in plain]
            ids = np.array(self.merges.encode_ordinary("".join([p + "\0" for pieces in cut for p in pieces])), "<u4")
            piece_ends = np.flatnonzero(self.last[ids]) + 1
            ends = 4 * piece_ends[np.cumsum([len(pieces) for pieces in cut]) - 1]
            raw, start = ids.tobytes(), 0
            for word, end in zip(plain, ends.tolist()):
                self.words[word] = raw[start:end]
                start = end
        others = [w for w in new if w not in self.words]
        self.words.update(zip(others, self.packed(others)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit words."""
        odd = {i for i, t in enumerate(texts) if ODD_SPACE.search(t)}
        split = [[] if i in odd else t.split() for i, t in enumerate(texts)]
        if len(self.words) > WORDS:
            self.words.clear()
        self.learn(set().union(*split) - self.words.keys())
        known = self.words
        for i, words in enumerate(split):
            yield self.packed([texts[i]])[0] if i in odd else b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def token_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of each piece, with ``keep_ids`` also ``ids`` (little-endian
    unsigned 32-bit words)."""
    tail = np.array([end_id], "<u4").tobytes()
    names = ["row", "start", "length", "ids_crc32", "doc_tokens", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                out: dict[str, list] = {n: [] for n in names}
                for row, ids in enumerate(coder(path).encode(texts)):
                    ids += tail
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        for name, value in zip(names, (row, start, len(piece) // 4, zlib.crc32(piece), total, piece if keep_ids else None)):
                            out[name].append(value)
                rows = out.pop("row")
                arrays = [part.column(0).take(pa.array(rows, pa.int64()))]
                arrays += [pa.array(out[n], pa.int64()) for n in names[1:5]]
                arrays += [pa.array(out["ids"], pa.binary())] if keep_ids else []
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names[1 : 6 if keep_ids else 5]])
        coder.cache_clear()  # a worker goes on to other work, and the vocabulary with its words is large

    chosen = df.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    more = ", ids binary" if keep_ids else ""
    return chosen.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{more}")


def bin_sizes(histogram: np.ndarray, most: int = BINS) -> np.ndarray:
    """The bin of each length, as the largest length in it: at most ``most`` bins, narrow where many pieces are (the square
    root of the density, which keeps the sum of what is rounded up least)."""
    weight = np.sqrt(histogram)
    if np.count_nonzero(histogram) <= most:
        return np.where(histogram > 0, np.arange(len(histogram)), 0)
    number = np.minimum((np.cumsum(weight) - weight) * (most - 1) // weight.sum(), most - 1).astype(int)
    number[-1] = most  # whole windows are a bin of their own
    present = np.flatnonzero(histogram)
    largest = np.zeros(most + 1, np.int64)
    np.maximum.at(largest, number[present], present)
    return np.where(histogram > 0, largest[number], 0)


def combinations(sizes: np.ndarray, least: int, window: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All non-descending tuples of at most ``depth`` of the (ascending) sizes whose sum is from ``least`` to ``window``."""

    def below(low: int, high: int, first: int, more: int) -> Iterator[tuple[int, ...]]:
        ends = sizes[max(first, int(np.searchsorted(sizes, low))) : int(np.searchsorted(sizes, high, "right"))]
        yield from ((int(n),) for n in ends)
        if more > 1:
            for i in range(first, int(np.searchsorted(sizes, high // 2, "right"))):
                n = int(sizes[i])
                for rest in below(low - n, high - n, i, more - 1):
                    yield (n, *rest)

    return list(below(least, window, 0, depth))


def best_combination(worth: np.ndarray, sizes: np.ndarray, counts: np.ndarray, least: int, window: int) -> np.ndarray | None:
    """How many pieces of each size to take, at most ``counts``, for the greatest sum of ``worth`` among all combinations of
    any depth with ``least`` to ``window`` tokens: a bounded knapsack, the counts split into powers of two."""
    items = []
    for i, (size, count) in enumerate(zip(sizes.tolist(), np.minimum(counts, window // sizes).tolist())):
        some = 1
        while count > 0:
            some = min(some, count)
            items.append((i, some, some * size, some * float(worth[i])))
            count, some = count - some, 2 * some
    best = np.full(window + 1, -np.inf)
    best[0] = 0.0
    taken = np.zeros((len(items), window + 1), bool)
    for at, (_, _, size, gain) in enumerate(items):
        if size <= window:
            more = best[:-size] + gain
            np.greater(more, best[size:], out=taken[at, size:])
            np.maximum(more, best[size:], out=best[size:])
    room = least + int(np.argmax(best[least:]))
    if not np.isfinite(best[room]):
        return None
    chosen = np.zeros(len(sizes), np.int64)
    for at in range(len(items) - 1, -1, -1):
        if taken[at, room]:
            chosen[items[at][0]] += items[at][1]
            room -= items[at][2]
    return chosen


def least_squares(matrix: np.ndarray, target: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """x >= 0 with the least |matrix x - target|, by active sets: at most one positive entry for each row of the matrix,
    so the entries are large enough to be rounded. ``start`` is the solution over the first columns of the matrix."""
    x, active = np.zeros(matrix.shape[1]), np.zeros(matrix.shape[1], bool)
    if start is not None:
        x[: len(start)] = start
        active[: len(start)] = start > 0
    slack = 1e-9 * max(1.0, float(target.max(initial=0)))
    for _ in range(3 * len(target)):
        own = np.flatnonzero(active)
        slope = matrix.T @ (target - matrix[:, own] @ x[own])
        slope[active] = -np.inf
        enter = int(np.argmax(slope))
        if slope[enter] <= slack:
            break
        active[enter] = True
        while True:
            own = np.flatnonzero(active)
            best = fitted(matrix[:, own], target)
            if (best > slack).all():
                break
            low = best <= slack  # go only as far as no entry turns negative
            step = min(1.0, float((x[own][low] / np.maximum(x[own][low] - best[low], 1e-300)).min()))
            x[own] += step * (best - x[own])
            active[own[x[own] <= slack]] = False
            x[~active] = 0
            if not active.any():
                best = np.zeros(0)
                own = np.zeros(0, int)
                break
        x[:] = 0
        x[own] = best
    return x


def fitted(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Least squares without bounds, by the normal equations where these can be solved."""
    square = matrix.T @ matrix
    try:
        best = np.linalg.solve(square, matrix.T @ target)
    except np.linalg.LinAlgError:
        best = np.array([np.nan])
    residual = matrix.T @ (target - matrix @ best) if np.isfinite(best).all() else np.array([np.inf])
    if np.abs(residual).max(initial=0) > 1e-6 * max(1.0, float(np.abs(target).max(initial=0))):
        return np.linalg.lstsq(matrix, target, rcond=None)[0]
    return best


def repeats(sizes: np.ndarray, counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of sizes and how often to use each, never more than ``counts`` allow.

    Shallow combinations are enumerated; deeper ones join them one at a time, each the best for what the solution so far
    leaves over (the steepest column of least squares). The solution is rounded, and what it leaves is solved anew until
    hardly anything can be added."""
    least, left, out = window - window // 1024, counts.copy(), []
    shallow = combinations(sizes, least, window)
    for _ in range(ROUNDS):
        own = np.flatnonzero(left)
        if not len(own):
            break
        index = {int(n): i for i, n in enumerate(sizes[own])}
        held, target = left[own], left[own].astype(float)
        columns = []
        for shape in shallow:
            if all(n in index for n in shape):
                column_ = np.bincount([index[n] for n in shape], minlength=len(own))
                if (column_ <= held).all():
                    columns.append(column_)
        matrix = np.array(columns, float).reshape(-1, len(own)).T
        x = least_squares(matrix, target) if columns else np.zeros(0)
        for _ in range(2 * len(own)):
            matrix, x = matrix[:, x > 0], x[x > 0]  # the knapsack finds the others again
            residual = target - matrix @ x
            if np.abs(residual) @ sizes[own] <= CLOSE * (held @ sizes[own]):
                break
            deeper = best_combination(residual, sizes[own], held, least, window)
            if deeper is None or deeper @ residual <= 1e-6 * max(1.0, float(target.max())):
                break
            matrix = np.hstack([matrix, deeper[:, None].astype(float)])
            x = least_squares(matrix, target, x)
        before = left.sum()
        for j in np.argsort(-x, kind="stable").tolist():
            if x[j] <= 0:
                break
            need = matrix[:, j].astype(np.int64)
            some = np.flatnonzero(need)
            n = min(max(1, int(np.rint(x[j]))), int((left[own][some] // need[some]).min()))
            if n:
                left[own[some]] -= n * need[some]
                out.append((tuple(np.repeat(sizes[own[some]], need[some]).tolist()), n))
        if before - left.sum() <= CLOSE * counts.sum():
            break
    return out


def plan_rows(histogram: np.ndarray, window: int) -> tuple[list[tuple], int]:
    """``(bin, low, high, first, position, depth)``: pieces low..high-1 of the bin are at ``position`` of the sequences
    first, first+1, ...; and the number of planned sequences. A bin is named by the largest length in it."""
    counts = np.bincount(bin_sizes(histogram), histogram, len(histogram)).astype(np.int64)
    counts[0] = 0
    sizes = np.flatnonzero(counts)
    taken, sequences, rows = np.zeros(len(histogram), np.int64), 0, []
    for shape, n in repeats(sizes, counts[sizes], window):
        for position, b in enumerate(shape):
            rows.append((b, int(taken[b]), int(taken[b]) + n, sequences, position, len(shape)))
            taken[b] += n
        sequences += n
    return rows, sequences


def runs(rows: list[tuple]) -> list[tuple]:
    """Rows of a plan, ``(bin, low, high, first, position, depth, times)``: those of one bin in one combination together;
    piece k of a run is in sequence first + (k - low) % times."""
    out: list[tuple] = []
    for b, low, high, first, position, depth in rows:
        if out and out[-1][0] == b and out[-1][2] == low and out[-1][3] == first:
            out[-1] = (*out[-1][:2], high, *out[-1][3:])
        else:
            out.append((b, low, high, first, position, depth, high - low))
    return out


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """The sequence and offset of each length, placed in the given order where it leaves the least room."""
    rooms: dict[int, list[int]] = {}
    sizes: list[int] = []  # the rooms there are, sorted
    places, offsets, count = [], [], 0
    for length in lengths:
        at = bisect_left(sizes, length)
        if at == len(sizes):
            sequence, room, count = count, window, count + 1
        else:
            room = sizes[at]
            sequence = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], sizes[at]
        places.append(sequence)
        offsets.append(window - room)
        if room > length:
            if room - length not in rooms:
                insort(sizes, room - length)
            rooms.setdefault(room - length, []).append(sequence)
    return places, offsets


def pack_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``window``.

    Wants a written table, which it reads several times.
    """
    spark: SparkSession = pieces.sparkSession
    names = [c for c in pieces.columns]
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row[0]] = row[1]
    shards = int(histogram.sum()) // SHARD + 1
    rows, planned = plan_rows(histogram, window)
    plan = spark.createDataFrame(runs(rows), "_bin int, _low long, _high long, _first long, _position long, _depth int, _times long")
    bins = bin_sizes(histogram)
    bin_of = spark.createDataFrame([(n, int(bins[n])) for n in np.flatnonzero(histogram).tolist()], "_length long, _bin int")

    # the row number deals identical rows to all shards; the written table gives the same numbers every time
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    sharded = pieces.withColumn("_shard", shard if shards > 1 else F.lit(0))
    sharded = sharded.join(F.broadcast(bin_of), F.col("length") == F.col("_length")).drop("_length")
    before = Window.partitionBy("_bin").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    heads = sharded.groupBy("_bin", "_shard").count().select("_bin", "_shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_head"))
    order = Window.partitionBy("_bin", "_shard").orderBy("doc_id", "start", "ids_crc32")
    ranked = sharded.withColumn("_rank", F.row_number().over(order) - 1).join(heads, ["_bin", "_shard"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_head"))
    inside = (ranked["_bin"] == plan["_bin"]) & (ranked["_rank"] >= plan["_low"]) & (ranked["_rank"] < plan["_high"])
    nth = F.col("_rank") - F.col("_low")
    placed = written(
        ranked.join(F.broadcast(plan), inside, "left").select(
            *names, ranked["_bin"], "_rank", (F.col("_first") + nth % F.col("_times")).alias("sequence_id"),
            (F.col("_position") + F.floor(nth / F.col("_times"))).alias("_position"), "_depth",
        ),
        "packing",
    )

    alone = placed.filter("_depth = 1").select(*names, "sequence_id", F.lit(0).cast("long").alias("offset"))
    left_of = Window.partitionBy("sequence_id").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    joint = placed.filter("_depth > 1").select(*names, "sequence_id", F.coalesce(F.sum("length").over(left_of), F.lit(0)).alias("offset"))
    # the plan takes the first ranks of each bin; the others are numbered on from bin to bin, and dealt out in turn
    used: dict[int, int] = {}
    for row in rows:
        used[row[0]] = max(used.get(row[0], 0), row[2])
    held = np.bincount(bins, histogram, window + 1).astype(np.int64)
    left, shifts = 0, []
    for b in np.unique(bins[histogram > 0]).tolist():
        shifts.append((b, left - used.get(b, 0)))
        left += int(held[b]) - used.get(b, 0)
    groups = left // SHARD + 1
    shift = spark.createDataFrame(shifts, "_bin int, _shift long")
    rest = placed.filter("_depth is null").join(F.broadcast(shift), "_bin")
    rest = rest.select(*names, F.pmod(F.col("_shift") + F.col("_rank"), F.lit(groups)).cast("long").alias("_group"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def greedy(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        places, offsets = best_fit(table.column("length").to_pylist(), window)
        first = planned + (key[0].as_py() << 20)
        table = table.drop_columns(["_group"])
        table = table.append_column("sequence_id", pa.array([first + p for p in places], pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64()))

    return alone.unionByName(joint).unionByName(rest.groupBy("_group").applyInArrow(greedy, schema))


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset`` for each piece."""
    return pack_pieces(written(token_pieces(df, path, id_col, text_col, window, end_id, keep_ids), "pieces"), window)
