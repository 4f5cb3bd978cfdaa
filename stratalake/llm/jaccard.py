"""Jaccard self-join of word n-gram sets by parity sketches.

Two sets of sizes a and b with Jaccard similarity t or more differ in at most d = (1 - t) / (1 + t) * (a + b) elements.
A set is dealt by hash into p parts, and a part's symbol is the XOR of the hashes of its elements: every element by
which two sets differ changes one symbol at most, so at least p - d symbols of a linked pair are equal (pigeonhole).
Sizes fall into bands, and linked sizes into the same band or neighbours, so a set takes part under the p of its own and
of the next band. p exceeds d by more than the number of empty parts to be expected: an equal symbol that is not of an
empty part is sure as long as one of both sets has fewer than p - d empty parts. A set with more also gives the symbols
of its empty parts. Linked pairs therefore meet in an equal symbol.

Steps: (1) A pass cuts the sets of a task into blocks and sends the block's symbols to buckets, packed: a symbol that one
set of the block has goes with the set's number, one that several have goes once and without. A bucket answers which of
them other blocks sent as well, and the answers meet again by block: a set whose shared symbols are as many as a linked
pair must share stays, with its shared symbols, and no other does. Nothing of this is of a fixed size, so sets drop out at
every size of the corpus alike. (2) A second pass gives the whole sets that stayed. It knows them by a Bloom filter of
fixed size: one that fills lets whole sets pass that nothing asks for, one row a set at most. (3) Symbols are grouped. In groups
up to GROUP all pairs are candidates, in larger ones all pairs with the first member. (4) Candidates are dropped where
the Hamming distance of their bit sketches (parities of elements per bit, again a lower bound of the difference) is too
large, and the others are verified by their whole sets. (5) Links give components. Larger groups that still hold several
components are put together by their first member and compared block by block, sets of different components only, by the
same bounds; what is found is verified and joined to the components. No link between different sets is lost, and equal sets are one node from the start.

Elements and sets are hashed to 64 bits. Blocks follow the order of rows in a task, so the input should be a table or a
plan that gives each task the same rows in the same order when it runs again.

Defined results: null texts, empty texts and texts without words have no shingles and are linked with nothing; a text
with fewer words than n is one shingle; rows that share an id are one document if their sets are equal and otherwise
sets that are linked through the id; rows with a null id get a null component and link nothing; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import U64, PrefixHash, mixed, row_blocks, strings, written
from stratalake.llm.components import connected, joined

WORDS, PERCENT = 5, 75
BLOCK = 2_000_000
#: Symbols of a bucket, symbols and sets of a block; the number that stands for several sets of a block.
BUCKET, SEND, SETS, SEVERAL = 1_000_000, 1_000_000, 32_000, 65_535
#: Bits that tell the symbols of a bucket apart: one in a thousand has those of another, which costs a look and no link.
LOW = 30
#: Bits of the filter of sets that stay, and the slices it is made in.
FILTER_BITS, SLICES = 1 << 27, 64
#: Largest group whose pairs are all candidates; members of a block in the comparison of larger groups.
GROUP, MEMBERS = 16, 1024
#: Closest candidates of each member in the first comparison of larger groups; the second one takes all.
NEAREST = 3
#: Nodes that a task remembers so as not to repeat them.
SEEN = 200_000
SMALL_BITS, LARGE_BITS = 64, 1 << 14

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of the word n-grams of each text of a block."""
    rows = len(offsets) - 1
    if not len(data):
        return [np.zeros(0, U64)] * rows
    data = LOWER[data]
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | np.concatenate([[True], ~solid[:-1]])))
    ends = np.flatnonzero(solid & (edge[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    word = PrefixHash(data).of(starts, ends)
    first = np.searchsorted(starts, offsets)  # of each text; the last entry is the number of words
    odd = mixed(np.arange(1, n + 1, dtype=U64)) | U64(1)
    if len(word) >= n:
        grams = np.zeros(len(word) - n + 1, U64)
        for i in range(n):
            grams += word[i : len(word) - n + 1 + i] * odd[i]
        grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            out.append(mixed((word[a:b] * odd[: b - a]).sum(keepdims=True) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def node(own: np.ndarray) -> int:
    """The identity of a set, as a signed 64-bit number."""
    return int(mixed(mixed(own ^ U64(0xA5A5A5A5A5A5A5A5)).sum(keepdims=True) + U64(len(own))).view(np.int64)[0])


def most_apart(a, b, percent: int = PERCENT):
    """The most elements by which linked sets of these sizes differ."""
    return (a + b) * (100 - percent) // (100 + percent)


class Bands:
    """Size bands, and for each band the number of parts used for pairs whose larger set is in it."""

    def __init__(self, percent: int = PERCENT, largest: int = 1 << 40):
        self.percent = percent
        self.edges = [1]
        while self.edges[-1] <= largest:
            low = self.edges[-1]
            self.edges.append(max(low + 1, 100 * (low - 1) // percent + 1))
        self.parts = [self.parts_for(self.edges[max(i - 1, 0)], self.edges[i + 1] - 1) for i in range(len(self.edges) - 1)]

    def parts_for(self, least: int, most: int) -> int:
        """Parts for sets of ``least`` to ``most`` elements: empty parts of the least should stay well below the number
        of sure equal symbols."""
        apart = most_apart(most, most, self.percent)
        if not apart:
            return 0  # only equal sets are linked
        p = apart + 1
        while p < 4 * least * least + apart:
            empty = p * np.exp(-least / p)
            if p - apart - 1 >= empty + 4 * np.sqrt(empty) + 1:
                break
            p += max(1, p // 50)
        return p

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def symbols(self, own: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """For the band of the set and the next one: the symbols, and how many of them a linked set has as well."""
        size, mine = len(own), self.band(len(own))
        high, hashes = own >> U64(32), None
        for scheme in (mine, mine + 1):
            p = self.parts[scheme]
            if not p:
                continue
            hashes = mixed(own + U64(0x632BE59BD9B4E019)) if hashes is None else hashes
            part = high * U64(p) >> U64(32)  # ascends with the sorted hashes
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            value, place = np.bitwise_xor.reduceat(hashes, first), part[first]
            partner = min(self.edges[scheme + 1] - 1, 100 * size // self.percent)
            sure = p - most_apart(size, partner, self.percent) - (p - len(first))
            if sure <= 0:  # too many empty parts: their symbols count as well
                empty = np.setdiff1d(np.arange(p, dtype=U64), place)
                value, place, sure = np.concatenate([value, np.zeros(len(empty), U64)]), np.concatenate([place, empty]), 1
            yield mixed(value + mixed(place + U64(scheme << 40))), sure


def bit_sketch(own: np.ndarray) -> bytes:
    """Parities of the number of elements for each of 64 to LARGE_BITS bits, about twice as many as elements."""
    bits = min(LARGE_BITS, max(SMALL_BITS, 1 << (2 * len(own) - 1).bit_length()))
    return np.packbits((np.bincount((own & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) with fewer bits: an element's bit number keeps its low bits."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def planes(values: np.ndarray) -> bytes:
    """Values byte plane after byte plane, compressed: high bytes take few values."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def from_planes(data: bytes, kind: type) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending 32-bit values as differences."""
    return planes(np.diff(values, prepend=np.uint32(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint32), dtype=np.uint32)


def short(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (the highest bits) and LOW more bits of a symbol, in one number. Buckets are a power of two, two at least."""
    return keys >> U64(64 - (buckets - 1).bit_length()) << U64(32) | keys & U64((1 << LOW) - 1)


def new_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, int, bool]]:
    """Batch, row, last row of the block, set, node, and whether the task sees the node for the first time with an id."""
    seen: set[int] = set()
    for batch in batches:
        data, offsets = strings(batch.column(1))
        for first, end in row_blocks(offsets, BLOCK):
            block = shingle_sets(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], n)
            for row, own in enumerate(block, first):
                key = node(own) if len(own) else 0
                fresh = len(own) > 0 and key not in seen and batch.column(0)[row].is_valid
                if fresh:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                yield batch, row, end, own, key, fresh


class Block:
    """Sets of a task whose symbols are sent together."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.sizes: list[int] = []
        self.sure: list[int] = []  # two for each set, one for each of its bands
        self.numbers: list[np.ndarray] = []
        self.symbols: list[np.ndarray] = []
        self.count = 0

    def add(self, key: int, own: np.ndarray, bands: Bands, buckets: int) -> None:
        first = 2 * len(self.nodes)
        self.nodes.append(key)
        self.sizes.append(len(own))
        self.sure += [0, 0]
        for number, (symbols, sure) in enumerate(bands.symbols(own), first):
            self.sure[number] = sure
            self.numbers.append(np.full(len(symbols), number, np.uint16))
            self.symbols.append(short(symbols, buckets))
            self.count += len(symbols)

    def full(self) -> bool:
        return self.count >= SEND or len(self.nodes) >= SETS

    def messages(self, buckets: int) -> list[tuple[int, int, int, bytes, bytes]]:
        """Rows ``block, kind, bucket, numbers, symbols`` of the kinds ASK, KNOWN and STATE."""
        if not self.symbols:
            return []
        symbols, numbers = np.concatenate(self.symbols), np.concatenate(self.numbers)
        order = np.argsort(symbols, kind="stable")
        symbols, numbers = symbols[order], numbers[order]
        nodes = np.array(self.nodes, np.int64)
        block = int(mixed(mixed(nodes.view(U64) + mixed(np.arange(len(nodes), dtype=U64))).sum(keepdims=True)).view(np.int64)[0])
        home = block & (buckets - 1)
        state = np.array([self.sizes, self.sure[0::2], self.sure[1::2]], np.int64)
        out = [(block, STATE, home, nodes.tobytes(), state.tobytes())]
        new = np.concatenate([[True], symbols[1:] != symbols[:-1]])
        several = np.diff(np.append(np.flatnonzero(new), len(new))) > 1
        mine = np.repeat(several, np.diff(np.append(np.flatnonzero(new), len(new))))
        if mine.any():
            out.append((block, KNOWN, home, numbers[mine].tobytes(), symbols[mine].tobytes()))
        symbols, numbers = symbols[new], np.where(several, np.uint16(SEVERAL), numbers[new])
        bounds = np.searchsorted(symbols, np.arange(buckets + 1, dtype=U64) << U64(32)) if buckets <= len(symbols) else None
        if bounds is None:  # few symbols for many buckets
            bucket, starts = np.unique(symbols >> U64(32), return_index=True)
            spans = zip(bucket.tolist(), starts.tolist(), np.append(starts[1:], len(symbols)).tolist())
        else:
            spans = ((b, bounds[b], bounds[b + 1]) for b in np.flatnonzero(np.diff(bounds)).tolist())
        low = (symbols & U64(0xFFFFFFFF)).astype(np.uint32)
        return out + [(block, ASK, b, planes(numbers[i:j]), packed_sorted(low[i:j])) for b, i, j in spans]


#: Kinds of messages: symbols to be looked up (and looked-up ones); symbols that several sets of the block have; its sets.
ASK, KNOWN, STATE = 0, 1, 2
MESSAGE = "block long, kind int, bucket long, numbers binary, symbols binary"


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.nulls(0, k) for k in kinds]
    return pa.RecordBatch.from_arrays(columns, ["block", "kind", "bucket", "numbers", "symbols"])


def answers(asked: list[tuple]) -> list[tuple]:
    """Of the questions of one bucket, those symbols that another block sent too, or that several sets of one block have."""
    low = [unpacked_sorted(row[4]) for row in asked]
    numbers = [from_planes(row[3], np.uint16) for row in asked]
    every = np.concatenate(low)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    shared = np.zeros(len(every), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    out, at = [], 0
    for row, values, own in zip(asked, low, numbers):
        keep = shared[at : at + len(values)] & (own != SEVERAL)  # those of several sets are known to be shared
        at += len(values)
        if keep.any():
            out.append((row[0], ASK, row[2], planes(own[keep]), packed_sorted(values[keep])))
    return out


def staying(rows: list[tuple], buckets: int) -> list[np.ndarray]:
    """``node, size, symbol`` of the shared symbols of a block, of sets that have enough of them for a linked pair."""
    state = [row for row in rows if row[1] == STATE][0]
    nodes, (sizes, *sure) = np.frombuffer(state[3], np.int64), np.frombuffer(state[4], np.int64).reshape(3, -1)
    numbers, symbols = [], []
    for block, kind, bucket, own, values in set(rows):
        if kind == KNOWN:
            numbers.append(np.frombuffer(own, np.uint16))
            symbols.append(np.frombuffer(values, U64))
        elif kind == ASK:
            numbers.append(from_planes(own, np.uint16))
            symbols.append(U64(bucket << 32) | unpacked_sorted(values).astype(U64))
    if not numbers:
        return [np.zeros(0, np.int64)] * 3
    number, symbol = np.concatenate(numbers), np.concatenate(symbols)
    enough = np.bincount(number, minlength=2 * len(nodes)) >= np.stack(sure, 1).ravel()
    number, symbol = number[enough[number]], symbol[enough[number]]
    return [nodes[number >> 1], sizes[number >> 1], symbol.view(np.int64)]


def shared_symbols(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """A table ``node, size, symbol``: the symbols that more than one set has, of the sets with enough of them."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << min(20, max(5, int(size // 6 // BUCKET).bit_length()))
    bands = Bands(percent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for _, _, _, own, key, fresh in new_sets(batches, n):
            if fresh:
                block.add(key, own, bands, buckets)
            if block.full():
                yield messages(block.messages(buckets))
                block = Block()
        yield messages(block.messages(buckets))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        return (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows_of(batches), key=lambda r: r[2]):
            asked = []
            for row in group:
                if row[1] == ASK:
                    asked.append(row)
                else:
                    yield messages([row])  # only passes through
            if asked:
                yield messages(answers(asked))

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows_of(batches), key=lambda r: r[0]):
            columns = staying(list(group), buckets)
            for at in range(0, len(columns[0]), SEND // 4):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + SEND // 4]) for c in columns], ["node", "size", "symbol"])

    asked = texts.select("id", "text").mapInArrow(send, MESSAGE).repartition(min(buckets, 1 << 15), "bucket").sortWithinPartitions("bucket")
    answered = asked.mapInArrow(answer, MESSAGE).repartition("block").sortWithinPartitions("block")
    return written(answered.mapInArrow(stay, "node long, size long, symbol long"), "symbols")


def places(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slice of a node, and its two bits there."""
    h = mixed(nodes.view(U64) ^ U64(0x5851F42D4C957F2D))
    bits = U64(FILTER_BITS // SLICES - 1)
    return (nodes.view(U64) % U64(SLICES)).astype(np.int64), np.stack([h & bits, h >> U64(32) & bits]).astype(np.int64)


def node_filter(symbols: DataFrame) -> np.ndarray:
    """Bits of the nodes of the table, slice by slice: FILTER_BITS in all, whatever the input."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            slices, at = places(batch.column(0).to_numpy())
            for s in np.unique(slices).tolist():
                bits.setdefault(s, np.zeros(FILTER_BITS // SLICES, bool))[at[:, slices == s].ravel()] = True
        for s, own in bits.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

    nodes = symbols.select("node").distinct().withColumn("slice", F.pmod(F.col("node"), F.lit(SLICES)))
    whole = np.zeros((SLICES, FILTER_BITS // SLICES // 8), np.uint8)
    for row in nodes.repartition(SLICES, "slice").select("node").mapInArrow(merge, "slice long, bits binary").collect():
        whole[row[0]] |= np.frombuffer(row[1], np.uint8)
    return whole


def stays(key: int, bits: np.ndarray) -> bool:
    slices, at = places(np.array([key], np.int64))
    return bool((bits[slices, at >> 3] >> (at & 7).astype(np.uint8) & 1).all())


def emitted(texts: DataFrame, symbols: DataFrame, n: int) -> DataFrame:
    """A table with rows of two kinds: 0, ``id, node, size`` of each text; 2, ``node, size, sketch, hashes`` of the sets that
    the table of symbols names."""
    spark: SparkSession = texts.sparkSession
    shared = spark.sparkContext.broadcast(node_filter(symbols))
    id_kind = texts.schema["id"].dataType
    names = ["kind", "id", "node", "size", "sketch", "hashes"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, nodes, sizes, sets = [], [], [], []
        for batch, row, end, own, key, fresh in new_sets(batches, n):
            rows.append(row)
            nodes.append(key if len(own) else None)
            sizes.append(len(own))
            if fresh and stays(key, shared.value):
                sets.append((key, own))
            if row < end - 1:
                continue
            types = [pa.int32(), batch.column(0).type, pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            columns = [[0] * len(rows), ids, nodes, sizes, [None] * len(rows), [None] * len(rows)]
            yield pa.RecordBatch.from_arrays([c if c is ids else pa.array(c, t) for c, t in zip(columns, types)], names)
            if sets:
                count = len(sets)
                columns = [[2] * count, [None] * count, [k for k, _ in sets], [len(s) for _, s in sets], [bit_sketch(s) for _, s in sets], [s.tobytes() for _, s in sets]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            rows, nodes, sizes, sets = [], [], [], []

    schema = f"kind int, id {id_kind.simpleString()}, node long, size long, sketch binary, hashes binary"
    rows = written(texts.select("id", "text").mapInArrow(emit, schema), "shingles")
    shared.destroy()  # the table is written, so nothing needs the filter any more
    return rows


def close_sizes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


class Grouping:
    """Pairs and members of the groups of a sorted stream of ``symbol, node, size``."""

    def __init__(self, percent: int):
        self.percent = percent
        self.open = [np.zeros(0, np.int64)] * 3  # rows of the last group, if it may go on
        self.head: tuple | None = None  # first row of a large group that goes on
        self.clear()

    def clear(self) -> None:
        self.waiting = 0
        self.pairs: list[tuple] = []  # nodes and sizes of both sides
        self.members: list[tuple] = []  # first node of the group, node, sizes of both

    def star(self, head: tuple, rows: list[np.ndarray]) -> None:
        n = len(rows[0])
        self.members.append((np.full(n, head[1]), rows[1], np.full(n, head[2]), rows[2]))
        self.waiting += n

    def add(self, batch: list[np.ndarray], goes_on: bool) -> None:
        rows = [np.concatenate(x) for x in zip(self.open, batch)]
        self.open = [x[:0] for x in rows]
        if self.head is not None:
            end = int(np.searchsorted(rows[0], self.head[0], "right"))
            self.star(self.head, [x[:end] for x in rows])
            rows = [x[end:] for x in rows]
            if len(rows[0]) or not goes_on:
                self.head = None
        new = np.ones(len(rows[0]), bool)  # the same set may come from several tasks
        new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        rows = [x[new] for x in rows]
        starts = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]])) if len(rows[0]) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(rows[0])))
        if goes_on and len(starts) and lengths[-1] <= GROUP:
            self.open = [x[starts[-1] :] for x in rows]
            starts, lengths = starts[:-1], lengths[:-1]
        elif goes_on and len(starts):
            self.head = tuple(x[starts[-1]] for x in rows)
        for n in range(2, GROUP + 1):
            at = starts[lengths == n]
            for i in range(n if len(at) else 0):
                for j in range(i + 1, n):
                    self.pairs.append((rows[1][at + i], rows[1][at + j], rows[2][at + i], rows[2][at + j]))
            self.waiting += len(at) * n * (n - 1) // 2
        for at, n in zip(starts[lengths > GROUP].tolist(), lengths[lengths > GROUP].tolist()):
            self.star(tuple(x[at] for x in rows), [x[at : at + n] for x in rows])

    def taken(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Distinct pairs of close sizes, the smaller node first, and distinct members of large groups, since the last call."""
        a, b, size_a, size_b = (np.concatenate(x) for x in zip(*self.pairs)) if self.pairs else [np.zeros(0, np.int64)] * 4
        members = [np.concatenate(x) for x in zip(*self.members)] if self.members else [np.zeros(0, np.int64)] * 4
        self.clear()
        near = close_sizes(size_a, size_b, self.percent) & (a != b)
        pairs = [np.where(a < b, a, b), np.where(a < b, b, a), np.where(a < b, size_a, size_b), np.where(a < b, size_b, size_a)]
        pairs = [x[near] for x in pairs]
        order = np.lexsort((pairs[1], pairs[0]))
        pairs = [x[order] for x in pairs]
        once = np.ones(len(order), bool)
        once[1:] = (pairs[0][1:] != pairs[0][:-1]) | (pairs[1][1:] != pairs[1][:-1])
        order = np.lexsort((members[1], members[0]))
        members = [x[order] for x in members]
        other = np.ones(len(order), bool)
        other[1:] = (members[0][1:] != members[0][:-1]) | (members[1][1:] != members[1][:-1])
        return [x[once] for x in pairs], [x[other] for x in members]


def grouped(symbols: DataFrame, percent: int) -> DataFrame:
    """Rows of two kinds: candidate pairs ``a, b, size_a, size_b`` (``large`` false), and pairs of the first node ``a`` of a
    group larger than GROUP and each of its members ``b``, itself too (``large`` true)."""
    names = ["large", "a", "b", "size_a", "size_b"]

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Grouping(percent)

        def out() -> Iterator[pa.RecordBatch]:
            for large, columns in zip((False, True), groups.taken()):
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), large)), *map(pa.array, columns)], names)

        for batch in batches:
            groups.add([batch.column(i).to_numpy() for i in range(3)], True)
            if groups.waiting > SEND:
                yield from out()
        groups.add([np.zeros(0, np.int64)] * 3, False)
        yield from out()

    rows = symbols.select("symbol", "node", "size").repartition("symbol").sortWithinPartitions("symbol", "node")
    return rows.mapInArrow(group, "large boolean, a long, b long, size_a long, size_b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough: by sketches first, then by whole sets."""

    @F.arrow_udf("boolean")
    def near(one: pa.Array, two: pa.Array, size_a: pa.Array, size_b: pa.Array) -> pa.Array:
        limit = most_apart(size_a.to_numpy(), size_b.to_numpy(), percent)
        out = np.empty(len(limit), bool)
        for i, (x, y) in enumerate(zip(one, two)):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            words = min(len(x), len(y))
            out[i] = np.bitwise_count(folded(x[None], words) ^ folded(y[None], words)).sum() <= limit[i]
        return pa.array(out)

    @F.arrow_udf("boolean")
    def similar(one: pa.Array, two: pa.Array) -> pa.Array:
        out = np.empty(len(one), bool)
        for i, (x, y) in enumerate(zip(one, two)):
            x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            out[i] = 100 * common >= percent * (len(x) + len(y) - common)
        return pa.array(out)

    def beside(rows: DataFrame, value: str) -> DataFrame:
        for side in "ab":
            rows = rows.join(sets.select(F.col("node").alias(side), F.col(value).alias(f"{value}_{side}")), side)
        return rows

    close = beside(pairs, "sketch").filter(near("sketch_a", "sketch_b", "size_a", "size_b")).select("a", "b")
    return beside(written(close, "close"), "hashes").filter(similar("hashes_a", "hashes_b")).select("a", "b")


def across(members: DataFrame, heads: DataFrame, sets: DataFrame, percent: int, nearest: int | None = None) -> DataFrame:
    """Candidate pairs of different roots among the members ``head, a, size_a, root`` of large groups with the same first
    node, block against block, for the ``head, n`` with several roots among n members; with ``nearest`` only so many for
    each member, those with the closest sketches."""
    rows = members.join(heads, "head").join(sets.select(F.col("node").alias("a"), "sketch"), "a")
    rows = rows.withColumn("blocks", F.floor(F.col("n") / MEMBERS).cast("long") + 1).withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "a", "size_a", "root", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own, a, size, root = (table.column(c).to_numpy() for c in ("own", "a", "size_a", "root"))
        raw = [np.frombuffer(s, np.uint64) for s in table.column("sketch").to_pylist()]
        words = min(len(s) for s in raw)
        sketch = np.concatenate([folded(s[None], words) for s in raw])
        names, counts = np.unique(root, return_counts=True)
        rare = np.flatnonzero(root != names[np.argmax(counts)])  # every pair of two roots has a member outside the commonest
        left, right = [], []
        for x in rare.tolist():
            other = np.flatnonzero((root != root[x]) & close_sizes(size, size[x], percent) & ((own != own[x]) if i != j else True))
            apart = np.bitwise_count(sketch[other] ^ sketch[x]).sum(1)
            fits = apart <= most_apart(size[other], size[x], percent)
            other, apart = other[fits], apart[fits]
            if nearest is not None:
                other = other[np.argsort(apart, kind="stable")[:nearest]]
            left.append(np.full(len(other), x))
            right.append(other)
        left, right = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
        swap = a[left] > a[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        return pa.table({"a": a[left], "b": a[right], "size_a": size[left], "size_b": size[right]})

    return rows.groupBy("head", "i", "j").applyInArrow(compare, "a long, b long, size_a long, size_b long").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row."""
    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    symbols = shared_symbols(texts, n, percent)
    rows = emitted(texts, symbols, n)
    members = rows.filter("kind = 0").select("id", "node", "size")
    sets = rows.filter("kind = 2").groupBy("node").agg(F.first("sketch").alias("sketch"), F.first("hashes").alias("hashes"))
    sets = written(sets, "sets")
    found = written(grouped(symbols, percent), "groups")
    close = f"a <> b and 100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)"
    pairs = found.filter(close).select("a", "b", "size_a", "size_b").distinct()
    # sets with the same id belong together
    same = members.filter("id is not null and node is not null").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("a", "b")
    links = written(verified(pairs, sets, percent).unionByName(same), "links")
    roots = connected(links)
    large = found.filter("large").select(F.col("a").alias("head"), F.col("b").alias("a"), F.col("size_b").alias("size_a"))
    large = written(large.distinct(), "large")
    # first the nearest of each, which joins most of what belongs together, then all that is left
    for nearest in (NEAREST, None):
        own = large.join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
        open_ = own.groupBy("head").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).filter("low < high")
        open_ = written(open_.select("head", "n"), "heads")
        if open_.isEmpty():
            break
        roots = joined(roots, written(verified(across(own, open_, sets, percent, nearest), sets, percent), "links"))
    classes = members.filter("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("least"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "root").select("node", "component_id")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return members.join(classes, "node", "left").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), own.alias("component_id"))
