"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep hash states.

A leaf is the digest of one row. Leaves of a group ascend by identifier; every FANOUT consecutive nodes have a parent, the
digest of their digests, until one node is left, the group's subroot; subroots, in the order of their groups, have the
root in the same way. A node that is alone is not hashed again; a last run of fewer nodes, even one, is.

While a parent is hashed, the state before each child slot is copied and kept. To fold a changed leaf into the root, the
state before its slot is resumed with the new digest and the siblings to the right, level by level: siblings to the left
are never hashed again. The root that comes out equals the stored one exactly if the leaf is unchanged.

Nodes have a group and a position. Positions come from a sort by ranges (group, identifier, leaf) and from the counts of
its partitions, so no group needs one task. A block of FANOUT ** HEIGHT consecutive nodes is one subtree: a task builds it
and gives its top; the tops are the nodes of the next stage, HEIGHT levels up, and so on. On the way down each block gets
the path from its top to the root, as the digests left and right of it at each level; below it, a task builds the
subtrees of its blocks again, with states, and folds all of their leaves. The tables of the stages shrink by the size of
a block; the driver gets counts and the root.

Defined results: null values are written as `-`; rows with a null identifier come first in their group and are never
changed by ``lowered``; the null group is the first; rows with equal identifiers ascend by leaf, so equal rows have equal
leaves in any order; texts of any length are hashed whole; an empty table gives no rows; columns other than the named
ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratalake.functions.names import column
from stratalake.llm.common import written

FANOUT, HEIGHT = 8, 4
SPAN = FANOUT**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of an output batch, about.
ROWS = 4096
#: Rows of a partition below 2 ** 33, as in Spark's own increasing ids.
ROW_BITS = 33


def leaf_of(values: Iterable[Column]) -> Column:
    """SHA-256 over each value's length in bytes, a colon and the value; `-` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame, fields: Iterable[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``id, tree, leaf, other`` of each row, as a table: ``other`` is the leaf of the row with the ``changed`` columns,
    where ``where`` holds, else null. ``tree`` is the group as a text that sorts bytewise, the null group first."""
    group = column(group_col).cast("string")
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(F.lit(True) if where is None else where, leaf_of([changed.get(f, column(f)) for f in fields]))
    tree = F.coalesce(F.concat(F.lit("+"), group), F.lit(""))
    return written(docs.select(column(id_col).alias("id"), tree.alias("tree"), leaf_of([column(f) for f in fields]).alias("leaf"), other.alias("other")), "leaves")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``position`` and ``total``: the rank within ``tree`` by ``order`` and the number of rows of the tree."""
    origin = rows.withColumn("origin", F.monotonically_increasing_id())  # tells equal rows apart, so that ranges can part them
    ranged = origin.repartitionByRange("tree", *order, "origin").sortWithinPartitions("tree", *order, "origin").drop("origin")
    at = F.monotonically_increasing_id()
    placed = written(ranged.select("*", F.shiftright(at, ROW_BITS).alias("range"), at.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row")), "numbered")
    parts = placed.groupBy("tree", "range").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("tree")  # one row per range of the sort
    before = F.coalesce(F.sum("n").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "range", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
    joined = placed.join(parts, ["tree", "range"])
    return joined.withColumn("position", F.col("row") + F.col("shift")).drop("range", "row", "shift")


def depth(total: int) -> int:
    """Levels above the nodes of a tree."""
    levels = 0
    while total > 1:
        total = -(-total // FANOUT)
        levels += 1
    return levels


class Subtree:
    """A block of nodes, ``levels`` levels high, with the hash state before each child slot."""

    def __init__(self, digests: list[bytes], levels: int):
        self.nodes, self.states = [digests], []
        for _ in range(levels):
            states, above = [], []
            for first in range(0, len(self.nodes[-1]), FANOUT):
                state = hashlib.sha256()
                for digest in self.nodes[-1][first : first + FANOUT]:
                    states.append(state.copy())
                    state.update(digest)
                above.append(state.hexdigest().encode())
            self.nodes.append(above)
            self.states.append(states)

    @property
    def top(self) -> bytes:
        return self.nodes[-1][0]

    def around(self, slot: int) -> Iterator[tuple[bytes, bytes]]:
        """Digests left and right of a node's ancestors, level by level."""
        for nodes in self.nodes[:-1]:
            first = slot - slot % FANOUT
            yield b"".join(nodes[first:slot]), b"".join(nodes[slot + 1 : first + FANOUT])
            slot //= FANOUT

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The top after a node is replaced."""
        for nodes, states in zip(self.nodes, self.states):
            state = states[slot].copy()
            state.update(digest)
            state.update(b"".join(nodes[slot + 1 : slot - slot % FANOUT + FANOUT]))
            digest, slot = state.hexdigest().encode(), slot // FANOUT
        return digest


class Path:
    """From the top of a block to the root: the digests left and right at each level, and the state after the left ones."""

    def __init__(self, sides: list[dict]):
        self.sides = [(s["before"].encode(), s["after"].encode()) for s in sides]
        self.states = [hashlib.sha256(before) for before, _ in self.sides]
        self.siblings = b"".join(before + after for before, after in self.sides)

    def fold(self, digest: bytes) -> bytes:
        for state, (_, after) in zip(self.states, self.sides):
            state = state.copy()
            state.update(digest)
            state.update(after)
            digest = state.hexdigest().encode()
        return digest


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of consecutive rows of one ``tree`` and ``block``, the first two columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for _, own in groupby(rows, key=lambda row: row[:2]):
        yield list(own)


def packed(lists: Iterable[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for rows in lists:
        held += rows
        if len(held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def dealt(rows: DataFrame) -> DataFrame:
    """Blocks as consecutive rows in order, any block in any partition."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def block() -> Column:
    return F.floor(F.col("position") / SPAN).cast("long").alias("block")


def raised(nodes: DataFrame) -> DataFrame:
    """The nodes ``tree, position, total, digest`` HEIGHT levels up, or as many as the tree has, as a table."""
    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[list[tuple]]:
            for rows in by_block(batches):
                tree, number, _, total, _ = rows[0]
                top = Subtree([r[4].encode() for r in rows], min(HEIGHT, depth(total))).top
                yield [(tree, number, -(-total // SPAN), top.decode())]

        yield from packed(tops(), schema)

    rows = dealt(nodes.select("tree", block(), "position", "total", "digest"))
    return written(rows.mapInArrow(build, "tree string, position long, total long, digest string"), "nodes")


SIDES = "array<struct<before: string, after: string>>"


def lowered_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``tree, position, path`` of the nodes below the blocks with the given paths, as a table."""
    side = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("path", side)])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def below() -> Iterator[list[tuple]]:
            for (*_, path), *rows in by_block(batches):
                subtree = Subtree([r[4].encode() for r in rows], min(HEIGHT, depth(rows[0][3])))
                yield [(r[0], r[2], [{"before": b.decode(), "after": a.decode()} for b, a in subtree.around(i)] + path) for i, r in enumerate(rows)]

        yield from packed(below(), schema)

    rows = nodes.select("tree", block(), "position", "total", "digest", F.lit(None).cast(SIDES).alias("path"))
    return written(dealt(headed(rows, paths)).mapInArrow(extend, f"tree string, position long, path {SIDES}"), "paths")


def headed(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """``rows`` and, before those of each block, a row at position -1 with what is known of the block."""
    return rows.unionByName(paths.withColumnRenamed("position", "block").withColumn("position", F.lit(-1).cast("long")), allowMissingColumns=True)


@dataclass
class Manifest:
    """The numbered leaves ``id, tree, leaf, other, position, total``; for each block of leaves ``tree, position, path`` and
    ``subroot``; and the root."""

    leaves: DataFrame
    blocks: DataFrame
    root: str


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The stages from the nodes to the last one of each tree."""
    stages = [nodes]
    while (stages[-1].agg(F.max("total")).first()[0] or 1) > 1:
        stages.append(raised(stages[-1]))
    return stages


def descended(stages: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the first stage, from those of the last."""
    for nodes in reversed(stages[:-1]):
        paths = lowered_paths(nodes, paths)
    return paths


def manifest(rows: DataFrame) -> Manifest | None:
    """The manifest of a table of leaves; None if it is empty."""
    own = written(numbered(rows, "id", "leaf"), "positions")
    stages = climbed(own.select("tree", "position", "total", F.col("leaf").alias("digest")))
    if len(stages) == 1:  # no tree has two leaves: the leaves are their own blocks
        stages.append(raised(stages[0]))
    subroots = stages[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = written(numbered(subroots, "name"), "subroots")
    above = climbed(upper)
    root = above[-1].select("digest").first()
    if root is None:
        return None
    nothing = above[-1].select("tree", "position", F.array().cast(SIDES).alias("path"))
    paths = descended(above, nothing).join(upper.select("position", "name", "digest"), "position")
    paths = paths.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "path")
    blocks = descended(stages[1:], paths).join(upper.select(F.col("name").alias("tree"), F.col("digest").alias("subroot")), "tree")
    return Manifest(own, blocks, root[0])


def verified(tree: Manifest, with_siblings: bool = False) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each leaf: the digest of its siblings from its
    own level to the root, and the root that its other leaf (its own, where there is none) folds into; ``siblings``, as one
    text, if asked for."""
    names = ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"] + ["siblings"] * with_siblings

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs() -> Iterator[list[tuple]]:
            for head, *rows in by_block(batches):
                path, subroot, out = Path(head[7]), head[8], []
                subtree = Subtree([r[4].encode() for r in rows], min(HEIGHT, depth(rows[0][3])))
                for slot, (*_, leaf, other, id_, _, _) in enumerate(rows):
                    siblings = b"".join(side for sides in subtree.around(slot) for side in sides) + path.siblings
                    folded = path.fold(subtree.fold(slot, (leaf if other is None else other).encode()))
                    out.append((id_, leaf, subroot, hashlib.sha256(siblings).hexdigest(), folded.decode(), siblings.decode()))
                yield out

        yield from packed(([r[: len(names)] for r in rows] for rows in proofs()), pa.schema(list(zip(names, [id_type, *[pa.string()] * 5]))))

    id_type = to_arrow_type(tree.leaves.schema["id"].dataType)
    rows = tree.leaves.select("tree", block(), "position", "total", "leaf", "other", "id", F.lit(None).cast(SIDES).alias("path"), F.lit(None).cast("string").alias("subroot"))
    kind = tree.leaves.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string" + ", siblings string" * with_siblings
    found = dealt(headed(rows, tree.blocks)).mapInArrow(prove, schema)
    root = F.lit(tree.root)
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"), *names[5:])


def tampered_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's place in the manifest and its check after a change: where 3 divides the CRC-32 of the id's digits, the
    letters A-Z of the text are lower-cased."""
    lower = F.translate(column(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    where = F.crc32(column(id_col).cast("string").cast("binary")) % 3 == 0
    tree = manifest(leaves(docs, id_col=id_col, changed={text_col: lower}, where=where))
    if tree is None:
        kind = docs.select(column(id_col)).schema[0].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return verified(tree)
