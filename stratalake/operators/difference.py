"""Where two tables differ: a tree of additive digests per partition and bucket of keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.digests import LANES, lane_sums, row_digest
from stratalake.functions.matching import match_parts
from stratalake.functions.names import column, require_columns

BUCKETS = 4096
SUMS = ["n_rows", *(f"lane_{i}" for i in range(LANES))]
# Spelled so that no value of another column joins to the same text.
NULL = "N"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[column(k).cast("string") for k in keys]), F.lit(buckets))


def digest_tree(df: DataFrame, partition: str, keys: Sequence[str], cols: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``part, bucket, n_rows, lane_*``: the sums of the row digests over ``cols`` of each partition and bucket of keys.

    One map-side aggregate; a table keeps it beside its rows. The sums of a
    partition are those of its buckets, so one small table has both levels.
    """
    (partition,), keys, cols = require_columns(df, [partition]), require_columns(df, keys), require_columns(df, cols)
    digest = row_digest([column(c) for c in cols], NULL)
    rows = df.select(column(partition).cast("string").alias("part"), _bucket(keys, buckets).alias("bucket"), digest.alias("digest"))
    lanes = [s.alias(f"lane_{i}") for i, s in enumerate(lane_sums(F.col("digest")))]
    return rows.groupBy("part", "bucket").agg(F.count("*").alias("n_rows"), *lanes)


def _unequal(one: DataFrame, other: DataFrame, level: Sequence[str]) -> DataFrame:
    """Nodes of a level whose sums differ, or that one side lacks."""
    sides = one.withColumn("side", F.lit(1)).unionByName(other.withColumn("side", F.lit(-1)))
    signed = [F.sum(F.col(c) * F.col("side")).alias(c) for c in SUMS]
    return sides.groupBy(*level).agg(*signed).filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])).select(*level)


def differing_parts(one: DataFrame, other: DataFrame) -> list[str | None]:
    """Partitions whose sums differ between two digest trees: the only names the driver gets."""
    return [row[0] for row in _unequal(one, other, ["part"]).orderBy("part").collect()]


def differing_keys(
    one: DataFrame,
    other: DataFrame,
    read_one: Callable[[list[str | None]], DataFrame],
    read_other: Callable[[list[str | None]], DataFrame],
    partition: str,
    keys: Sequence[str],
    cols: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """``keys, change`` of the keys whose rows differ between two tables: ``added``, ``removed`` or ``changed``.

    ``one`` and ``other`` are their digest trees, and ``read_one`` and
    ``read_other`` give the rows of the partitions they are asked for. Only
    partitions with unequal sums are read, and of these only rows in unequal
    buckets take part in the comparison, in which a key's rows are summed on
    each side. A key that moved to another partition with otherwise equal
    ``cols`` is compared over all partitions read, so it is no difference
    unless the partition is one of ``cols``. Null keys match each other.
    """
    parts = differing_parts(one, other)
    nodes = _unequal(one, other, ["part", "bucket"])
    sides = []
    for sign, read in ((1, read_other), (-1, read_one)):
        df = read(parts)
        (own,), names = require_columns(df, [partition]), require_columns(df, keys)
        rows = df.select(
            *[column(n).alias(k) for n, k in zip(names, keys)],
            column(own).cast("string").alias("part"),
            _bucket(names, buckets).alias("bucket"),
            row_digest([column(c) for c in require_columns(df, cols)], NULL).alias("digest"),
        ).alias("r")
        same = F.col("r.part").eqNullSafe(F.col("n.part")) & (F.col("r.bucket") == F.col("n.bucket"))
        sides.append(rows.join(nodes.alias("n"), same, "left_semi").withColumn("side", F.lit(sign)))
    rows = sides[0].unionByName(sides[1])
    types = {f.name: f.dataType for f in rows.schema.fields}
    match = match_parts({k: column(k) for k in keys}, types, "__key")
    lanes = {f"lane_{i}": s for i, s in enumerate(lane_sums(F.col("digest")))}
    per_side = rows.select(*[column(k) for k in keys], "side", "digest", *[c.alias(n) for n, c in match.items()])
    per_side = per_side.groupBy(*match, "side").agg(*[F.first(column(k)).alias(k) for k in keys], F.count("*").alias("n_rows"), *[c.alias(n) for n, c in lanes.items()])
    both = per_side.groupBy(*match).agg(
        *[F.first(column(k)).alias(k) for k in keys],
        F.sum("side").alias("side"),
        reduce(and_, [F.sum(F.col(c) * F.col("side")) == 0 for c in SUMS]).alias("equal"),
    )
    change = F.when(F.col("side") > 0, "added").when(F.col("side") < 0, "removed").otherwise("changed")
    return both.filter(~F.col("equal")).select(*map(column, keys), change.alias("change"))
