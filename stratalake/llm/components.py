"""Connected components by alternating stars, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected links ``a, b``: the root is the smallest node that it reaches.

    A round lets each node point its larger neighbours, and then its smaller ones, to the smallest of all; the number of
    rounds grows with the logarithm of the longest path. Each round is written, so lost executors cost one round at most.
    A node with very many neighbours is a large group of a minimum, which is combined before the shuffle, and a large
    side of a join against one row, which adaptive execution splits.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``node, root`` after more links ``a, b``: only the roots that the links touch are connected again."""
    if links.isEmpty():
        return roots
    ends = links
    for side in "ab":
        known = roots.select(F.col("node").alias(side), F.col("root").alias("known"))
        ends = ends.join(known, side, "left").withColumn(side, F.coalesce("known", side)).drop("known")
    moved = written(connected(ends.select("a", "b")), "moved")
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return written(old.unionByName(moved.join(roots, "node", "left_anti")), "roots")
