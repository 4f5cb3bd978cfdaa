"""Exact top-k inner products by columnar branch and bound.

Queries and candidates are dealt into blocks of bounded size, and every pair of a query block and a candidate block is
one group: the candidates go to each query block and the queries to each candidate block. In a group the candidates lie
dimension by dimension (the heaviest dimensions first). For each query, partial sums grow by STEP dimensions at a time;
what the dimensions to come can add is at most the product of the two remaining norms, so candidates whose bound is
below the k-th best score seen are dropped and the rest is compacted. The first candidates are scored in full to have a
k-th best score from the start. The best k of each group meet in one ranking per query.

Defined results: vectors that are null, hold null or non-finite components, or have no id take no part, nor do those
whose scaled components have more than 63 bits; only vectors of the same length are compared; equal scores are
ranked by the smaller id; rows that share an id count as one vector with the best of its scores, and never match each
other; with fewer than k candidates all are returned; an empty table gives no rows. Sums wrap at 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stratalake.functions.names import column

K, EVERY, SCALE = 5, 50, 256
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
STEP, SEED = 8, 128


def whole_numbers(column_: pa.ChunkedArray, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of floor(scale * component), for each length of vector."""
    array = column_.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], array.type)
    lengths = np.diff(array.offsets.to_numpy())
    values = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    out = []
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out.append((rows, np.floor(scale * values[starts[rows][:, None] + np.arange(d)]).astype(np.int64)))
    return out


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids and scores: for each query its k best vectors of another id, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")  # so that the stable choice among ties is the one by id
    ids, vectors = ids[order], vectors[order]
    d = vectors.shape[1]
    most = float(max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0)))
    exact = d * most * most < 2.0**53
    single = len(ids) < 2 or bool((ids[1:] != ids[:-1]).all())
    if exact:
        queries, vectors = queries.astype(float), vectors.astype(float)
        heavy = np.argsort(-(vectors**2).sum(0), kind="stable")
        queries, vectors = queries[:, heavy], vectors[:, heavy]
    layout = np.ascontiguousarray(vectors.T)  # one row per dimension
    steps = list(range(0, d, STEP))
    if exact:
        left = np.sqrt(np.cumsum((layout**2)[::-1], 0)[::-1])  # norm from each dimension on
        query_left = np.sqrt(np.cumsum((queries**2)[:, ::-1], 1)[:, ::-1])
    out_q, out_v, out_s = [], [], []
    for i, own in enumerate(query_ids):
        q = queries[i]
        alive = np.flatnonzero(ids != own)
        if exact and single and len(alive) > max(SEED, k):
            floor_ = np.partition(q @ layout[:, alive[:SEED]], SEED - k)[SEED - k]
            sums = np.zeros(len(alive))
            for at in steps:
                sums += q[at : at + STEP] @ layout[at : at + STEP, alive]
                if at + STEP < d:
                    reach = sums + query_left[i, at + STEP] * left[at + STEP, alive] * (1 + 1e-9) + 1e-3
                    kept = reach >= floor_
                    if not kept.all():
                        alive, sums = alive[kept], sums[kept]
        else:
            sums = q @ layout[:, alive]
        chosen = np.lexsort((ids[alive], -sums))
        if not single:  # the best score of an id counts
            chosen = chosen[np.sort(np.unique(ids[alive][chosen], return_index=True)[1])]
        chosen = chosen[:k]
        out_q.append(np.full(len(chosen), own))
        out_v.append(ids[alive][chosen])
        out_s.append(sums[chosen].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_v, out_s))


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    chosen = rows.select(column(id_col).cast("long").alias("vec_id"), column(vector_col).cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) * F.lit(float(scale)) < F.lit(2.0**63)) & ~F.isnan(x))
    usable = chosen.filter(F.col("vec_id").isNotNull() & whole).distinct()
    asks = F.col("vec_id") % every == 0
    n, queries = usable.agg(F.count("*"), F.count_if(asks)).first()
    q_blocks, c_blocks = queries // QUERY_BLOCK + 1, n // CANDIDATE_BLOCK + 1
    spread = F.xxhash64("vec_id", "vector")
    candidates = usable.select("vec_id", "vector", F.lit(False).alias("asks"), F.pmod(spread, F.lit(c_blocks)).alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("q"))
    asked = usable.filter(asks).select("vec_id", "vector", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))).alias("c"), F.pmod(spread, F.lit(q_blocks)).alias("q"))

    def group(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        asking = table.column("asks").to_numpy()
        found = []
        for at, matrix in whole_numbers(table.column("vector"), scale):
            own = asking[at]
            found.append(best(ids[at][own], matrix[own], ids[at][~own], matrix[~own], k))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

    near = candidates.unionByName(asked).groupBy("c", "q").applyInArrow(group, "query_id long, vec_id long, score long")
    one = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
