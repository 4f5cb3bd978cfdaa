"""File layout: balanced, clustered and partitioned writes, statistics."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate, groupby
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from stratalake.functions.bits import as_ordered, bisected, hilbert_index, interleaved
from stratalake.functions.names import column, fresh_name, quoted, require_columns
from stratalake.sources.tables import publish, version_dir


# Rows that stand for a table when bounds are chosen: SHARDS groups of SHARE rows, and their seed.
SHARDS, SHARE, SEED = 16, 256, 42
# Cells per file, at least; cells of the curve, at most; columns that take part in the curve, at most.
CELLS_PER_FILE, CELL_BITS, CURVE = 16, 16, 16
# How far, in files, a file may end from where it should, to end at a larger block of the curve.
SLACK = 0.35
# Cells, at most, that are sent to every executor, so that rows find their file without a shuffle.
SENT_CELLS = 1 << 20


def rebalanced(df: DataFrame, *cols: str, files: int | None = None) -> DataFrame:
    """Fewer, even files without narrowing the stages before the write.

    With ``files`` the rows are dealt out to that many partitions; without it
    adaptive execution picks the number from the measured size and splits what
    is too big.
    """
    if files is not None:
        return df.repartition(files)
    return df.hint("rebalance", *[column(c) for c in require_columns(df, cols)])


def cluster_bounds(df: DataFrame, cols: Sequence[str], bits: int) -> dict[str, list]:
    """Ascending bucket bounds per column, up to 2**bits - 1: whole values for texts, numbers for all else.

    They split a uniform sample of the rows, the same on every run: rows are
    dealt by a hash of their place into SHARDS groups, of which SHARE rows
    each stay. A task sends SHARDS * SHARE rows of these columns at most, and
    only the bounds come to the driver.
    """
    cols = require_columns(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [as_ordered(column(c), types[c]) for c in cols]
    values = [(v if isinstance(types[c], T.StringType) else v.cast("double")).alias(f"v{i}") for i, (c, v) in enumerate(zip(cols, values))]
    rows = df.select(*values, F.xxhash64(F.monotonically_increasing_id(), F.lit(SEED)).alias("at"))
    rows = rows.withColumn("shard", F.pmod("at", F.lit(SHARDS)))
    own = Window.partitionBy("shard").orderBy("at")
    sample = rows.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= SHARE)
    steps = F.sequence(F.lit(1), F.lit(2**bits - 1))

    def picked(i: int) -> Column:
        ordered = F.sort_array(F.collect_list(f"v{i}"))
        place = lambda step: F.floor(step * F.size(ordered) / F.lit(2**bits)).cast("int")
        return F.when(F.size(ordered) > 0, F.transform(steps, lambda step: F.get(ordered, place(step)))).alias(f"v{i}")

    row = sample.agg(*[picked(i) for i in range(len(cols))]).first()
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(cols)}


def with_zorder_key(
    df: DataFrame, name: str, cols: Sequence[str], bounds: dict[str, Sequence], bits: int
) -> DataFrame:
    """Add the bucket numbers of the columns, bit-interleaved."""
    cols = require_columns(df, cols)
    for c in cols:
        if len(bounds[c]) >= 2**bits:
            raise ValueError(f"{len(bounds[c])} bounds of {c} need more than {bits} bits")
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = {fresh_name(df, f"number_{i}"): as_ordered(column(c), types[c]) for i, c in enumerate(cols)}
    key = interleaved([F.col(n) for n in numbers], [bounds[c] for c in cols], bits)
    return df.withColumns(numbers).withColumn(name, key).drop(*numbers)


def _block_of(before: int, after: int) -> int:
    """The size, as a power of two, of the largest block of the curve that begins after ``before``, up to ``after``."""
    level = 0
    while (after >> (level + 1)) << (level + 1) > before:
        level += 1
    return level


def cut_cells(counts: Sequence[tuple[int, int]], size: float) -> list[tuple[int, int]]:
    """For cells ``(place on the curve, rows)`` in order: the first file of each and how many files it has.

    Files end at cells. Of the cells that end near where a file of ``size``
    rows should, the one that also ends the largest block of the curve is
    taken, so files are whole blocks where they can be. A cell with more rows
    than one and a half files has files of its own.
    """
    out: list[tuple[int, int]] = []
    file = at = 0
    while at < len(counts):
        if counts[at][1] >= 1.5 * size:
            share = round(counts[at][1] / size)
            out.append((file, share))
            file, at = file + share, at + 1
            continue
        end = at
        while end < len(counts) and counts[end][1] < 1.5 * size:
            end += 1
        segment = counts[at:end]
        sums = list(accumulate(n for _, n in segment))
        parts = max(1, round(sums[-1] / size))
        bounds, last = [], 0
        for part in range(1, parts):
            ideal = sums[-1] * part / parts
            rated = []
            for i in range(last + 1, len(segment)):
                off = abs(sums[i - 1] - ideal) / size
                rated.append((off <= SLACK, _block_of(segment[i - 1][0], segment[i][0]) if off <= SLACK else 0, -off, i))
            if not rated:
                break
            last = max(rated)[-1]
            bounds.append(last)
        out += [(file + bisect_right(bounds, i), 1) for i in range(len(segment))]
        file, at = file + len(bounds) + 1, end
    return out


def clustered(
    df: DataFrame, cols: Sequence[str], files: int | None = None, bits: int | None = None, lead: Sequence[str] = ()
) -> DataFrame:
    """Rows ordered along a Hilbert curve over ``cols``, so Parquet min/max
    values let a filter on any of them skip most files.

    Every column is cut at bounds of equal shares, ``bits`` of them (as many as
    ``files`` call for), which makes cells; the cells are counted, and files
    are runs of whole cells along the curve. A cell that most rows share is
    spread over several files. ``lead`` columns come before the curve, for
    tables that are also partitioned by them. Without ``files`` there are as
    many as the session has shuffle partitions.

    The input runs three times: for the bounds, for the counts, and for the
    rows. The driver gets one row per cell that is not empty (2**CELL_BITS per
    lead value at most). Beyond CURVE columns, the others only order the rows
    of a file.
    """
    cols, lead = require_columns(df, cols), require_columns(df, lead)
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    axes = cols[:CURVE]
    if bits is None:
        bits = max(1, min(CELL_BITS // len(axes), -(-(files * CELLS_PER_FILE - 1).bit_length() // len(axes))))
    types = {f.name: f.dataType for f in df.schema.fields}
    bounds = cluster_bounds(df, axes, bits)
    buckets = [bisected(as_ordered(column(c), types[c]), bounds[c], [i << (bits * k) for i in range(len(bounds[c]) + 1)]) for k, c in enumerate(axes)]
    cell = fresh_name(df, "cell")
    keyed = df.withColumn(cell, reduce(Column.__add__, buckets))
    counts = [tuple(r) for r in keyed.groupBy(*[column(c) for c in lead], cell).count().collect()]
    if not counts:
        return df
    mask = (1 << bits) - 1
    on_curve = lambda number: hilbert_index([number >> (bits * k) & mask for k in range(len(axes))], bits)
    order = sorted(counts, key=lambda r: (*((v is not None, v) for v in r[: len(lead)]), on_curve(r[-2])))
    size = sum(r[-1] for r in order) / files
    planned, first = [], 0
    for _, rows in groupby(order, key=lambda r: r[: len(lead)]):
        own = list(rows)
        cuts = cut_cells([(on_curve(r[-2]), r[-1]) for r in own], size)
        planned += [(*r[:-1], place, first + file, share) for place, (r, (file, share)) in enumerate(zip(own, cuts))]
        first += cuts[-1][0] + cuts[-1][1]
    place, file, share = (fresh_name(df, n) for n in ("place", "file", "share"))
    fields = [df.schema[c] for c in lead] + [T.StructField(n, T.LongType()) for n in (cell, place, file, share)]
    plan = spark.createDataFrame(planned, T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    if len(planned) <= SENT_CELLS:
        plan = F.broadcast(plan)
    same = reduce(and_, [F.col(f"r.{quoted(c)}").eqNullSafe(F.col(f"p.{quoted(c)}")) for c in (*lead, cell)])
    joined = keyed.alias("r").join(plan.alias("p"), same, "left").select("r.*", *[F.coalesce(F.col(f"p.{n}"), F.lit(0)).alias(n) for n in (place, file)], F.coalesce(F.col(f"p.{share}"), F.lit(1)).alias(share))
    target = (F.col(file) + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(share))).cast("int")
    dealt = joined.withColumn(file, target).repartitionById(first, F.col(file))
    return dealt.sortWithinPartitions(*map(column, lead), place, *map(column, cols)).drop(cell, place, file, share)


def cluster_write(
    df: DataFrame, path: str, cols: Sequence[str], files: int | None = None, bits: int | None = None, max_records_per_file: int = 0
) -> int:
    """Publish ``df`` clustered by ``cols``."""
    return publish(clustered(df, cols, files, bits), path, max_records_per_file=max_records_per_file)


def partitioned_write(
    df: DataFrame, path: str, partition: str, sort_by: Sequence[str] = (), max_records_per_file: int = 0
) -> int:
    """Publish ``df`` with one directory per value of ``partition``; values
    with many rows get several files, each sorted by ``sort_by``."""
    out = rebalanced(df, partition)
    if sort_by:
        out = out.sortWithinPartitions(partition, *sort_by)
    return publish(out, path, [partition], max_records_per_file)


def analyze_table(spark: SparkSession, table: str, columns: bool = True) -> None:
    """Statistics of a catalog table for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else ""))


def optimize_for_reads(
    df: DataFrame, path: str, cols: Sequence[str], table: str | None = None, files: int | None = None
) -> int:
    """Publish clustered and, if ``table`` names a catalog table, point it at
    the new files and compute its statistics.

    The table is created if absent. One that exists is never dropped; it must
    be external and have the columns of ``df``, and is refused otherwise before
    anything is written.
    """
    spark = df.sparkSession
    known = table is not None and spark.catalog.tableExists(table)
    if known:
        kind = spark.catalog.getTable(table).tableType
        if kind != "EXTERNAL":
            raise AnalysisException(f"{table} is no external table but {kind}")
        if spark.table(table).schema.simpleString() != df.schema.simpleString():
            raise AnalysisException(f"{table} has other columns than the rows to publish")
    version = cluster_write(df, path, cols, files)
    if table is not None:
        place = version_dir(path, version)
        if known:
            literal = place.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{literal}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, place, "parquet")
        analyze_table(spark, table)
    return version
