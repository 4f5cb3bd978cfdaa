"""Bronze to silver as a stream: every micro-batch is upserted."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions.names import fresh_name, require_columns
from stratalake.plans.silver import publish_silver
from stratalake.sources.feeds import Feed
from stratalake.sources.tables import upsert_partitions


def without_repeats(stream: DataFrame, within: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The stream without rows that came before, in this or an earlier micro-batch, equal in ``cols`` (all by default).

    A state store, kept by the checkpoint over restarts, remembers each row for
    the time ``within`` since it was first seen. That clock is the time of
    arrival, not a column of the rows: no row is ever too late, and one that
    comes again after that time passes once more, which an upsert takes.
    """
    cols = stream.columns if cols is None else require_columns(stream, cols)
    seen = fresh_name(stream, "seen")
    marked = stream.withColumn(seen, F.current_timestamp()).withWatermark(seen, within)
    return marked.dropDuplicatesWithinWatermark(list(cols)).drop(seen)


def upsert_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    partition: str,
    order_by: Sequence[str] = (),
    derived_from: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Upsert all available input into a table published by ``partition``, then stop.

    ``prepare`` turns a micro-batch into rows of the table. A batch replayed
    after a failure replaces its own rows by themselves, so at-least-once
    delivery still gives exactly one row per key. Only the touched partitions
    are rewritten, never the whole table; ``derived_from`` as in
    ``upsert_partitions``. With ``repeats_within``, rows that were seen within
    that time never reach the upsert (``without_repeats``).
    """
    stream = stream if repeats_within is None else without_repeats(stream, repeats_within)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        upsert_partitions(rows, path, partition, keys, order_by, derived_from=derived_from)

    return _each_batch(stream, merge, checkpoint)


def silver_stream(
    stream: DataFrame, feed: Feed, path: str, checkpoint: str, as_of: object | None = None
) -> StreamingQuery:
    """Clean, de-duplicate and upsert all available bronze rows of a feed,
    rewriting only the months each micro-batch touches, then stop."""
    return _each_batch(stream, lambda batch, _: publish_silver(batch, feed, path, as_of), checkpoint)


def _each_batch(stream: DataFrame, step: Callable[[DataFrame, int], object], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
