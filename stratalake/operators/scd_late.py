"""Type-2 history with late and repeated effective dates, by stitching intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.fixed import ACTIVE, INACTIVE, IS_CURRENT, OPEN_END, VALID_FROM, VALID_TO
from stratalake.functions.matching import match_parts
from stratalake.functions.names import column, fresh_name, require_columns
from stratalake.operators.dedup import unorderable

# What begins at a date, the stronger one last: the end of an interval, a known interval, a change.
ENDS, KNOWN, CHANGE = 0, 1, 2


def apply_changes(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    order_by: Sequence[str] = (),
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    is_current: str = IS_CURRENT,
    open_end: str = OPEN_END,
    active: int = ACTIVE,
    inactive: int = INACTIVE,
) -> DataFrame:
    """The history after changes that carry their own effective dates, in any order, early or late.

    A change holds from its date to the next date at which something else is
    known to begin: it cuts the interval it falls into, and what began later
    stays. Of changes of a key on one date the greatest by ``order_by``, then
    by the other columns, counts; a change on the date of a known interval
    takes its place. Neighbours with equal tracked values become one interval,
    which keeps the earlier row; gaps between intervals stay gaps. Changes
    without a date are refused by nothing and change nothing. Applying the
    same changes again changes nothing.

    History and changes are read once, as one union: the strongest row of each
    key and date is found with a group limit before the shuffle, so a key with
    many rows sends one per date, and one pass over each key's dates compares
    neighbours and sets the ends. Null keys are one key.
    """
    keys, tracked = require_columns(history, keys), require_columns(history, tracked)
    require_columns(history, [valid_from, valid_to, is_current])
    (effective,) = require_columns(changes, [effective])
    own = [c for c in history.columns if c not in (valid_from, valid_to, is_current)]
    types = {f.name: f.dataType for f in history.schema.fields}
    given = changes.drop(valid_from, valid_to, is_current) if effective not in (valid_from, valid_to, is_current) else changes
    if missing := [c for c in own if c.lower() not in {g.lower() for g in given.columns}]:
        raise AnalysisException(f"Changes lack the history columns {missing}")
    extra = require_columns(given, order_by)

    start, kind, rank, previous = (fresh_name(history, n) for n in ("start", "kind", "rank", "previous"))
    orders = [fresh_name(history, f"order_{i}") for i in range(len(extra))]
    forever = F.lit(open_end).cast("date")
    none = [F.lit(None).cast(given.schema[c].dataType).alias(o) for c, o in zip(extra, orders)]
    change = given.filter(column(effective).isNotNull()).select(
        *[column(n).cast(types[c]).alias(c) for n, c in zip(require_columns(given, own), own)],
        column(effective).cast("date").alias(start),
        F.lit(CHANGE).alias(kind),
        *[column(c).alias(o) for c, o in zip(extra, orders)],
    )
    # A known interval gives its start and, if it is closed, its end.
    edges = F.array(
        F.struct(column(valid_from).cast("date").alias(start), F.lit(KNOWN).alias(kind)),
        F.struct(F.when(column(valid_to).cast("date") < forever, column(valid_to).cast("date")).alias(start), F.lit(ENDS).alias(kind)),
    )
    known = history.select(*map(column, own), F.inline(edges), *none).filter(F.col(start).isNotNull())

    points = known.unionByName(change)
    match = match_parts({k: column(k) for k in keys}, types, "__key")
    points = points.select("*", *[c.alias(n) for n, c in match.items()])

    def descending(c: str) -> Column:
        return (F.to_json(column(c)) if unorderable(points.schema[c].dataType) else column(c)).desc_nulls_last()

    strongest = Window.partitionBy(*match, start).orderBy(F.desc(kind), *map(descending, orders), *map(descending, own))
    single = points.withColumn(rank, F.row_number().over(strongest)).filter(F.col(rank) == 1).drop(rank, *orders)

    by_date = Window.partitionBy(*match).orderBy(start)
    value = F.struct((F.col(kind) == ENDS).alias("gap"), *[F.when(F.col(kind) != ENDS, column(c)).alias(f"v{i}") for i, c in enumerate(tracked)])
    compared = single.withColumn(previous, F.lag(value).over(by_date))
    nothing_before = F.col(previous).isNull()
    repeats = F.coalesce(value.eqNullSafe(F.col(previous)), F.lit(False)) & ~nothing_before
    begun = compared.filter(~repeats & ~(nothing_before & (F.col(kind) == ENDS))).drop(previous)
    following = F.lead(start).over(by_date)
    whole = begun.withColumn(previous, following).filter(F.col(kind) != ENDS)
    flag = F.when(F.col(previous).isNull(), F.lit(active)).otherwise(F.lit(inactive))
    out = {
        valid_from: F.col(start).cast(types[valid_from]),
        valid_to: F.coalesce(F.col(previous), forever).cast(types[valid_to]),
        is_current: flag.cast(types[is_current]),
    }
    return whole.select(*[out[c].alias(c) if c in out else column(c) for c in history.columns])
