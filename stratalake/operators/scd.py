"""Type-2 slowly changing dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.fixed import ACTIVE, INACTIVE, IS_CURRENT, OPEN_END, VALID_FROM, VALID_TO
from stratalake.functions.matching import match_parts
from stratalake.functions.names import column, fresh_name, quoted, require_columns
from stratalake.operators.dedup import keep_one


def _changed(tracked: Sequence[str], null_safe: bool) -> Column:
    tests = []
    for name in tracked:
        new, old = F.col(f"new.{quoted(name)}"), F.col(f"old.{quoted(name)}")
        tests.append(~new.eqNullSafe(old) if null_safe else F.coalesce(new != old, F.lit(False)))
    return reduce(or_, tests, F.lit(False))


def apply_scd2(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    processing_date: object | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    is_current: str = IS_CURRENT,
    open_end: str = OPEN_END,
    active: int = ACTIVE,
    inactive: int = INACTIVE,
    null_safe: bool = True,
    keep_unchanged: bool = True,
    order_by: Sequence[str] = (),
    snapshot_unique: bool = False,
) -> DataFrame:
    """The history after one snapshot.

    Changed keys get their active row closed at the processing date and a new
    open row; new keys get an open row; everything else stays as it is.
    Applying the same snapshot again on the same date changes nothing.

    ``null_safe=False`` compares with plain ``=``: null keys never match and a
    change to or from null goes unseen. ``keep_unchanged=False`` returns the
    change set only: closed history, closures and new rows.

    Closed history is passed through without a shuffle. Active rows are the
    streamed side of a left join against a snapshot with one row per key (the
    greatest by ``order_by``, then by the other columns), so a frequent key
    can be split and a small snapshot broadcast; which keys to open is an anti
    join against the distinct active (key, tracked) values. The snapshot
    reaches the left join in the partitioning its de-duplication left it in,
    and so do the distinct values the anti join.
    """
    keys, tracked = require_columns(history, keys), require_columns(history, tracked)
    require_columns(history, [valid_from, valid_to, is_current])
    require_columns(snapshot, [*keys, *tracked])
    own = [c for c in history.columns if c not in (valid_from, valid_to, is_current)]
    rows = snapshot.drop(valid_from, valid_to, is_current)
    if {c.lower() for c in rows.columns} != {c.lower() for c in own}:
        raise AnalysisException(f"Snapshot columns {rows.columns} differ from history columns {own}")
    types = {f.name: f.dataType for f in history.schema.fields}
    rows = rows.select(*[column(n).cast(types[c]).alias(c) for n, c in zip(require_columns(rows, own), own)])

    def parts(cols: Sequence[str], stem: str, side: str | None = None) -> dict[str, Column]:
        own_cols = {c: F.col(f"{side}.{quoted(c)}") if side else column(c) for c in cols}
        if not null_safe:
            return {f"{stem}{i}": c for i, c in enumerate(own_cols.values())}
        return match_parts(own_cols, types, stem)

    key, value = fresh_name(history, "key"), fresh_name(history, "value")
    rows = rows.withColumns(parts(keys, key))
    key_parts = [c for c in rows.columns if c not in own]
    if not snapshot_unique:
        rows = keep_one(rows, key_parts, list(order_by))

    when = F.current_date() if processing_date is None else F.lit(processing_date).cast("date")
    today, forever = when.cast(types[valid_to]), F.lit(open_end).cast("date").cast(types[valid_to])
    flag_type = types[is_current]

    closed = history.filter(column(is_current) == inactive)
    current = history.filter(column(is_current) == active)
    changed = _changed(tracked, null_safe)

    # Active rows: one output row each, closed in place where they changed.
    present = fresh_name(history, "present")
    new = rows.select(*key_parts, *[column(c) for c in tracked], F.lit(True).alias(present)).alias("new")
    same_key = reduce(and_, [c == F.col(f"new.{n}") for n, c in parts(keys, key, "old").items()])
    joined = current.alias("old").join(new, same_key, "left")
    closes = F.coalesce(F.col(f"new.{present}"), F.lit(False)) & changed
    if not keep_unchanged:
        joined, closes = joined.filter(closes), F.lit(True)
    old = {c: F.col(f"old.{quoted(c)}") for c in history.columns}
    old[valid_to] = F.when(closes, today).otherwise(old[valid_to])
    old[is_current] = F.when(closes, F.lit(inactive).cast(flag_type)).otherwise(old[is_current])
    kept = joined.select(*[c.alias(name) for name, c in old.items()])

    # Snapshot rows with no equal active row: new or changed.
    if null_safe:
        every = {**parts(keys, key), **parts(tracked, value)}
        known = current.select(*[c.alias(n) for n, c in every.items()]).distinct()
        opened = rows.withColumns(parts(tracked, value)).join(known, list(every), "left_anti")
    else:
        known = current.select(*[c.alias(n) for n, c in parts(keys, key).items()], *[column(c) for c in tracked])
        same_key = reduce(and_, [F.col(f"new.{n}") == F.col(f"old.{n}") for n in key_parts])
        opened = rows.alias("new").join(known.distinct().alias("old"), same_key & ~changed, "left_anti")
    opened = opened.select(*[column(c) for c in own]).withColumns({
        valid_from: when.cast(types[valid_from]),
        valid_to: forever,
        is_current: F.lit(active).cast(flag_type),
    })
    return closed.unionByName(kept).unionByName(opened)
