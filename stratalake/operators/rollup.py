"""Additive states of the monthly aggregate: roll-ups to coarser keys and maintenance by signed changes.

The published aggregate has means and distinct counts, which cannot be added up. A *state* row per group holds what can:
the number of rows, and for each measure its sum (whole units, exact), the number of its values, least and greatest. Places
of coarser groups are counted exactly by bitmaps, 32,768 identifiers each, that merge by a bitwise or.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.fixed import MONTHLY_KEYS
from stratalake.functions.matching import match_parts
from stratalake.functions.names import column, require_columns

# Measure of the state -> column of the trips, output names of sum, mean and greatest.
MEASURES = {
    "distance": ("trip_distance", "distancia_total", "media_distancia", "max_distancia"),
    "amount": ("total_amount", "faturamento_total", "media_valor", "max_valor"),
}
# Place column -> output name of its distinct count.
PLACES = {"pulocationid": "locais_embarque", "dolocationid": "locais_desembarque"}
CLOCK = "pickup_datetime"
ROWS, FIRST, LAST = "n_rows", "first_pickup", "last_pickup"
# Column of a state that is negative in a before-image.
SIGN = "change_sign"
DECIMAL = "decimal(38,0)"


def _units(value: Column, scale: int) -> Column:
    """Whole units of the scale. Not finite values and those of 2**53 units and more are no exact numbers of units."""
    whole = F.rint(value.cast("double") * F.lit(float(10**scale)))
    return F.when(F.abs(whole) < F.lit(2.0**53), whole).cast("bigint").cast(DECIMAL)


def trip_states(trips: DataFrame, keys: Sequence[str] = tuple(MONTHLY_KEYS), scale: int = 2) -> DataFrame:
    """One state row per group of trips, in one map-side aggregate.

    If the trips have a column ``change_sign`` of 1 and -1, sums and counts are
    signed, extremes are those of the added rows, and ``gone_*`` columns hold
    those of the removed rows; otherwise those columns are null. Values that
    are no exact number of units are summed as doubles, in ``*_rest``.
    """
    keys = require_columns(trips, keys)
    signed = SIGN in trips.columns
    sign = column(SIGN) if signed else F.lit(1)
    added = (lambda c: F.when(sign > 0, c)) if signed else (lambda c: c)
    gone = (lambda c: F.when(sign < 0, c)) if signed else (lambda c: F.when(F.lit(False), c))
    out = [F.sum(sign).cast("bigint").alias(ROWS)]
    for name, (source, *_) in MEASURES.items():
        c = column(source).cast("double")
        units = _units(c, scale)
        rest = F.when(c.isNotNull() & units.isNull(), c * sign)
        out += [
            F.coalesce(F.sum(units * sign.cast(DECIMAL)), F.lit(0)).cast(DECIMAL).alias(f"{name}_units"),
            F.coalesce(F.sum(rest), F.lit(0.0)).alias(f"{name}_rest"),
            F.coalesce(F.sum(F.when(c.isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"{name}_values"),
            F.max(added(c)).alias(f"{name}_max"),
            F.max(gone(c)).alias(f"gone_{name}_max"),
        ]
    clock = column(CLOCK)
    out += [F.min(added(clock)).alias(FIRST), F.max(added(clock)).alias(LAST)]
    out += [F.min(gone(clock)).alias(f"gone_{FIRST}"), F.max(gone(clock)).alias(f"gone_{LAST}")]
    return trips.groupBy(*map(column, keys)).agg(*out)


def _merged() -> list[Column]:
    """Aggregates that merge state rows."""
    out = [F.sum(ROWS).cast("bigint").alias(ROWS)]
    for name in MEASURES:
        out += [
            F.sum(f"{name}_units").cast(DECIMAL).alias(f"{name}_units"),
            F.sum(f"{name}_rest").alias(f"{name}_rest"),
            F.sum(f"{name}_values").cast("bigint").alias(f"{name}_values"),
            F.max(f"{name}_max").alias(f"{name}_max"),
        ]
    return [*out, F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)]


def place_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, place, bucket, bits``: which identifiers of each place column occur in each group.

    ``rows`` are trips, or states that have the places among their keys. Tasks
    send one bitmap of 4 KB per group and 32,768 identifiers at most.
    """
    keys = require_columns(rows, keys)
    pairs = [F.struct(F.lit(p).alias("place"), column(p).cast("bigint").alias("id")) for p in PLACES]
    own = rows.select(*map(column, keys), F.inline(F.array(*pairs))).filter("id is not null")
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    return own.groupBy(*map(column, keys), "place", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def place_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact distinct counts per group of ``keys``, from bitmaps of the same or finer groups."""
    keys = require_columns(bitmaps, keys)
    merged = bitmaps.groupBy(*map(column, keys), "place", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = [F.coalesce(F.sum(F.when(F.col("place") == p, F.bitmap_count("bits"))), F.lit(0)).alias(n) for p, n in PLACES.items()]
    return merged.groupBy(*map(column, keys)).agg(*counts)


def roll_up(states: DataFrame, bitmaps: DataFrame, keys: Sequence[str], scale: int = 2) -> DataFrame:
    """The monthly aggregate for ``keys``, a subset of those of the states and of the bitmaps: no trip is read again.

    Sums and counts come from one side and place counts from the other; both
    are brought together by one more aggregate, so null keys need no care and
    a frequent key is combined map-side.
    """
    keys = require_columns(states, keys)
    sums = states.groupBy(*map(column, keys)).agg(*_merged())
    both = sums.unionByName(place_counts(bitmaps, keys), allowMissingColumns=True)
    counts = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in PLACES.values()]
    return _answers(both.groupBy(*map(column, keys)).agg(*_merged(), *counts), keys, scale)


def states_to_monthly(states: DataFrame, keys: Sequence[str] = tuple(MONTHLY_KEYS), scale: int = 2) -> DataFrame:
    """The monthly aggregate of states whose keys include the places."""
    keys = require_columns(states, keys)
    require_columns(states.select(*map(column, keys)), PLACES)
    present = {n: F.when(column(p).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint") for p, n in PLACES.items()}
    return _answers(states.withColumns(present), keys, scale)


def _answers(states: DataFrame, keys: Sequence[str], scale: int) -> DataFrame:
    unit = F.lit(float(10**scale))
    total = {n: F.when(F.col(f"{n}_values") > 0, F.col(f"{n}_units").cast("double") / unit + F.col(f"{n}_rest")) for n in MEASURES}
    out = [*map(column, keys), F.col(ROWS).alias("qtd_corridas"), *map(F.col, PLACES.values())]
    out += [total[n].alias(names[1]) for n, names in MEASURES.items()]
    out += [F.try_divide(total[n], F.col(f"{n}_values")).alias(names[2]) for n, names in MEASURES.items()]
    out += [F.col(f"{n}_max").alias(names[3]) for n, names in MEASURES.items()]
    return states.select(*out, F.col(FIRST).alias("min_data"), F.col(LAST).alias("max_data"))


def upsert_images(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that an upsert of ``source`` (one row per key) changes: those it removes with a ``change_sign`` of -1, those
    it adds with 1. Null keys match each other; a row that is replaced by an equal one gives both images."""
    keys = require_columns(target, keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    match = match_parts({k: column(k) for k in keys}, types, "__key")
    after = source.select(*[column(n).cast(types[c]).alias(c) for n, c in zip(require_columns(source, target.columns), target.columns)])
    named = [c.alias(n) for n, c in match.items()]
    before = target.select("*", *named).join(after.select(*named).distinct(), list(match), "left_semi").drop(*match)
    return before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))


def changed_states(states: DataFrame, changes: DataFrame, keys: Sequence[str] = tuple(MONTHLY_KEYS)) -> DataFrame:
    """States after signed changes (``trip_states`` of rows with ``change_sign``), for the groups that change only, with a
    column ``stale``: whether a removed row may have been the extreme of its group, which then has to be read again.

    Groups that lose all rows keep a state with no rows, so that a reader of
    the result can tell them from groups that did not change.
    """
    keys = require_columns(states, keys)
    rows = states.select(*map(column, keys), *_state_columns(states)).withColumn("__old", F.lit(1))
    new = changes.withColumn("__old", F.lit(0))
    grouped = rows.unionByName(new, allowMissingColumns=True).groupBy(*map(column, keys))
    known = lambda c: F.max(F.when(F.col("__old") == 1, column(c)))
    added_max = lambda c: F.max(F.when(F.col("__old") == 0, column(c)))
    added_min = lambda c: F.min(F.when(F.col("__old") == 0, column(c)))
    stale = []
    for c in [*(f"{n}_max" for n in MEASURES), LAST]:
        stale.append((F.max(column(f"gone_{c}")) >= known(c)) & F.coalesce(added_max(c) < known(c), F.lit(True)))
    stale.append((F.min(column(f"gone_{FIRST}")) <= known(FIRST)) & F.coalesce(added_min(FIRST) > known(FIRST), F.lit(True)))
    whole = reduce(lambda a, b: a | b, [F.coalesce(s, F.lit(False)) for s in stale])
    out = grouped.agg(*_merged(), whole.alias("stale"), F.min("__old").alias("__old"))
    return out.filter(F.col("__old") == 0).drop("__old").withColumn("stale", F.col("stale") & (F.col(ROWS) > 0))


def _state_columns(states: DataFrame) -> list[Column]:
    names = [ROWS, *(f"{n}_{part}" for n in MEASURES for part in ("units", "rest", "values", "max")), FIRST, LAST]
    return [column(c) for c in require_columns(states, names)]


def maintained_states(
    states: DataFrame, images: DataFrame, current: DataFrame, keys: Sequence[str] = tuple(MONTHLY_KEYS), scale: int = 2
) -> DataFrame:
    """All states after an upsert of the trips behind them.

    ``images`` are the trips removed and added, with ``change_sign``;
    ``current`` the trips after the upsert, of which only those of groups that
    lost an extreme are read. Groups without rows are left out.
    """
    keys = require_columns(states, keys)
    types = {f.name: f.dataType for f in states.schema.fields}
    match = match_parts({k: column(k) for k in keys}, types, "__key")
    named = [c.alias(n) for n, c in match.items()]
    changed = changed_states(states, trip_states(images, keys, scale), keys)
    fine = [column(k) for k in keys] + _state_columns(states)
    stale = changed.filter("stale").select(*named)
    again = trip_states(current.select("*", *named).join(stale, list(match), "left_semi").drop(*match), keys, scale)
    kept = states.select(*fine, *named).join(changed.select(*named), list(match), "left_anti").drop(*match)
    settled = changed.filter(~F.col("stale") & (F.col(ROWS) > 0)).select(*fine)
    return kept.unionByName(settled).unionByName(again.select(*fine))
