"""Roll-ups and maintained states against direct aggregates, late changes against a plain timeline."""

import random
from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from queries import rollups
from stratalake.operators.aggregate import monthly_aggregate
from stratalake.operators.rollup import SIGN, changed_states, maintained_states, place_bitmaps, roll_up, states_to_monthly, trip_states, upsert_images
from stratalake.operators.scd_late import apply_changes
from stratalake.operators.upsert import upsert

SF_DIR = "/root/testdata/sf0.001"
DDL = "id int, pickup_datetime timestamp_ntz, pulocationid bigint, dolocationid bigint, trip_distance double, total_amount double, service_type string, provider string, ano_mes string"
KEYS = ["ano_mes", "service_type", "provider", "pulocationid", "dolocationid"]


def some_trips(n, seed):
    r = random.Random(seed)
    month = lambda: r.choice(["202301", "202302", None])
    place = lambda: r.choice([None, 1, 5, 32_767, 32_768, 100_000, -3])
    value = lambda: r.choice([None, 0.0, 1.25, -7.5, 1e18, 33.33])
    return [
        (i, datetime(2023, 1, r.randint(1, 28), r.randint(0, 23)) if r.random() > 0.1 else None, place(), place(), value(), value(), r.choice(["a", "b"]), r.choice(["p", None]), month())
        for i in range(n)
    ]


@pytest.mark.parametrize("keys", [["ano_mes", "service_type"], ["provider"], ["ano_mes", "pulocationid"], []])
def test_roll_up_equals_the_aggregate(spark, keys):
    trips = spark.createDataFrame(some_trips(600, 1), DDL)
    states = trip_states(trips, KEYS)
    bitmaps = place_bitmaps(states, [k for k in KEYS if k != "dolocationid"])
    got, want = roll_up(states, bitmaps, keys), monthly_aggregate(trips, keys, scale=2)
    assert got.columns == want.columns and rows(got) == rows(want)
    # Bitmaps of the trips themselves say the same.
    assert rows(roll_up(states, place_bitmaps(trips, KEYS[:4]), keys)) == rows(want)


def test_states_of_all_keys_are_the_monthly_aggregate(spark):
    trips = spark.createDataFrame(some_trips(300, 2), DDL)
    assert rows(states_to_monthly(trip_states(trips))) == rows(monthly_aggregate(trips, scale=2))
    none = trips.filter("id < 0")
    assert roll_up(trip_states(none), place_bitmaps(none, KEYS), ["ano_mes"]).count() == 0
    with pytest.raises(AnalysisException):
        states_to_monthly(trip_states(trips, ["ano_mes"]), ["ano_mes"])


def test_roll_up_reads_no_trips(spark):
    text = plan(rollups.gold_by_month_from_monthly(spark, SF_DIR))
    assert "Expand" not in text and "trip_distance" not in text and "l_shipdate" not in text
    assert "states-" in text and "bitmaps-" in text


@pytest.mark.parametrize("seed", range(4))
def test_states_follow_upserts(spark, seed):
    """Two upserts one after the other, each taken in by its images, give the states of a full rebuild."""
    target = spark.createDataFrame(some_trips(200, seed), DDL)
    states = trip_states(target)
    for step in (1, 2):
        again = [(r[0] + 90, *r[1:]) for r in some_trips(150, 100 * seed + step)]
        source = spark.createDataFrame(again, DDL)
        images = upsert_images(target, source, ["id"])
        target = spark.createDataFrame(upsert(target, source, ["id"], source_unique=True).collect(), DDL)
        new = maintained_states(states, images, target)
        own = [c for c in new.columns]
        assert rows(new) == rows(trip_states(target).select(*own))
        states = spark.createDataFrame(new.collect(), new.schema)


def test_only_groups_that_lost_an_extreme_are_stale(spark):
    base = [(1, datetime(2023, 1, 2), 1, 1, 5.0, 9.0, "a", "p", "m"), (2, datetime(2023, 1, 3), 1, 1, 7.0, 8.0, "a", "p", "m")]
    one = (3, datetime(2023, 1, 1), 2, 1, 1.0, 1.0, "a", "p", "m")
    states = trip_states(spark.createDataFrame([*base, one], DDL))

    def stale(*signed):
        changes = spark.createDataFrame([(*r, s) for r, s in signed], f"{DDL}, {SIGN} int")
        return rows(changed_states(states, trip_states(changes)).select("pulocationid", "n_rows", "stale"))

    inside = (4, datetime(2023, 1, 2, 5), 1, 1, 6.0, 8.5, "a", "p", "m")
    assert stale((inside, 1)) == [(1, 3, False)]
    assert stale((base[1], -1)) == [(1, 1, True)]
    greater = (2, datetime(2023, 1, 3), 1, 1, 70.0, 9.0, "a", "p", "m")
    assert stale((base[1], -1), (greater, 1)) == [(1, 2, False)]  # the last pickup is there again
    earlier = (2, datetime(2023, 1, 2, 9), 1, 1, 70.0, 9.5, "a", "p", "m")
    assert stale((base[1], -1), (earlier, 1)) == [(1, 2, True)]
    assert stale((one, -1)) == [(2, 0, False)]  # an empty group needs no trips


HISTORY = "k int, v string, w int, data_inicio date, data_fim date, registro_ativo int"
OPEN = date(2400, 12, 31)


def plain_timeline(history, changes):
    """Per key: what begins at each date, neighbours merged."""
    points = {}
    for k, v, w, start, end, _ in history:
        points.setdefault(k, {}).setdefault(start, []).append((1, 0, v, w))
        if end < OPEN:
            points[k].setdefault(end, []).append((0, 0, None, None))
    for k, v, w, day, seq in changes:
        if day is not None:
            points.setdefault(k, {}).setdefault(day, []).append((2, seq, v, w))
    out = []
    for k, dates in points.items():
        line = []
        for day in sorted(dates):
            kind, _, v, w = max(dates[day], key=lambda p: (p[0], p[1], p[2] is not None, p[2] or "", p[3] or 0))
            gap = kind == 0
            if (gap and not line) or (line and line[-1][1] == gap and (gap or line[-1][2] == v)):
                continue
            line.append((day, gap, v, w))
        for i, (day, gap, v, w) in enumerate(line):
            if not gap:
                last = i + 1 == len(line)
                out.append((k, v, w, day, OPEN if last else line[i + 1][0], int(last)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_late_changes_are_the_plain_timeline(spark, seed):
    r = random.Random(seed)
    day = lambda: date(2020, r.randint(1, 4), r.randint(1, 9))
    history = []
    for k in [None, 1, 2, 3]:
        dates = sorted({day() for _ in range(r.randint(1, 4))})
        for a, b in zip(dates, [*dates[1:], None]):
            if r.random() < 0.8:
                history.append((k, r.choice("xyz"), r.randint(0, 9), a, OPEN if b is None else b, int(b is None)))
    changes = [(r.choice([None, 1, 2, 3, 4]), r.choice(["x", "y", None]), r.randint(0, 9), day() if r.random() > 0.1 else None, i) for i in range(12)]
    h = spark.createDataFrame(history, HISTORY).repartition(3)
    c = spark.createDataFrame(changes, "k int, v string, w int, day date, seq int")
    once = apply_changes(h, c, ["k"], ["v"], "day", order_by=["seq"])
    assert rows(once) == plain_timeline(history, changes)
    again = apply_changes(spark.createDataFrame(once.collect(), HISTORY), c, ["k"], ["v"], "day", order_by=["seq"])
    assert rows(again.drop("w")) == rows(once.drop("w"))


def test_late_changes_read_history_once_and_need_its_columns(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame([(1, "x", 1, date(2020, 1, 1), OPEN, 1)], HISTORY).write.parquet(path)
    h = spark.read.parquet(path)
    c = spark.createDataFrame([(1, "y", 1, date(2019, 1, 1))], "k int, v string, w int, data_inicio date")
    out = apply_changes(h, c, ["k"], ["v"], "data_inicio")
    assert plan(out).count("FileScan") == 1 and "WindowGroupLimit" in plan(out)
    assert rows(out) == [(1, "x", 1, date(2020, 1, 1), OPEN, 1), (1, "y", 1, date(2019, 1, 1), date(2020, 1, 1), 0)]
    with pytest.raises(AnalysisException):
        apply_changes(h, c.drop("w"), ["k"], ["v"], "data_inicio")
    assert apply_changes(h.filter("k = 0"), c.filter("k = 0"), ["k"], ["v"], "data_inicio").count() == 0
