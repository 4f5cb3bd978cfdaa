from datetime import date

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException

from stratalake.operators.scd import apply_scd2
from stratalake.operators.upsert import upsert

CALM = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEY = st.sampled_from(["a", "b", "c", None])
VALUE = st.sampled_from([1, 2, None])
TABLE = st.dictionaries(KEY, VALUE, max_size=4)
KV = "k string, v int"


def kv(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), KV)


@CALM
@given(TABLE, TABLE)
def test_upsert_is_a_dictionary_update(spark, target, source):
    out = upsert(kv(spark, target), kv(spark, source), ["k"])
    assert rows(out) == sorted({**target, **source}.items(), key=repr)
    assert rows(upsert(out, kv(spark, source), ["k"])) == rows(out)


def test_upsert_reduces_repeated_source_keys(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("z", 9, "t")], "k string, o int, p string")
    source = spark.createDataFrame([("x", 3, "a"), ("y", 2, "a"), ("n", 1, "b")], "p string, o int, k string")
    assert rows(upsert(target, source, ["k"], order_by=["o"])) == [("a", 3, "x"), ("b", 1, "n"), ("z", 9, "t")]
    assert upsert(target, source, ["k"], source_unique=True).count() == 4


def test_upsert_needs_all_columns_and_takes_target_types(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v bigint")
    out = upsert(target, spark.createDataFrame([("b", 2, 0)], "K string, V int, extra int"), ["k"])
    assert out.schema == target.schema and rows(out) == [("a", 1), ("b", 2)]
    with pytest.raises(AnalysisException):
        upsert(target, spark.createDataFrame([("b",)], "k string"), ["k"])


HISTORY = "k string, v int, data_inicio date, data_fim date, registro_ativo int"
START, TODAY, OPEN = date(2024, 1, 1), date(2024, 3, 1), date(2400, 12, 31)


def history(spark, mapping, extra=()):
    data = [(k, v, START, OPEN, 1) for k, v in mapping.items()] + list(extra)
    return spark.createDataFrame(data, HISTORY)


def expected(history_rows, snapshot, null_safe=True, keep_unchanged=True):
    """Brute force, row by row."""
    def same(a, b):
        return a == b if null_safe else a is not None and b is not None and a == b

    def differ(a, b):
        return a != b if null_safe else a is not None and b is not None and a != b

    out = [r for r in history_rows if r[4] == 0]
    for k, v, begin, end, flag in (r for r in history_rows if r[4] == 1):
        hits = [w for key, w in snapshot.items() if same(key, k)]
        if hits and differ(hits[0], v):
            out.append((k, v, begin, TODAY, 0))
        elif keep_unchanged:
            out.append((k, v, begin, end, flag))
    for k, v in snapshot.items():
        hits = [r for r in history_rows if r[4] == 1 and same(r[0], k)]
        if not hits or differ(hits[0][1], v):
            out.append((k, v, TODAY, OPEN, 1))
    return sorted(out, key=repr)


@CALM
@given(TABLE, TABLE, st.booleans(), st.booleans())
def test_scd2_matches_brute_force(spark, old, new, null_safe, keep_unchanged):
    past = [("a", 7, date(2023, 1, 1), START, 0), (None, 8, date(2023, 1, 1), START, 0)]
    h = history(spark, old, past)
    out = apply_scd2(
        h, kv(spark, new), ["k"], ["v"], "2024-03-01", null_safe=null_safe, keep_unchanged=keep_unchanged
    )
    assert rows(out) == expected([tuple(r) for r in h.collect()], new, null_safe, keep_unchanged)
    assert out.schema.simpleString() == h.schema.simpleString()


@CALM
@given(TABLE, TABLE)
def test_scd2_twice_on_a_day_changes_nothing(spark, old, new):
    once = apply_scd2(history(spark, old), kv(spark, new), ["k"], ["v"], "2024-03-01")
    twice = apply_scd2(once, kv(spark, new), ["k"], ["v"], "2024-03-01")
    assert rows(twice) == rows(once)
    active = [r for r in once.collect() if r.registro_ativo == 1]
    assert len({r.k for r in active}) == len(active)


def test_scd2_names_types_and_repeats(spark):
    h = spark.createDataFrame(
        [("a", 1, "n1", 5.0, "2020-01-01", "9999-12-31", True)],
        "k1 string, k2 int, name string, note double, since string, until string, live boolean",
    )
    h = h.selectExpr("k1", "k2", "name", "note", "cast(since as date) since", "cast(until as date) until", "cast(live as int) live")
    s = spark.createDataFrame([(9.0, "n3", 1, "a"), (8.0, "n2", 1, "a"), (7.0, "x", 2, "a")], "note double, name string, k2 int, k1 string")
    out = apply_scd2(
        h, s, ["k1", "k2"], ["name"], TODAY, "since", "until", "live", "9999-12-31", order_by=["note"],
    )
    assert rows(out) == sorted(
        [
            ("a", 1, "n1", 5.0, date(2020, 1, 1), TODAY, 0),
            ("a", 1, "n3", 9.0, TODAY, date(9999, 12, 31), 1),
            ("a", 2, "x", 7.0, TODAY, date(9999, 12, 31), 1),
        ],
        key=repr,
    )


def test_scd2_compares_floats_as_numbers(spark):
    nan = float("nan")
    ddl = HISTORY.replace("v int", "v double")
    h = spark.createDataFrame([(k, v, START, OPEN, 1) for k, v in (("a", 0.0), ("b", nan), ("c", 0.3 - 0.2), ("d", None))], ddl)
    s = spark.createDataFrame([("a", -0.0), ("b", nan), ("c", 0.3 - 0.2), ("d", None)], "k string, v double")
    assert apply_scd2(h, s, ["k"], ["v"], TODAY).filter(f"data_inicio = date'{TODAY}' or registro_ativo = 0").count() == 0
    moved = spark.createDataFrame([("a", 1e-300), ("b", 0.0), ("c", None), ("d", nan)], "k string, v double")
    assert apply_scd2(h, moved, ["k"], ["v"], TODAY).filter("registro_ativo = 0").count() == 4


@pytest.mark.parametrize("kind, a, b", [("date", START, TODAY), ("boolean", True, False), ("array<int>", [1], [1, None])])
def test_scd2_keys_of_other_types(spark, kind, a, b):
    h = spark.createDataFrame([(a, 1, START, OPEN, 1), (None, 2, START, OPEN, 1)], HISTORY.replace("k string", f"k {kind}"))
    s = spark.createDataFrame([(a, 1), (b, 1), (None, 3)], f"k {kind}, v int")
    out = apply_scd2(h, s, ["k"], ["v"], TODAY)
    assert rows(out.select("v", "registro_ativo")) == [(1, 1), (1, 1), (2, 0), (3, 1)]


def test_scd2_checks_columns(spark):
    h = history(spark, {"a": 1})
    with pytest.raises(AnalysisException):
        apply_scd2(h, kv(spark, {"a": 1}), ["k"], ["w"])
    with pytest.raises(AnalysisException):
        apply_scd2(h, spark.createDataFrame([("a", 1, 2)], "k string, v int, more int"), ["k"], ["v"])
    today = apply_scd2(h, kv(spark, {"a": 2}), ["k"], ["v"]).filter("registro_ativo = 1").first()
    assert (date.today() - today.data_inicio).days in (-1, 0, 1)


def test_joins_are_hash_or_merge_joins(spark):
    old, new = history(spark, {"a": 1}), kv(spark, {"a": 2})
    for df in (apply_scd2(old, new, ["k"], ["v"]), apply_scd2(old, new, ["k"], ["v"], null_safe=False), upsert(new, new, ["k"])):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
