"""The merges, case by case and as properties."""

import datetime as dt

import pytest
from conftest import T0, T1, T2
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratamart.operators import (
    DuplicateKeyError,
    assert_unique,
    duplicate_keys,
    insert_absent,
    latest_per_key,
    merge_soft_delete,
    merge_upsert,
)

TARGET = (
    "k int, v string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "is_deleted boolean, deleted_at timestamp_ntz"
)
ROWS = [
    (1, "a", T0, T0, False, None),
    (2, "b", T0, T0, False, None),
    (3, "c", T0, T1, True, T1),
    (4, "d", T0, T1, True, T1),
    (6, "f", T0, T0, False, None),
]


def test_all_cases(spark, rows):
    target = spark.createDataFrame(ROWS, TARGET)
    source = spark.createDataFrame([(1, "A"), (4, "D"), (5, "E"), (6, "Sin Dato")], "k int, v string")
    merged = merge_soft_delete(target, source, ["k"], ["v"], T2)
    assert merged.schema.simpleString() == target.schema.simpleString()
    assert rows(merged) == [
        (1, "A", T0, T2, False, None),
        (2, "b", T0, T2, True, T2),
        (3, "c", T0, T1, True, T1),
        (4, "D", T0, T2, False, None),
        (5, "E", T2, T2, False, None),
        (6, "Sin Dato", T0, T2, False, None),
    ]


def test_null_attributes_of_the_source_win(spark, rows):
    target = spark.createDataFrame(ROWS[:1], TARGET)
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(merge_soft_delete(target, source, ["k"], ["v"], T2)) == [(1, None, T0, T2, False, None)]


def test_empty_sides(spark, rows):
    target = spark.createDataFrame(ROWS, TARGET)
    source = target.select("k", "v")
    gone = rows(merge_soft_delete(target, source.where("false"), ["k"], ["v"], T2))
    assert [r[4] for r in gone] == [True] * 5
    assert [r[5] for r in gone] == [T2, T2, T1, T1, T2]
    fresh = rows(merge_soft_delete(target.where("false"), source, ["k"], ["v"], T2))
    assert [r[2:] for r in fresh] == [(T2, T2, False, None)] * 5


def test_composite_key(spark, rows):
    schema = TARGET.replace("k int", "k int, place string")
    target = spark.createDataFrame(
        [(1, "x", "a", T0, T0, False, None), (1, "y", "b", T0, T0, False, None)], schema
    )
    source = spark.createDataFrame([(1, "y", "B"), (2, "x", "C")], "k int, place string, v string")
    assert rows(merge_soft_delete(target, source, ["k", "place"], ["v"], T2)) == [
        (1, "x", "a", T0, T2, True, T2),
        (1, "y", "B", T0, T2, False, None),
        (2, "x", "C", T2, T2, False, None),
    ]


_keys = st.sets(st.integers(0, 12))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=_keys, deleted=_keys, source=_keys)
def test_counts_are_conserved_and_a_repeat_only_touches(spark, target, deleted, source):
    old = spark.createDataFrame(
        [(k, "t", T0, T0, k in deleted, T0 if k in deleted else None) for k in sorted(target)], TARGET
    )
    new = spark.createDataFrame([(k, "s") for k in sorted(source)], "k int, v string")
    once = {r.k: r for r in merge_soft_delete(old, new, ["k"], ["v"], T1).collect()}
    assert set(once) == target | source
    assert {k for k, r in once.items() if not r.is_deleted} == source
    merged = merge_soft_delete(old, new, ["k"], ["v"], T1)
    twice = {r.k: r for r in merge_soft_delete(merged, new, ["k"], ["v"], T2).collect()}
    for k, row in once.items():
        expected = row.asDict() | ({"updated_at": T2} if k in source else {})
        assert twice[k].asDict() == expected


UPSERT = "sk bigint, k int, v string, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_upsert_keeps_keys_and_never_deletes(spark, rows):
    target = spark.createDataFrame([(7, 1, "a", T0, T0), (9, 2, "b", T0, T1)], UPSERT)
    source = spark.createDataFrame([(5, "E"), (1, "A"), (3, None)], "k int, v string")
    merged = merge_upsert(target, source, ["k"], ["v"], T2, "sk")
    assert rows(merged) == [
        (10, 3, None, T2, T2),
        (11, 5, "E", T2, T2),
        (7, 1, "A", T0, T2),
        (9, 2, "b", T0, T1),
    ]
    again = merge_upsert(merged, source, ["k"], ["v"], T2 + dt.timedelta(days=1), "sk")
    assert {r.k: r.sk for r in again.collect()} == {1: 7, 2: 9, 3: 10, 5: 11}


def test_first_upsert(spark, rows):
    target = spark.createDataFrame([], UPSERT)
    source = spark.createDataFrame([(5, "E"), (1, "A")], "k int, v string")
    assert rows(merge_upsert(target, source, ["k"], ["v"], T2, "sk")) == [
        (1, 1, "A", T2, T2),
        (2, 5, "E", T2, T2),
    ]
    assert rows(merge_upsert(target, source.where("false"), ["k"], ["v"], T2, "sk")) == []


def test_insert_absent(spark, rows):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    assert rows(insert_absent(target, source, ["k"])) == [(1, "old"), (2, "new")]


def test_duplicates_are_refused(spark, rows):
    df = spark.createDataFrame([(7, "X"), (7, "Y"), (8, "Z")], "k int, v string")
    with pytest.raises(DuplicateKeyError, match="2 rows with k=7"):
        assert_unique(df, ["k"])
    assert_unique(df, ["k", "v"])
    assert rows(duplicate_keys(df, ["k"])) == [(7, 2)]


def test_latest_per_key_is_an_aggregate(spark, rows):
    df = spark.createDataFrame(
        [(1, T0, "a"), (1, T2, "b"), (1, T2, "c"), (2, None, "d"), (3, T1, None)],
        "k int, at timestamp_ntz, v string",
    )
    best = latest_per_key(df, ["k"], ["at"])
    assert best.columns == df.columns
    assert rows(best) == [(1, T2, "c"), (2, None, "d"), (3, T1, None)]
    assert "Window" not in best._jdf.queryExecution().executedPlan().toString()
