"""Surrogate keys, calendar, lookups and reports about them."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import T0
from pyspark.sql import functions as F

from stratamart.operators import star
from stratamart.operators import (
    active_deleted_summary,
    assert_measures,
    assign_surrogate_keys,
    check_constraints,
    constraint_measures,
    date_dimension,
    date_dimension_for,
    find_duplicates,
    latest_deleted,
    lookup_keys,
    orphaned_keys,
    unmatched_report,
)
from stratamart.operators.star import _hot_keys
from stratamart.operators.checks import ConstraintError
from stratamart.specs import DimLookup, EntitySpec, SummaryLabels, integer, text


def test_keys_are_dense_in_key_order_however_skewed(spark):
    # A third of the rows share their first key column, and the values are far from evenly spread.
    df = spark.sql("""
        SELECT CASE WHEN id % 3 = 0 THEN 5 WHEN id % 3 = 1 THEN id ELSE id * 1000000000 END AS a,
               cast(id AS string) AS b FROM range(30000)""")
    rows = assign_surrogate_keys(df, ["a", "b"], 1000).orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1001, 31001))
    assert [(r.a, r.b) for r in rows] == sorted((r.a, r.b) for r in rows)


def test_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, v string")
    numbered = assign_surrogate_keys(empty, ["k"], 5, "sk_x")
    assert numbered.columns == ["k", "v", "sk_x"] and numbered.isEmpty()


def test_calendar(spark):
    days = {r.fecha: r for r in date_dimension(spark, "2015-01-01", "2025-12-31").collect()}
    assert len(days) == 4018
    day = days[dt.date(2020, 2, 29)]
    assert (day.anio, day.mes, day.dia, day.trimestre, day.semana) == (2020, 2, 29, 1, 9)
    assert (day.dia_nombre, day.mes_nombre, day.es_fin_semana) == ("Saturday", "February", True)
    assert days[dt.date(2021, 1, 3)].semana == 53  # ISO weeks
    assert not days[dt.date(2024, 5, 6)].es_fin_semana


def test_calendar_for_data(spark):
    df = spark.sql("SELECT explode(array(date'2024-02-27', date'2024-03-02')) AS d")
    assert date_dimension_for(df, df.d, df.d).count() == 5
    assert date_dimension_for(df.where("false"), df.d, df.d).count() == 0


LOOKUP = DimLookup("dim", (("id_a", "id_a"), ("place", "place")), "sk_a", "sk_a")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_shuffled_lookup_equals_plain_join(spark, rows, how, hot_rows):
    """One key holds a third of the rows and another third has none."""
    facts = spark.sql("""
        SELECT id, CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id % 50 END AS id_a,
               CASE WHEN id % 7 = 0 THEN NULL ELSE 'p' END AS place FROM range(3000)""")
    dim = spark.sql("SELECT id AS id_a, 'p' AS place, id * 10 AS sk_a, 'x' AS extra FROM range(40)")
    lookup = DimLookup(**(LOOKUP.__dict__ | {"how": how, "carry": ("extra",)}))
    args = (facts, {"dim": dim}, [lookup], "id", hot_rows)
    plain = lookup_keys(*args, max_broadcast=10**12)
    spread = lookup_keys(*args, max_broadcast=-1)
    assert spread.columns == plain.columns == ["id", "id_a", "place", "sk_a", "extra"]
    assert rows(spread) == rows(plain)
    assert plain.count() == (3000 if how == "left" else plain.where("sk_a IS NOT NULL").count())


def test_hot_rows_are_spread_over_tasks(spark):
    facts = spark.sql("SELECT id, IF(id % 3 = 0, 1, id) AS id_a FROM range(9000)")
    dim = spark.sql("SELECT id AS id_a, id AS sk_a FROM range(9000)")
    lookup = DimLookup("dim", (("id_a", "id_a"),), "sk_a", "sk_a")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_keys(facts, {"dim": dim}, [lookup], "id", hot_rows=100)
        sizes = [len(p) for p in joined.select("id").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 9000
    assert max(sizes) < 2 * 9000 / len(sizes)


def test_every_hot_key_is_spread(spark):
    """More hot keys than any fixed list would hold, and salts as the rows of each key need."""
    facts = spark.sql("SELECT id, IF(id % 10 = 0, id % 1500, 7777) AS k FROM range(60000)")
    found = {r.hash: r.salts for r in _hot_keys(facts, {0: ["k"]}, 30).collect()}
    assert len(found) == 151 and found.pop(_hash_of(spark, 7777)) == 1800
    assert set(found.values()) == {2}
    many = spark.sql("SELECT id, id % 1500 AS k FROM range(60000)")
    assert _hot_keys(many, {0: ["k"]}, 30).count() == 1500
    assert _hot_keys(many, {0: ["k"]}, 40).isEmpty()


def _hash_of(spark, *values):
    return spark.range(1).select(F.xxhash64(*[F.lit(v).cast("bigint") for v in values])).first()[0]


@pytest.mark.parametrize("seed", range(3))
def test_no_hot_key_is_missed(spark, seed, monkeypatch):
    """Against exact counts, with sketches far smaller than the number of keys."""
    monkeypatch.setattr(star, "_MOST_HOT_KEYS", 16)
    monkeypatch.setattr(star, "_TRACKED", 6 * 16)
    monkeypatch.setattr(star, "_LISTED", 2 * 16)
    facts = spark.sql(f"""
        SELECT id, IF(rand({seed}) < 0.6, cast(pow(rand({seed + 10}), 4) * 40 AS bigint), id) AS a,
               IF(rand({seed + 20}) < 0.5, id % 9, cast(id / 3 AS bigint)) AS b,
               IF(id % 5 = 0, NULL, 'k' || id % 6) AS c FROM range(40000)""").checkpoint()
    keys = {0: ["a"], 1: ["b"], 2: ["a", "c"], 4: ["c"]}
    listed = {}
    for r in _hot_keys(facts, keys, 100).collect():
        listed.setdefault(r.lookup, {})[r.hash] = r.salts
    for i, columns in keys.items():
        present = facts.select(*columns).dropna()
        share = max(100, -(-present.count() // 16))
        counts = present.groupBy(F.xxhash64(*columns).alias("hash")).count().where(F.col("count") > share).collect()
        got = listed.get(i, {})
        assert {r["hash"] for r in counts} <= got.keys()
        assert all(r["count"] <= got[r["hash"]] * share for r in counts) and len(got) < 32


def test_keys_of_other_types_are_spread_alike(spark, rows):
    facts = spark.sql("SELECT id, cast(IF(id % 2 = 0, 1, id) AS int) AS id_a, IF(id % 3 = 0, 'p', 'q') AS place FROM range(400)")
    dim = spark.sql("SELECT id * IF(id > 300, 10000000000, 1) AS id_a, p AS place, id * 10 AS sk_a FROM range(400), (VALUES ('p'), ('q')) AS v(p)")
    args = (facts, {"dim": dim}, [LOOKUP], "id", 10)
    assert rows(lookup_keys(*args, max_broadcast=-1)) == rows(lookup_keys(*args, max_broadcast=10**12))


def test_largest_task_of_a_hot_key_shrinks_with_its_share(spark):
    """A key with nine rows in ten: the more tasks there are, the fewer of its rows each gets."""
    facts = spark.sql("SELECT id, IF(id % 10 = 0, id, 1) AS id_a FROM range(20000)")
    dim = spark.sql("SELECT id AS id_a, id AS sk_a FROM range(20000)")
    lookup = DimLookup("dim", (("id_a", "id_a"),), "sk_a", "sk_a")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        largest = []
        for share in (20_000, 5_000, 100):
            joined = lookup_keys(facts, {"dim": dim}, [lookup], "id", hot_rows=share, max_broadcast=0)
            largest.append(max(len(p) for p in joined.select("id").rdd.glom().collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert largest[0] > 18_000 > 12_000 > largest[1] and largest[2] < 1_500


def test_unmatched_and_orphans(spark, rows):
    facts = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "id int, id_a int")
    dim = spark.createDataFrame([(1, 100)], "id_a int, sk_a bigint")
    lookup = DimLookup("dim", (("id_a", "id_a"),), "sk_a", "sk_role")
    assert rows(unmatched_report(facts, {"dim": dim}, [lookup], "id")) == [("dim", "sk_role", 1, 1)]
    assert rows(orphaned_keys(facts, "id_a", dim, "id_a")) == [(9, 1)]


def test_constraints(spark, rows):
    spec = EntitySpec("t", "r", "s", ("k",), (integer("k"), text("v", 3), integer("n", nullable=False)))
    schema = spec.schema()
    df = spark.createDataFrame(
        [(1, "abc  ", 1, T0, T0, False, None), (2, "abcd", None, T0, T0, False, None)],
        "k int, v string, n int, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "is_deleted boolean, deleted_at timestamp_ntz",
    )
    broken = rows(check_constraints(df, schema, {"v": 3}).where("violations > 0"))
    assert broken == [("n", "not_null", 1), ("v", "max_length_3", 1)]
    measures = constraint_measures(schema, {"v": 3})
    measured = df.agg(*[c.alias(n) for n, c in measures.items()]).first().asDict()
    with pytest.raises(ConstraintError, match="n not_null: 1 rows; v max_length_3: 1 rows"):
        assert_measures(measured, measures, "t")


def test_duplicates_listing(spark, rows):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (2, "x"), (3, None), (3, "z")], "k int, place string"
    )
    found = find_duplicates(df, ["k"], "place", "places")
    assert [tuple(r) for r in found.collect()] == [(1, 3, "a, b"), (3, 2, "z")]


def test_duplicates_listing_of_nulls(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (None, "b"), (2, "x")], "k int, place string")
    assert rows(find_duplicates(df, ["k"], "place", "places")) == [(1, 2, None), (None, 2, "a, b")]


def test_summary_of_an_empty_table(spark):
    df = spark.createDataFrame([], "m decimal(15,2), is_deleted boolean")
    lines = active_deleted_summary(df, SummaryLabels("b live", "a gone"), "m").collect()
    assert [tuple(r) for r in lines] == [("b live", 0, None), ("a gone", 0, Decimal(0))]


def test_latest_deleted(spark):
    df = spark.range(30).selectExpr(
        "id", "id % 2 = 0 AS is_deleted",
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id AS int)) AS deleted_at",
        "timestamp_ntz'2024-01-01' AS updated_at",
    )
    found = latest_deleted(df, ["id"], [])
    assert [r.id for r in found.collect()] == list(range(28, 8, -2))


def test_values_of_a_giant_key_are_sorted_in_several_tasks(spark):
    df = spark.sql("SELECT IF(id % 3 = 0, 7, id) AS k, IF(id % 3 = 0, 'v' || id, 'w') AS v FROM range(300000)")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge tasks this small
    try:
        (row,) = find_duplicates(df, ["k"], "v", "vs").collect()
        sizes = find_duplicates(df, ["k"], "v", "vs")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = sorted(f"v{i}" for i in range(0, 300000, 3)) + ["w"]
    assert (row.k, row.cantidad, row.vs) == (7, 100001, ", ".join(expected))
    assert "rangepartitioning(k" in sizes and "BroadcastHashJoin" in sizes


def test_numbers_follow_keys_over_many_files(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = assign_surrogate_keys(spark.range(0, 5000, 7).selectExpr("id % 100 AS a", "id AS b"), ["a", "b"], 40)
        rows = sorted((r.a, r.b, r.sk) for r in numbered.collect())
        again = sorted((r.a, r.b, r.sk) for r in numbered.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [sk for _, _, sk in rows] == list(range(41, 41 + 715)) and rows == again
