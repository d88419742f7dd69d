"""Rows that cannot be loaded: kept with their reasons, counted, and named when a rule is broken."""

import pytest
from conftest import T0, T1

from stratamart.operators import assert_measures, check_constraints, constraint_measures, key_problems, sort_out
from stratamart.operators.checks import EXAMPLES, ConstraintError
from stratamart.operators.conform import REASONS, REJECTED
from stratamart.plans.jobs import load_balance, reject_report, rejected_rows, stage_entity
from stratamart.sources import Warehouse, land
from stratamart.specs import STAGING, TRANSFORMATION, EntitySpec, decimal, integer, text

LINES = EntitySpec(
    "lines", "raw_lines", "stg_lines", ("order", "line"),
    (integer("order", source="pedido"), integer("line", source="linea"), text("note", 5, "none", source="nota"),
     decimal("price", 9, 2, 0, source="precio")),
)
ROWS = [
    ("1", "1", "a", "2,5"),
    ("1", "2", None, None),
    (None, "1", "b", "1"),
    ("2", " ", "c", "1"),
    ("x", "-1", "d", "no number"),
    ("", None, "e", None),
]
RAW = "pedido string, linea string, nota string, precio string"


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(warehouse, spark.createDataFrame(ROWS, RAW), LINES.source, T0)
    return warehouse


def test_every_row_is_sorted_out_once(spark):
    out = sort_out(spark.createDataFrame(ROWS, RAW), LINES)
    good = out.where(~out[REJECTED]).select("order", "line", "note", "price").collect()
    assert sorted((r.order, r.line, r.note, str(r.price)) for r in good) == [(1, 1, "a", "2.50"), (1, 2, "none", "0.00")]
    bad = {tuple(r.raw_row): r[REASONS] for r in out.where(REJECTED).collect()}
    assert bad == {
        ROWS[2]: ["pedido missing"],
        ROWS[3]: ["linea missing"],
        ROWS[4]: ["pedido not a whole number", "linea not a whole number"],  # and its price is not looked at
        ROWS[5]: ["pedido missing", "linea missing"],
    }
    assert spark.createDataFrame(ROWS, RAW).select(key_problems(LINES)).first()[0] == []


def test_landed_is_staged_or_rejected(wh, rows):
    stage_entity(wh, LINES, T0)
    assert [tuple(r) for r in load_balance(wh, [LINES]).collect()] == [("stg_lines", 6, 2, 4)]
    assert rows(reject_report(wh, [LINES])) == [
        ("stg_lines", "linea missing", 2),
        ("stg_lines", "linea not a whole number", 1),
        ("stg_lines", "pedido missing", 2),
        ("stg_lines", "pedido not a whole number", 1),
    ]
    kept = rejected_rows(wh, LINES)
    assert kept.columns == ["pedido", "linea", "nota", "precio", "created_at", "reasons"]
    assert {r.nota for r in kept.collect()} == {"b", "c", "d", "e"}


def test_rejects_are_read_by_themselves(wh):
    stage_entity(wh, LINES, T0)
    plan = rejected_rows(wh, LINES)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan
    files = wh.read(TRANSFORMATION, "stg_lines").where("NOT rejected").inputFiles()
    assert files and all("rejected=" in f for f in files)


def test_the_next_run_starts_over(spark, wh):
    stage_entity(wh, LINES, T0)
    land(wh, spark.createDataFrame(ROWS[:2], RAW), LINES.source, T1)
    stage_entity(wh, LINES, T1)
    assert rejected_rows(wh, LINES).isEmpty()
    assert [tuple(r) for r in load_balance(wh, [LINES]).collect()] == [("stg_lines", 2, 2, 0)]


def test_repeated_keys_that_are_resolved_are_accounted_for(spark, wh):
    land(wh, spark.createDataFrame([*ROWS, ("1", "1", "z", "3")], RAW), LINES.source, T1)
    stage_entity(wh, LINES, T1, dedupe=("note",))
    assert {r.note for r in wh.read(STAGING, "stg_lines").collect()} == {"z", "none"}
    assert [tuple(r) for r in load_balance(wh, [LINES]).collect()] == [("stg_lines", 7, 2, 4)]


def test_a_failed_load_keeps_its_rejects(spark, wh):
    stage_entity(wh, LINES, T0)
    land(wh, spark.createDataFrame([("1", "1", "far too long", "1"), ("y", "1", "", "")], RAW), LINES.source, T1)
    with pytest.raises(ConstraintError, match=r"note max_length_5: 1 rows, such as 1, 1"):
        stage_entity(wh, LINES, T1)
    assert [r.pedido for r in rejected_rows(wh, LINES).collect()] == ["y"]
    assert wh.count(STAGING, "stg_lines") == 2  # as after the first run


def test_examples_are_bounded_and_hold_the_least(spark):
    df = spark.range(5000).selectExpr("id", "IF(id >= 700, NULL, 'x') AS a", "repeat('y', cast(id % 40 AS int)) AS b")
    schema = df.select("a").schema
    schema["a"].nullable = False
    found = {r.rule: r for r in check_constraints(df, schema, {"b": 39, "a": 9}, ("id",)).collect()}
    assert found["not_null"].violations == 4300 and len(found["not_null"].examples) == EXAMPLES
    assert min(found["not_null"].examples) == min(str(i) for i in range(700, 5000))
    assert found["max_length_39"].violations == found["max_length_9"].violations == 0
    assert found["max_length_9"].examples == []
    measures = constraint_measures(schema, {"b": 38}, ("id",))
    row = df.agg(*[c.alias(n) for n, c in measures.items()]).first().asDict()
    with pytest.raises(ConstraintError, match=r"a not_null: 4300 rows, such as 1000;.*; b max_length_38: 125 rows, such as 10"):
        assert_measures(row, measures, "t")
    with pytest.raises(ConstraintError, match="a not_null: 1 rows$"):
        assert_measures({"a not_null": 1}, constraint_measures(schema), "t")
