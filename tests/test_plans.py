"""What Spark does with the plans: no needless shuffles, nothing through one task."""

from dataclasses import replace

import pytest
from conftest import T0, T1
from pyspark.sql.readwriter import DataFrameWriter

from stratamart.operators import (
    assign_surrogate_keys,
    fact_rows,
    merge_soft_delete,
    merge_upsert,
    top_products,
    unmatched_report,
)
from stratamart.operators import star
from stratamart.operators.checks import duplicate_keys
from stratamart.plans import RETAIL, jobs, run_warehouse
from stratamart.plans.jobs import _stored
from stratamart.plans.retail import FACT_VENTAS, VENTAS
from stratamart.session import unsorted_partitions
from stratamart.sources import Warehouse
from stratamart.specs import SERVICE, STAGING
from retail_feeds import write_feeds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    tables = ("stg_ventas", "fact_ventas")
    wh = Warehouse(spark, str(base / "wh"), dict.fromkeys(tables, 4))
    assert run_warehouse(wh, RETAIL, write_feeds(base / "a"), T0, True, True).ok
    return wh


def test_merge_into_a_bucketed_snapshot_shuffles_only_the_source(spark, warehouse):
    target = warehouse.read(STAGING, "stg_ventas")
    source = spark.range(100).selectExpr("cast(id AS int) AS id_venta", "date'2020-01-01' AS fecha")
    merged = merge_soft_delete(target, source, ["id_venta"], ["fecha"], T1)
    assert shuffles(merged) == 1
    assert "SortMergeJoin" in plan(merged)
    assert plan(merged).count("- Sort [") == 1  # sorted buckets: only the source is sorted


def test_key_check_of_a_bucketed_snapshot_shuffles_nothing(warehouse):
    assert shuffles(duplicate_keys(warehouse.read(SERVICE, "fact_ventas"), ["id_venta"])) == 0


def test_fact_load_between_bucketed_tables_shuffles_only_new_keys(warehouse):
    dims = {lk.dimension: warehouse.read(SERVICE, lk.dimension) for lk in FACT_VENTAS.lookups}
    source = fact_rows(warehouse.read(STAGING, "stg_ventas"), dims, FACT_VENTAS)
    assert shuffles(source) == 0  # every dimension is small enough to be broadcast
    target = warehouse.read(SERVICE, "fact_ventas")
    merged = merge_upsert(target, source, ["id_venta"], FACT_VENTAS.columns, T1, "sk_venta")
    # What moves: one count per file of the numbering, and the numbered new keys if there are many of them.
    assert shuffles(merged) <= 2
    assert plan(merged).count("Exchange hashpartitioning(id_venta") <= 1
    assert plan(merged).count("Bucketed: true") == 2


def test_unmatched_report_scans_the_fact_once(warehouse):
    dims = {lk.dimension: warehouse.read(SERVICE, lk.dimension) for lk in FACT_VENTAS.lookups}
    staged = warehouse.read(STAGING, "stg_ventas")
    for max_broadcast in (None, 0):
        report = unmatched_report(staged, dims, FACT_VENTAS.lookups, "id_venta", max_broadcast)
        scans = [line for line in plan(report).splitlines() if "FileScan" in line and "id_empleado" in line and "id_canal" in line]
        assert len(scans) == 1
    assert shuffles(unmatched_report(staged, dims, FACT_VENTAS.lookups, "id_venta")) == 0


def test_large_dimensions_move_the_facts_once_each_and_no_more(spark, warehouse):
    """With no broadcast at all: a shuffle for each lookup, then the stored rows meet the fact in its buckets."""
    dims = {lk.dimension: warehouse.read(SERVICE, lk.dimension) for lk in FACT_VENTAS.lookups}
    source = fact_rows(warehouse.read(STAGING, "stg_ventas"), dims, FACT_VENTAS, max_broadcast=0)
    assert "SortMergeJoin" in plan(source)
    target = warehouse.read(SERVICE, "fact_ventas")
    with _stored(warehouse, source, FACT_VENTAS) as resolved:
        merged = merge_upsert(target, resolved, ["id_venta"], FACT_VENTAS.columns, T1, "sk_venta")
        assert "Exchange hashpartitioning(id_venta" not in plan(merged).replace("Exchange hashpartitioning(id_venta", "", 1)
        assert shuffles(merged) <= 2  # the numbered new keys, and one count per partition of their numbering
        assert plan(merged).count("Bucketed: true") >= 2  # both sides of the merge


def test_hot_keys_of_all_lookups_take_one_scan(warehouse, monkeypatch):
    dims = {lk.dimension: warehouse.read(SERVICE, lk.dimension) for lk in FACT_VENTAS.lookups}
    staged = warehouse.read(STAGING, "stg_ventas")
    asked, find = [], star._hot_keys

    def recorded(facts, keys, hot_rows):
        asked.append((facts, keys))
        return find(facts, keys, hot_rows)

    monkeypatch.setattr(star, "_hot_keys", recorded)
    fact_rows(staged, dims, FACT_VENTAS, max_broadcast=0)
    (facts, keys), = asked  # once, and for all that do not hang on an earlier lookup
    assert len(keys) == sum(any(c in staged.columns for c, _ in lk.on) for lk in FACT_VENTAS.lookups) > 3
    found = plan(star._frequent_keys(facts, keys, 10))
    assert found.count("FileScan") == 1 and shuffles(star._frequent_keys(facts, keys, 10)) == 0


def test_bucketed_snapshots_have_one_file_per_bucket(warehouse):
    wh = warehouse
    for layer, table in ((STAGING, "stg_ventas"), (SERVICE, "fact_ventas")):
        files = wh.read(layer, table).inputFiles()
        assert len(files) <= 4, (table, files)


def test_rows_written_by_a_flag_are_not_sorted_by_it(spark, tmp_path, monkeypatch):
    """Rows are sorted out into two folders; a sort for that would hold an input split as rows in each task."""
    spark.sql(f"CREATE TABLE by_flag (id BIGINT, flag BOOLEAN) USING parquet PARTITIONED BY (flag) LOCATION '{tmp_path}/f'")
    insert, plans, save = "EXPLAIN INSERT INTO by_flag SELECT id, id % 2 = 0 FROM range(10)", [], DataFrameWriter.save

    def explained(*args, **kwargs):
        plans.append(spark.sql(insert).first()[0])
        return save(*args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", explained)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(10).selectExpr("id", "id % 2 = 0 AS flag")
    written = wh.read_snapshot(wh.write(STAGING, "t", rows, partition_by=("flag",)))
    assert len(plans) == 1 and "Sort [" not in plans[0]
    assert "Sort [" in spark.sql(insert).first()[0]  # the session is as it was
    assert sorted(r.id for r in written.where("flag").collect()) == [0, 2, 4, 6, 8] and written.count() == 10


def test_many_values_of_a_partition_column_are_still_written(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(0, 1000, 1, 1).selectExpr("id", "id % 50 AS part")
    written = wh.read_snapshot(wh.write(STAGING, "t", rows, partition_by=("part",)))
    assert written.count() == 1000 and written.where("part = id % 50").count() == 1000


def test_unsorted_writes_of_several_threads_leave_the_session_as_it_was(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with unsorted_partitions(spark):
        with unsorted_partitions(spark):
            assert int(spark.conf.get(name)) > 1
        assert int(spark.conf.get(name)) > 1
    assert int(spark.conf.get(name, "0")) == 0
    spark.conf.set(name, 3)
    try:
        with unsorted_partitions(spark):
            assert spark.conf.get(name) == "3"
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.unset(name)


def test_buckets_of_a_dimension_do_not_set_the_tasks_of_its_lookup(spark, tmp_path):
    """A dimension in one bucket: the rows looked up in it are not brought into one task."""
    wh = Warehouse(spark, str(tmp_path / "wh"), {"dim_cliente": 1})
    dims = spark.range(1000).selectExpr("id AS id_cliente", "id AS sk_cliente", "'x' AS provincia")
    wh.publish(wh.write(SERVICE, "dim_cliente", dims, ("id_cliente",)))
    sales = spark.range(9000).selectExpr("id AS id_venta", "id % 1000 AS id_cliente")
    one = replace(FACT_VENTAS, lookups=FACT_VENTAS.lookups[:1])
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else few rows are one task in any case
    try:
        keyed = star.lookup_keys(sales, jobs._dimensions_of(wh, one), one.lookups, "id_venta", max_broadcast=0)
        assert keyed.rdd.getNumPartitions() > 1 and keyed.count() == 9000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_filters_and_columns_reach_the_scan(warehouse):
    df = warehouse.read(STAGING, "stg_ventas").where("NOT is_deleted").select("id_venta")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(is_deleted), Not(EqualTo(is_deleted,true))]" in text
    assert "ReadSchema: struct<id_venta:int,is_deleted:boolean>" in text


def test_numbering_has_no_single_task_window_over_rows(spark):
    text = plan(assign_surrogate_keys(spark.range(1000).toDF("k"), ["k"]))
    # The only window runs over one row per partition, below the broadcast.
    assert text.count("Window [") <= 1
    assert "BroadcastHashJoin" in text


def test_marts_sum_facts_before_joining(warehouse):
    df = top_products(warehouse.read(SERVICE, "fact_ventas"), warehouse.read(SERVICE, "dim_producto"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.rindex("Aggregate [sk_producto")
    assert "TakeOrderedAndProject" in plan(df)


def test_staging_schema_is_the_declared_one(warehouse):
    found = warehouse.read(STAGING, "stg_ventas").schema.simpleString()
    assert found == VENTAS.schema().simpleString()


def test_a_part_of_the_model_is_what_its_tables_are_made_from():
    part = RETAIL.part({"stg_ventas", "dim_cliente"})
    assert {e.name for e in part.entities} == {"clientes", "ventas"}
    assert {f.table for f in part.feeds} == {"raw_ventas", "raw_clientes"}
    assert [d.table for d in part.dimensions] == ["dim_cliente"] and part.facts == () and part.calendar is None
    whole = RETAIL.part({"fact_ventas"})
    assert {d.table for d in whole.dimensions} == {lk.dimension for lk in FACT_VENTAS.lookups} - {RETAIL.calendar.table}
    assert whole.calendar == RETAIL.calendar and "raw_compras" not in {f.table for f in whole.feeds}
