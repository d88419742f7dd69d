"""What loads leave on the disks: their tables, and nothing that they were made of on the way."""

import os
import time

import pytest
from conftest import T0, T1
from retail_feeds import write_feeds

from stratamart.operators import fact_rows
from stratamart.operators.keys import assign_surrogate_keys
from stratamart.plans import RETAIL, run_warehouse
from stratamart.plans.jobs import load_fact
from stratamart.plans.retail import FACT_VENTAS
from stratamart.session import passing_shuffles
from stratamart.sources import Warehouse
from stratamart.sources.shared_folder import fresh_folder, passing_folders, shared_folder
from stratamart.specs import SERVICE, STAGING

BUCKETS = {"stg_ventas": 4, "fact_ventas": 4}


def shuffled(spark):
    """Names of the shuffle files that the session holds."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {os.path.basename(f) for f in manager.getAllFiles().mkString("\n").splitlines() if "shuffle_" in f}


def left(spark, before):
    """What was shuffled since; files are deleted shortly after a query ends."""
    until = time.time() + 10
    while (files := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return files


def shared(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def looked_up(warehouse, **options):
    dims = {lk.dimension: warehouse.read(SERVICE, lk.dimension, bucketed=False) for lk in FACT_VENTAS.lookups}
    return fact_rows(warehouse.read(STAGING, "stg_ventas"), dims, FACT_VENTAS, max_broadcast=0, **options)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("disk")
    wh = Warehouse(spark, str(base / "wh"), BUCKETS)
    assert run_warehouse(wh, RETAIL, write_feeds(base / "a"), T0, True, True).ok
    return wh


def test_a_load_leaves_its_tables_only(spark, tmp_path):
    shuffles, folders = shuffled(spark), shared(spark)
    wh = Warehouse(spark, str(tmp_path / "wh"), BUCKETS)
    assert run_warehouse(wh, RETAIL, write_feeds(tmp_path / "a"), T0, True, True).ok
    assert not left(spark, shuffles) and shared(spark) == folders


def test_a_fact_load_by_shuffles_leaves_its_table_only(spark, warehouse):
    shuffles, folders = shuffled(spark), shared(spark)
    load_fact(warehouse, FACT_VENTAS, T1, max_broadcast=0)
    assert not left(spark, shuffles) and shared(spark) == folders


def test_lookups_in_turn_hold_the_shuffles_of_one(spark, warehouse, rows):
    at_once = looked_up(warehouse)
    expected, shuffles = rows(at_once), shuffled(spark)
    plan = at_once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= len(FACT_VENTAS.lookups)
    with passing_shuffles(spark), passing_folders(spark):
        here = os.path.dirname(fresh_folder(spark, "x")).removeprefix("file:")
        in_turn = looked_up(warehouse, in_turn=True)
        assert not left(spark, shuffles)  # those of the lookups so far are gone
        assert sum(name.startswith("looked-up") for name in os.listdir(here)) == 1
        last = in_turn._jdf.queryExecution().executedPlan().toString()
        assert last.count("SortMergeJoin") == 1
        assert rows(in_turn) == expected and in_turn.dtypes == at_once.dtypes
    assert not os.path.exists(here)


def test_folders_in_passing_go_also_after_a_failure_and_others_stay(spark):
    kept = fresh_folder(spark, "kept")
    spark.range(3).write.parquet(kept)
    with pytest.raises(ZeroDivisionError):
        with passing_folders(spark):
            numbered = assign_surrogate_keys(spark.range(10), ["id"])
            with passing_folders(spark):
                spark.range(1).write.parquet(inner := fresh_folder(spark, "inner"))
            assert not os.path.exists(inner.removeprefix("file:")) and numbered.count() == 10
            gone = os.path.dirname(inner)
            raise ZeroDivisionError
    assert not os.path.exists(gone.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


def test_a_session_that_keeps_shuffles_does_so_again_afterwards(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with passing_shuffles(spark):
        with passing_shuffles(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == "false"


def test_consumed_feeds_go_once_all_are_landed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    incomplete = write_feeds(tmp_path / "a", Venta=None)
    assert not run_warehouse(wh, RETAIL, incomplete, T0, True, True, consume=True).ok
    assert os.listdir(incomplete)
    feeds = write_feeds(tmp_path / "b")
    assert run_warehouse(wh, RETAIL, feeds, T1, consume=True).ok and not os.path.exists(feeds)
    assert wh.count(SERVICE, "fact_ventas") > 0
    with pytest.raises(ValueError):
        run_warehouse(wh, RETAIL, incomplete, T1, consume=True, resume=True)
