"""What commits know: summaries without a scan, files that were landed, steps that need not be done again."""

import pytest
from conftest import T0, T1
from pyspark.sql import functions as F
from retail_feeds import FILES, GASTO, write_feeds

from stratamart.operators import active_deleted_summary, fact_totals
from stratamart.plans import RETAIL, retail, run_warehouse, service_summary, staging_summary
from stratamart.plans.jobs import UNCHANGED, land_feed, run_landing
from stratamart.sources import Warehouse
from stratamart.specs import LANDING, SERVICE, STAGING, FeedSpec

FEED = FeedSpec("lines", "raw_lines", ("a", "b"), ",")


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan") + plan.count("BatchScan")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("ledger")
    wh = Warehouse(spark, str(base / "wh"))
    assert run_warehouse(wh, RETAIL, write_feeds(base / "a"), T0, True, True).ok
    second = "\n".join(line for line in FILES["Venta.csv"].splitlines() if not line.startswith("6,"))
    assert run_warehouse(wh, RETAIL, write_feeds(base / "b", Venta=second), T1).ok
    return wh


def test_summaries_of_commits_are_those_of_a_scan(loaded, rows):
    for spec in RETAIL.entities:
        if spec.labels is None:
            continue
        known = staging_summary(loaded, spec)
        assert scans(known) == 0
        scanned = active_deleted_summary(loaded.read(STAGING, spec.table), spec.labels, spec.amount)
        assert known.schema.simpleString() == scanned.schema.simpleString() and rows(known) == rows(scanned)
    for spec in RETAIL.facts:
        known = service_summary(loaded, spec)
        assert scans(known) == 0
        scanned = fact_totals(loaded.read(SERVICE, spec.table), spec)
        assert known.schema.simpleString() == scanned.schema.simpleString() and rows(known) == rows(scanned)
    sales = {r.descripcion: r.cantidad for r in staging_summary(loaded, retail.VENTAS).collect()}
    assert sorted(sales.values()) == [1, 5]


def test_a_version_without_measures_is_scanned(spark, loaded, tmp_path, rows):
    other = Warehouse(spark, str(tmp_path / "wh"))
    other.publish(other.write(STAGING, "stg_ventas", loaded.read(STAGING, "stg_ventas")))
    assert scans(staging_summary(other, retail.VENTAS)) == 1
    assert rows(staging_summary(other, retail.VENTAS)) == rows(staging_summary(loaded, retail.VENTAS))


def test_measures_of_folders_combine(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    measure = {"n": F.sum("id"), "first": F.min("id"), "last": F.max("id"), "money": F.sum(F.col("id").cast("decimal(9,2)"))}
    for part in (spark.range(5, 9), spark.range(0), spark.range(2, 4)):
        wh.publish(wh.write(LANDING, "t", part, append=True, measure=measure))
    stored = wh.current(LANDING, "t")
    whole = wh.read(LANDING, "t").agg(*[c.alias(n) for n, c in measure.items()]).first()
    for name, combine in {"n": sum, "first": min, "last": max, "money": sum}.items():
        assert stored.over_folders(name, combine) == whole[name]
    assert stored.all_rows == wh.read(LANDING, "t").count() == 6
    together = wh.write(LANDING, "t", wh.read(LANDING, "t").orderBy(F.desc("id")))
    assert together.checksum == stored.checksum != wh.write(LANDING, "t", spark.range(6)).checksum


def test_repeated_appends_add_nothing(spark, tmp_path):
    wh, folder = Warehouse(spark, str(tmp_path / "wh")), tmp_path / "lines"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,x\n2,y\n")
    counts = []
    for step in range(4):
        if step == 2:
            (folder / "2.csv").write_text("a,b\n3,z\n")
        land_feed(wh, FEED, str(folder), T0 if step < 2 else T1, truncate=False)
        counts.append((wh.count(LANDING, "raw_lines"), len(wh.current(LANDING, "raw_lines").folders)))
    assert counts == [(2, 1), (2, 1), (3, 2), (3, 2)]
    assert {(r.a, r.created_at) for r in wh.read(LANDING, "raw_lines").collect()} == {("1", T0), ("2", T0), ("3", T1)}
    (folder / "1.csv").write_text("a,b\n1,changed\n")
    (step,) = run_landing(wh, [FEED], str(tmp_path), T1, truncate=False)
    assert not step.ok and "changed after it was landed" in step.message
    assert wh.count(LANDING, "raw_lines") == 3


def done_again(report):
    return {s.step for s in report if s.message != UNCHANGED}


def test_a_failed_run_is_resumed(spark, tmp_path):
    wh, feeds = Warehouse(spark, str(tmp_path / "wh")), tmp_path / "feeds"
    first = run_warehouse(wh, RETAIL, write_feeds(feeds, Gasto=GASTO.replace("1000.50", "much")), T0, True, True)
    assert list(first.failures()) == ["merge stg_gastos"]
    assert not any(s.step.startswith("merge fact") for s in first)
    versions = {t: wh.current(STAGING, t).version for t in wh.tables(STAGING)}
    (feeds / "Gasto.csv").write_text(GASTO)
    second = run_warehouse(wh, RETAIL, str(feeds), T0, create=True, resume=True)
    assert second.ok, second.failures()
    staging = {s for s in done_again(second) if s.startswith(("land ", "merge stg_"))}
    assert staging == {"land Gasto.csv", *first.failures()}
    for table, version in versions.items():
        assert (wh.current(STAGING, table).version > version) == (f"merge {table}" in first.failures())
    assert wh.count(SERVICE, "fact_gastos") == 2
    # A whole run repeated: nothing is left to do, not even the calendar.
    third = run_warehouse(wh, RETAIL, str(feeds), T0, create=True, resume=True)
    assert done_again(third) <= {"fill dim_tiempo"} and [s.rows for s in third if s.step == "merge fact_ventas"] == [4]
    # Another run starts from the beginning, and so does one without resume.
    tables = len(RETAIL.feeds) + len(RETAIL.entities) + len(RETAIL.dimensions) + len(RETAIL.facts)
    assert len(done_again(run_warehouse(wh, RETAIL, str(feeds), T1, resume=True))) == tables
    with pytest.raises(ValueError, match="nothing to resume"):
        run_warehouse(wh, RETAIL, str(feeds), T1, create_schema=True, resume=True)
