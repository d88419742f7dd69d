"""Full runs over hand-written feeds."""

import datetime as dt
import shutil
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import T0, T1, T2
from retail_feeds import CLIENTES, VENTA, write_feeds

from stratamart.operators import active
from stratamart.plans import (
    RETAIL,
    create_tables,
    run_service,
    run_staging,
    run_warehouse,
    service_summary,
    staging_summary,
    unmatched_facts,
)
from stratamart.plans import retail
from stratamart.operators.checks import ConstraintError
from stratamart.plans.jobs import load_calendar, load_fact, stage_entity
from stratamart.sources import Warehouse, land
from stratamart.specs import SERVICE, STAGING, CalendarSpec


BUCKETS = {"stg_clientes": 3, "dim_cliente": 3, "stg_ventas": 4, "fact_ventas": 4}


@pytest.fixture(scope="module", params=[{}, {"stg_ventas": 4, "fact_ventas": 4, "stg_empleados": 4}])
def loaded(request, spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("retail")
    feeds = write_feeds(base / "feeds")
    wh = Warehouse(spark, str(base / "wh"), buckets=request.param)
    report = run_warehouse(wh, RETAIL, feeds, T0, create_schema=True, create=True)
    assert report.ok, report.failures()
    return wh, report


@pytest.fixture(scope="module")
def first_load(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("first")
    wh = Warehouse(spark, str(base / "wh"), BUCKETS)
    assert run_warehouse(wh, RETAIL, write_feeds(base / "feeds"), T0, True, True).ok
    return base / "wh"


@pytest.fixture
def wh(spark, first_load, tmp_path):
    """A warehouse after its first load, free to be changed: snapshots can be copied anywhere."""
    shutil.copytree(first_load, tmp_path / "wh")
    return Warehouse(spark, str(tmp_path / "wh"), BUCKETS)


def test_every_table_exists_and_is_reported(loaded):
    wh, report = loaded
    assert len(wh.tables("landing_zone")) == 10
    assert len(wh.tables(STAGING)) == 10
    assert wh.tables(SERVICE, like="dim_%") == sorted(
        [d.table for d in RETAIL.dimensions] + ["dim_tiempo"]
    )
    assert wh.tables(SERVICE, like="fact_%") == ["fact_compras", "fact_gastos", "fact_ventas"]
    assert wh.layers() == ["landing_zone", "service", "staging", "transformation"]
    assert report.failures() == {}
    steps = {s.step: s.rows for s in report}
    assert steps["land Venta.csv"] == 6
    assert steps["merge stg_clientes"] == 3
    assert steps["merge fact_ventas"] == 4
    assert steps["fill dim_tiempo"] == 4018


def test_client_cleaning(loaded):
    wh, _ = loaded
    by_id = {r.id_cliente: r for r in wh.read(STAGING, "stg_clientes").collect()}
    assert sorted(by_id) == [1, 2, 7]
    assert by_id[1].nombre_apellido == "Ana Paz"
    assert by_id[1].latitud == Decimal("-34.9000000000")
    assert by_id[1].longitud == Decimal("-58.1000000000")
    two = by_id[2]
    assert (two.provincia, two.nombre_apellido, two.domicilio) == ("Sin Dato", "", "")
    assert (two.telefono, two.edad, two.localidad) == (None, None, "Sin Dato")
    assert (two.latitud, two.marca_baja, two.fecha_alta) == (Decimal("0E-10"), 0, None)
    assert by_id[7].fecha_alta == dt.date(2019, 5, 6)
    assert two.created_at == two.updated_at == T0 and two.is_deleted is False


def test_sales_fact(loaded):
    wh, _ = loaded
    fact = {r.id_venta: r for r in wh.read(SERVICE, "fact_ventas").collect()}
    assert sorted(fact) == [1, 2, 3, 6]  # 4: unknown client, 5: outside the calendar
    assert fact[1].monto_total == Decimal("21.000")
    assert (fact[2].cantidad, fact[2].monto_total) == (1, Decimal("20.250"))
    assert fact[3].monto_total == Decimal("0.000")
    assert fact[3].sk_empleado is None and fact[6].sk_empleado is None
    employees = {
        (r.id_empleado, r.sucursal): r.sk_empleado for r in wh.read(SERVICE, "dim_empleado").collect()
    }
    assert fact[1].sk_empleado == employees[100, "Centro"]
    assert fact[2].sk_empleado == employees[100, "Norte"]
    assert sorted(r.sk_venta for r in fact.values()) == [1, 2, 3, 4]


def test_summaries(loaded):
    wh, _ = loaded
    assert [tuple(r) for r in staging_summary(wh, retail.VENTAS).collect()] == [
        ("Ventas Eliminadas (Soft Delete)", 0, Decimal("0.000")),
        ("Ventas Activas", 6, Decimal("68.250")),
    ]
    assert [tuple(r) for r in staging_summary(wh, retail.EMPLEADOS).collect()] == [
        ("Empleados Eliminados", 0),
        ("Empleados Activos", 3),
    ]
    with pytest.raises(LookupError):
        staging_summary(wh, retail.PRODUCTOS)
    sales = service_summary(wh, retail.FACT_VENTAS, wh.read(SERVICE, "dim_tiempo")).first()
    assert sales.tabla == "fact_ventas" and sales.total_registros == 4
    assert sales.monto_total_ventas == Decimal("48.250")
    assert (sales.primer_dia, sales.ultimo_dia) == (dt.date(2018, 3, 9), dt.date(2018, 4, 5))
    assert service_summary(wh, retail.DIMENSIONS[0]).first().total_registros == 3


def test_unmatched_report(loaded, rows):
    wh, _ = loaded
    report = {r.role: (r.null_keys, r.unknown_keys) for r in unmatched_facts(wh, retail.FACT_VENTAS).collect()}
    assert report == {
        "sk_cliente": (0, 1),
        "sk_producto": (0, 0),
        "sk_sucursal": (0, 0),
        "sk_empleado": (1, 2),
        "sk_tiempo_venta": (0, 1),
        "sk_tiempo_entrega": (0, 1),
        "sk_canal": (0, 0),
    }


def test_second_run_soft_deletes_and_keeps_keys(wh, tmp_path):
    keys = {r.id_venta: r.sk_venta for r in wh.read(SERVICE, "fact_ventas").collect()}

    fewer = "\n".join(line for line in VENTA.splitlines() if not line.startswith(("1,", "2,"))) + "\n"
    fewer += "8,2018-05-01,2018-05-02,1,1,1,100,10,1,1\n"
    feeds = write_feeds(tmp_path / "b", Venta=fewer, Clientes=CLIENTES.replace("Luis", "Luisa"))
    report = run_warehouse(wh, RETAIL, feeds, T1)
    assert report.ok, report.failures()

    staged = {r.id_venta: r for r in wh.read(STAGING, "stg_ventas").collect()}
    assert sorted(k for k, r in staged.items() if r.is_deleted) == [1, 2]
    assert staged[1].deleted_at == staged[1].updated_at == T1 and staged[1].created_at == T0
    assert staged[3].updated_at == T1 and staged[3].created_at == T0
    assert staged[8].created_at == T1
    assert active(wh.read(STAGING, "stg_ventas")).count() == 5

    fact = {r.id_venta: r for r in wh.read(SERVICE, "fact_ventas").collect()}
    assert sorted(fact) == [1, 2, 3, 6, 8]  # nothing is ever deleted here
    assert {k: fact[k].sk_venta for k in keys} == keys
    assert fact[8].sk_venta == 5
    assert fact[1].updated_at == T0 and fact[3].updated_at == T1
    names = {r.id_cliente: r.nombre_apellido for r in wh.read(SERVICE, "dim_cliente").collect()}
    assert names[7] == "Luisa"

    # The sales come back: revived, the first creation time kept.
    feeds = write_feeds(tmp_path / "c")
    assert run_warehouse(wh, RETAIL, feeds, T2).ok
    staged = {r.id_venta: r for r in wh.read(STAGING, "stg_ventas").collect()}
    assert (staged[1].is_deleted, staged[1].deleted_at, staged[1].created_at) == (False, None, T0)
    assert staged[8].is_deleted and staged[8].deleted_at == T2


def test_missing_feed_stops_before_staging(wh, tmp_path):
    report = run_warehouse(wh, RETAIL, write_feeds(tmp_path / "b", Venta=None), T1)
    assert list(report.failures()) == ["land Venta.csv"]
    assert not any(s.step.startswith("merge") for s in report)
    assert wh.read(STAGING, "stg_clientes").where("updated_at > created_at").isEmpty()


def test_failing_entity_keeps_its_snapshot_and_the_others_go_on(wh, tmp_path):
    bad = VENTA + "7,2018-05-01,2018-05-02,1,1,1,100,10,1,\"2,5\"\n"
    report = run_warehouse(wh, RETAIL, write_feeds(tmp_path / "b", Venta=bad), T1)
    assert list(report.failures()) == ["merge stg_ventas"]
    assert not any("fact" in s.step for s in report)
    assert wh.read(STAGING, "stg_ventas").where(f"updated_at > timestamp_ntz'{T0}'").isEmpty()
    assert wh.read(STAGING, "stg_gastos").where(f"updated_at = timestamp_ntz'{T1}'").count() == 2

    report = run_staging(wh, RETAIL.entities, T2)
    assert list(report.failures()) == ["merge stg_ventas"]
    duplicated = VENTA + VENTA.splitlines()[1] + "\n"
    report = run_warehouse(wh, RETAIL, write_feeds(tmp_path / "c", Venta=duplicated), T2)
    assert list(report.failures()) == ["merge stg_ventas"]
    assert "DuplicateKeyError" in report.failures()["merge stg_ventas"]
    no_date = VENTA.replace("6,2018-04-05", "6,")
    report = run_warehouse(wh, RETAIL, write_feeds(tmp_path / "d", Venta=no_date), T2)
    assert list(report.failures()) == ["merge stg_ventas"]
    assert "fecha not_null: 1 rows" in report.failures()["merge stg_ventas"]


def test_service_reports_null_measures(wh, tmp_path):
    no_quantity = "IdCompra,Fecha,IdProducto,Cantidad,Precio,IdProveedor\n1,2018-01-05,10,,4.5,1\n"
    report = run_warehouse(wh, RETAIL, write_feeds(tmp_path / "a", Compra=no_quantity), T1)
    assert list(report.failures()) == ["merge fact_compras"]
    assert wh.count(SERVICE, "fact_ventas") == 4


def test_delete_guard_is_opt_in(wh, tmp_path):
    empty = VENTA.splitlines()[0] + "\n"
    feeds = write_feeds(tmp_path / "b", Venta=empty)
    report = run_warehouse(wh, RETAIL, feeds, T1, max_delete_fraction=0.5)
    assert list(report.failures()) == ["merge stg_ventas"]
    assert run_warehouse(wh, RETAIL, feeds, T1).ok
    assert active(wh.read(STAGING, "stg_ventas")).isEmpty()
    assert wh.count(SERVICE, "fact_ventas") == 4


def test_delete_guard_compares_with_the_rows_that_were_active(spark, tmp_path):
    """A run that revives nine rows in ten and drops all that were active must not look like a small deletion."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    spec = next(e for e in RETAIL.entities if e.name == "canal_venta")

    def landed(ids):
        rows = spark.createDataFrame([(str(i), f"c{i}") for i in ids], "codigo string, descripcion string")
        land(wh, rows, spec.source, T0)

    landed(range(100))
    stage_entity(wh, spec, T0)
    landed(range(10))
    stage_entity(wh, spec, T1)
    landed(range(10, 100))
    with pytest.raises(ConstraintError, match="would soft-delete 10 of 10 active rows"):
        stage_entity(wh, spec, T2, max_delete_fraction=0.5)
    assert stage_entity(wh, spec, T2) == 100
    measured = wh.current(STAGING, spec.table).metrics
    assert (measured["active before"], measured["deleted now"], measured["revived now"]) == (10, 10, 90)
    # The same run once more, with its own timestamp: nothing is deleted a second time.
    assert stage_entity(wh, spec, T2, max_delete_fraction=0.0) == 100


def test_versions_to_keep(wh, tmp_path):
    feeds = write_feeds(tmp_path / "a")
    for when in (T1, T2):
        assert run_warehouse(wh, RETAIL, feeds, when, keep_versions=2).ok
    for layer in wh.layers():
        for table in wh.tables(layer):
            assert len([f for f in wh._children(wh.root, layer, table)]) <= 2, table
    assert wh.read(SERVICE, "fact_ventas").count() == wh.count(SERVICE, "fact_ventas") == 4


def test_only_init_and_report_frame(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"stg_ventas": 4})
    report = run_warehouse(wh, RETAIL, None, T0, create_schema=True, create=True, only_init=True)
    assert report.ok and not any(s.step.startswith("land") for s in report)
    assert wh.read(STAGING, "stg_ventas").columns == retail.VENTAS.schema().fieldNames()
    assert wh.count(STAGING, "stg_ventas") == 0 and wh.count(SERVICE, "dim_tiempo") == 4018
    frame = report.to_df(spark)
    assert frame.columns == ["step", "ok", "rows", "seconds", "message"]
    assert frame.count() == len(report)
    assert create_tables(wh, RETAIL, T1).ok and all(s.seconds >= 0 for s in report)
    assert run_service(wh, RETAIL.dimensions, RETAIL.facts, T1).ok


def test_calendar_grows_and_keeps_its_keys(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    spec = CalendarSpec("dim_tiempo", "sk_tiempo", "2020-01-05", "2020-01-10")
    assert load_calendar(wh, spec, T0) == 6
    keys = {r.fecha: (r.sk_tiempo, r.created_at) for r in wh.read(SERVICE, "dim_tiempo").collect()}
    wider = CalendarSpec("dim_tiempo", "sk_tiempo", "2020-01-01", "2020-01-12")
    assert load_calendar(wh, wider, T1) == 12
    after = {r.fecha: (r.sk_tiempo, r.created_at) for r in wh.read(SERVICE, "dim_tiempo").collect()}
    assert {day: after[day] for day in keys} == keys
    assert sorted(k for k, _ in after.values()) == list(range(1, 13))
    assert load_calendar(wh, spec, T2) == 12


def test_dedupe_is_opt_in(wh, tmp_path):
    twice = CLIENTES + "7;Cordoba;Luis Nuevo;;222;42;Cordoba;-64,18;-31,42;2019-05-06;u;2020-01-01;;1;z\n"
    feeds = write_feeds(tmp_path / "a", Clientes=twice)
    assert list(run_warehouse(wh, RETAIL, feeds, T1).failures()) == ["merge stg_clientes"]
    latest = {"clientes": ("fecha_ultima_modificacion",)}
    assert run_warehouse(wh, RETAIL, feeds, T1, dedupe=latest).ok
    names = {r.id_cliente: r.nombre_apellido for r in wh.read(STAGING, "stg_clientes").collect()}
    assert names[7] == "Luis Nuevo" and len(names) == 3


def test_fact_load_with_dimensions_too_large_to_broadcast(spark, wh):
    expected = sorted(map(tuple, wh.read(SERVICE, "fact_ventas").drop("updated_at").collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert load_fact(wh, retail.FACT_VENTAS, T1) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    loaded = wh.read(SERVICE, "fact_ventas")
    assert sorted(map(tuple, loaded.drop("updated_at").collect())) == expected
    assert wh.current(SERVICE, "fact_ventas").metrics["newest key"] == 4


def test_rebuilding_a_table_with_another_key(wh):
    by_id = replace(retail.EMPLEADOS, keys=("id_empleado",))
    assert list(run_staging(wh, [by_id], T1).failures()) == ["merge stg_empleados"]
    by_id_and_branch = retail.EMPLEADOS
    wh.create(STAGING, by_id_and_branch.table, by_id_and_branch.schema())
    assert run_staging(wh, [by_id_and_branch], T1).ok
    assert wh.read(STAGING, "stg_empleados").where(f"created_at = timestamp_ntz'{T1}'").count() == 3
