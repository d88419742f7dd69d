"""Load summaries and analytic reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators import (
    active_deleted_summary,
    branch_performance,
    calendar_coverage,
    dimension_size,
    fact_totals,
    find_duplicates,
    latest_deleted,
    merge_soft_delete,
    monthly_sales,
    table_counts,
    top_products,
)
from stratamart.operators.calendar import date_dimension_for
from stratamart.plans.queries import merging, star
from stratamart.plans.queries.loaded import served, staged
from stratamart.plans.queries.registry import SQL, query, table
from stratamart.plans.queries.roles import CALENDAR_SQL, MODEL, RUN, STAGED_SQL, entity, keyed_sql
from stratamart.specs import SummaryLabels

_MERGED_SALES = SQL["merge_soft_delete_single"]


@query("""
    SELECT l_orderkey, l_linenumber, cast(sum(n) AS BIGINT) AS cantidad,
           string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS marcas
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem
          GROUP BY l_orderkey, l_linenumber, l_returnflag) AS x
    GROUP BY l_orderkey, l_linenumber HAVING sum(n) > 1""")
def duplicate_keys_listing(spark, sf):
    lines = table(spark, sf, "lineitem")
    return find_duplicates(lines, ["l_orderkey", "l_linenumber"], "l_returnflag", "marcas")


_MODES = "CASE WHEN l_returnflag = 'R' OR l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag || l_linestatus END"


@query(f"""
    SELECT l_suppkey, count(*) AS cantidad, string_agg(DISTINCT modo, ', ' ORDER BY modo) AS modos
    FROM (SELECT CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey, {_MODES} AS modo
          FROM lineitem) AS x
    GROUP BY l_suppkey HAVING count(*) > 1""")
def duplicate_keys_listing_nulls(spark, sf):
    """A text column with NULLs: some keys list nothing, and one key is NULL itself."""
    lines = table(spark, sf, "lineitem").select(
        F.expr("CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey"), F.expr(_MODES).alias("modo")
    )
    return find_duplicates(lines, ["l_suppkey"], "modo", "modos")


@query(f"""
    SELECT 'Ventas Activas' AS descripcion, count(*) AS cantidad FROM ({_MERGED_SALES}) AS m
    WHERE NOT is_deleted
    UNION ALL SELECT 'Ventas Eliminadas (Soft Delete)', count(*) FROM ({_MERGED_SALES}) AS m
    WHERE is_deleted""")
def active_deleted_counts(spark, sf):
    merged = merging.merge_soft_delete_single(spark, sf)
    return active_deleted_summary(merged, entity("ventas").labels)


@query(f"""
    SELECT 'Ventas Activas' AS descripcion, count(*) AS cantidad,
           cast(sum(precio * cantidad) AS DECIMAL(38,3)) AS monto_total
    FROM ({_MERGED_SALES}) AS m WHERE NOT is_deleted
    UNION ALL SELECT 'Ventas Eliminadas (Soft Delete)', count(*), cast(0 AS DECIMAL(38,3))
    FROM ({_MERGED_SALES}) AS m WHERE is_deleted""")
def amount_summary(spark, sf):
    spec = entity("ventas")
    return active_deleted_summary(merging.merge_soft_delete_single(spark, sf), spec.labels, spec.amount)


# Purchases of the first suppliers were not delivered again.
_KEPT_PURCHASES = "id_proveedor > 3"


@query(f"""
    SELECT 'Compras Activas' AS descripcion, count(*) FILTER (WHERE {_KEPT_PURCHASES}) AS cantidad,
           cast(sum(CASE WHEN {_KEPT_PURCHASES} THEN precio * cantidad END) AS DECIMAL(38,3)) AS monto_total
    FROM {STAGED_SQL["compras"]} AS c
    UNION ALL SELECT 'Compras Eliminadas (Soft Delete)', count(*) FILTER (WHERE NOT {_KEPT_PURCHASES}),
           cast(0 AS DECIMAL(38,3)) FROM {STAGED_SQL["compras"]} AS c""")
def purchase_summary(spark, sf):
    spec = entity("compras")
    rows = staged(spark, sf, spec.table).withColumn("is_deleted", ~F.expr(_KEPT_PURCHASES))
    return active_deleted_summary(rows, spec.labels, spec.amount)


# Tables with a summary of counts only, and what of them was not delivered again.
_DROPPED = {
    "clientes": "provincia = 'BUILDING'",
    "productos": "precio < 1000",
    "empleados": "cargo = 'Visitor'",
    "sucursales": "id_sucursal < 5",
    "proveedores": "id_proveedor <= 3",
    "canal_venta": "id_canal = 2",
    "tipo_gasto": "id_tipo_gasto = 5",
}


def _summary_sql(name: str, dropped: str) -> str:
    labels, rows = entity(name).labels, f"{STAGED_SQL[name]} AS s"
    return (
        f"SELECT '{labels.active}' AS descripcion, count(*) FILTER (WHERE NOT {dropped}) AS cantidad FROM {rows} "
        f"UNION ALL SELECT '{labels.deleted}', count(*) FILTER (WHERE {dropped}) FROM {rows}"
    )


@query(" UNION ALL ".join(_summary_sql(n, d) for n, d in _DROPPED.items() if entity(n).labels))
def active_deleted_by_table(spark, sf):
    """The count-only summaries of all other staging tables, one after the other."""
    summaries = [
        active_deleted_summary(
            staged(spark, sf, entity(name).table).withColumn("is_deleted", F.expr(dropped)), entity(name).labels
        )
        for name, dropped in _DROPPED.items()
        if entity(name).labels
    ]
    return reduce(DataFrame.unionByName, summaries)


# Expenses of the kind "error" were not delivered again.
_KEPT_EXPENSES = "id_tipo_gasto <> 5"


@query(f"""
    SELECT 'Gastos Activos' AS descripcion,
           count(*) FILTER (WHERE {_KEPT_EXPENSES}) AS cantidad,
           cast(sum(CASE WHEN {_KEPT_EXPENSES} THEN monto END) AS DECIMAL(38,3)) AS monto_total
    FROM {STAGED_SQL["gastos"]} AS g
    UNION ALL SELECT 'Gastos Eliminados', count(*) FILTER (WHERE NOT {_KEPT_EXPENSES}),
           cast(0 AS DECIMAL(38,3)) FROM {STAGED_SQL["gastos"]} AS g""")
def expense_summary(spark, sf):
    spec = entity("gastos")
    expenses = staged(spark, sf, "stg_gastos").select(*[r.name for r in spec.columns])
    first = merge_soft_delete(
        merging._with_audit(expenses.where("false"), "false"),
        expenses, spec.keys, spec.attributes, RUN,
    )
    second = merge_soft_delete(
        first, expenses.where(_KEPT_EXPENSES), spec.keys, spec.attributes, RUN
    )
    return active_deleted_summary(second, spec.labels, spec.amount)


@query("\nUNION ALL\n".join(
    f"SELECT '{d.table}' AS dimension, count(*) AS total_registros FROM {STAGED_SQL[e.name]} AS s"
    for d in MODEL.dimensions for e in MODEL.entities if e.table == d.source
))
def dimension_sizes(spark, sf):
    dims = served(spark, sf, *[d.table for d in MODEL.dimensions])
    return reduce(DataFrame.unionByName, [dimension_size(df, name) for name, df in dims.items()])


@query(f"""
    SELECT 'fact_ventas' AS tabla, count(*) AS total_registros,
           cast(sum(monto_total) AS DECIMAL(38,3)) AS monto_total_ventas,
           min(sk_tiempo_venta) AS fecha_min, max(sk_tiempo_venta) AS fecha_max,
           min(fecha) AS primer_dia, max(fecha) AS ultimo_dia
    FROM ({star._FACT_SQL}) AS f
    JOIN (SELECT sk_tiempo, fecha FROM {CALENDAR_SQL} AS c) AS d ON d.sk_tiempo = f.sk_tiempo_venta""")
def sales_totals(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_tiempo")
    return fact_totals(tables["fact_ventas"], MODEL.facts[0], tables["dim_tiempo"])


@query(f"""
    SELECT 'fact_compras' AS tabla, count(*) AS total_registros,
           cast(sum(monto_total) AS DECIMAL(38,3)) AS monto_total_compras
    FROM ({SQL["purchases_fact"]}) AS f""")
def purchase_totals(spark, sf):
    return fact_totals(served(spark, sf, "fact_compras")["fact_compras"], MODEL.facts[1])


@query(f"""
    SELECT 'fact_gastos' AS tabla, count(*) AS total_registros,
           cast(sum(monto) AS DECIMAL(38,3)) AS monto_total_gastos
    FROM ({SQL["expenses_fact"]}) AS f""")
def expense_totals(spark, sf):
    return fact_totals(served(spark, sf, "fact_gastos")["fact_gastos"], MODEL.facts[2])


@query("""
    SELECT min(d) AS fecha_min, max(d) AS fecha_max, date_diff('day', min(d), max(d)) + 1 AS total_dias
    FROM (SELECT cast(l_shipdate AS DATE) AS d FROM lineitem) AS l""")
def calendar_span(spark, sf):
    shipped = F.col("l_shipdate").cast("date")
    return calendar_coverage(date_dimension_for(table(spark, sf, "lineitem"), shipped, shipped))


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("\nUNION ALL\n".join(f"SELECT '{t}' AS tabla, count(*) AS registros FROM {t}" for t in _COUNTED))
def row_counts(spark, sf):
    return table_counts({t: table(spark, sf, t) for t in _COUNTED})


_ROUNDED = "cast(round(cast(sum({0}) AS DECIMAL(38,3)), 2) AS DECIMAL(38,2))"


def _top_sql(by: str, renamed: str) -> str:
    return f"""
        SELECT {renamed}, cast(sum(cantidad) AS BIGINT) AS total_vendido,
               {_ROUNDED.format("monto_total")} AS ingresos_totales
        FROM ({star._FACT_SQL}) AS f
        JOIN {keyed_sql("productos", "id_producto", "sk_producto")} AS p USING (sk_producto)
        GROUP BY {by} ORDER BY ingresos_totales DESC, {by} LIMIT 10"""


@query(_top_sql("producto, tipo", "producto, tipo AS tipo_producto"))
def top_products_by_type(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_producto")
    return top_products(tables["fact_ventas"], tables["dim_producto"])


@query(_top_sql("producto", "producto"))
def top_products_by_name(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_producto")
    return top_products(tables["fact_ventas"], tables["dim_producto"], by=["producto"])


_MONTHLY_SQL = f"""
    SELECT anio, mes, mes_nombre, count(*) AS cantidad_ventas,
           {_ROUNDED.format("monto_total")} AS monto_total
    FROM ({star._FACT_SQL}) AS f JOIN {CALENDAR_SQL} AS d ON d.sk_tiempo = f.sk_tiempo_venta
    GROUP BY anio, mes, mes_nombre"""


@query(_MONTHLY_SQL)
def sales_by_month(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_tiempo")
    return monthly_sales(tables["fact_ventas"], tables["dim_tiempo"])


def _branch_sql(by: str) -> str:
    return f"""
        SELECT {by}, count(*) AS cantidad_ventas, {_ROUNDED.format("monto_total")} AS monto_total
        FROM ({star._FACT_SQL}) AS f
        JOIN {keyed_sql("sucursales", "id_sucursal", "sk_sucursal")} AS b USING (sk_sucursal)
        GROUP BY {by}"""


@query(_branch_sql("provincia, sucursal"))
def sales_by_branch(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_sucursal")
    return branch_performance(tables["fact_ventas"], tables["dim_sucursal"])


@query(_branch_sql("provincia"))
def sales_by_province(spark, sf):
    tables = served(spark, sf, "fact_ventas", "dim_sucursal")
    return branch_performance(tables["fact_ventas"], tables["dim_sucursal"], by=["provincia"])


@query(f"""
    SELECT id_venta, id_cliente, precio, is_deleted, deleted_at, updated_at
    FROM ({_MERGED_SALES}) AS m WHERE is_deleted
    ORDER BY deleted_at DESC, id_venta LIMIT 10""")
def latest_deleted_sales(spark, sf):
    merged = merging.merge_soft_delete_single(spark, sf)
    return latest_deleted(merged, ["id_venta"], ["id_cliente", "precio"])


@query("""
    SELECT 'live' AS descripcion, count(*) AS cantidad FROM customer
    UNION ALL SELECT 'gone', 0""")
def summary_without_deletions(spark, sf):
    """Both lines are there even if one of them counts nothing."""
    rows = table(spark, sf, "customer").select("c_custkey", F.lit(False).alias("is_deleted"))
    return active_deleted_summary(rows, SummaryLabels("live", "gone"))
