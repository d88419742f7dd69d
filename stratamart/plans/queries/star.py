"""Calendar, surrogate key lookups and integrity checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from stratamart.operators import (
    check_constraints,
    fact_rows,
    lookup_keys,
    orphaned_keys,
    unmatched_report,
)
from stratamart.operators.calendar import date_dimension_for
from stratamart.plans.queries.loaded import loaded_part
from stratamart.plans.queries.registry import query, table
from stratamart.plans.queries.roles import CALENDAR_SQL, MODEL, STAGED_SQL, keyed_sql

_SALES_FACT, _PURCHASES_FACT, _EXPENSES_FACT = MODEL.facts
_SALES_DIMENSIONS = sorted({lookup.dimension for lookup in _SALES_FACT.lookups})


@query("""
    SELECT cast(d AS DATE) AS fecha, cast(year(d) AS INTEGER) AS anio, cast(month(d) AS INTEGER) AS mes,
           cast(day(d) AS INTEGER) AS dia, cast(quarter(d) AS INTEGER) AS trimestre,
           cast(weekofyear(d) AS INTEGER) AS semana, dayname(d) AS dia_nombre,
           monthname(d) AS mes_nombre, dayofweek(d) IN (0, 6) AS es_fin_semana
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
          FROM (SELECT cast(cast(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate FROM orders) AS o
         ) AS g""")
def date_dimension_of_orders(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return date_dimension_for(table(spark, sf, "orders"), day, day)


_FACT_SQL = f"""
    SELECT v.id_venta, c.sk_cliente, p.sk_producto, b.sk_sucursal, e.sk_empleado,
           d1.sk_tiempo AS sk_tiempo_venta, d2.sk_tiempo AS sk_tiempo_entrega, ch.sk_canal,
           v.cantidad, v.precio AS precio_unitario,
           cast(v.precio * v.cantidad AS DECIMAL(15,3)) AS monto_total
    FROM {STAGED_SQL["ventas"]} AS v
    JOIN {keyed_sql("clientes", "id_cliente", "sk_cliente")} AS c ON v.id_cliente = c.id_cliente
    JOIN {keyed_sql("productos", "id_producto", "sk_producto")} AS p ON v.id_producto = p.id_producto
    JOIN {keyed_sql("sucursales", "id_sucursal", "sk_sucursal")} AS b ON v.id_sucursal = b.id_sucursal
    LEFT JOIN {keyed_sql("empleados", "id_empleado, sucursal", "sk_empleado")} AS e
           ON v.id_empleado = e.id_empleado AND b.sucursal = e.sucursal
    JOIN {CALENDAR_SQL} AS d1 ON v.fecha = d1.fecha
    JOIN {CALENDAR_SQL} AS d2 ON v.fecha_entrega = d2.fecha
    JOIN {keyed_sql("canal_venta", "id_canal", "sk_canal")} AS ch ON v.id_canal = ch.id_canal"""


@query(_FACT_SQL)
def star_lookup(spark, sf):
    sales, dims = loaded_part(spark, sf, "stg_ventas", *_SALES_DIMENSIONS)
    return fact_rows(sales, dims, _SALES_FACT)


@query(f"""
    SELECT v.id_venta, c.sk_cliente, c.provincia
    FROM {STAGED_SQL["ventas"]} AS v
    JOIN {keyed_sql("clientes", "id_cliente", "sk_cliente")} AS c ON v.id_cliente = c.id_cliente""")
def star_lookup_hot_keys(spark, sf):
    """The shuffled form of a lookup, for dimensions too large to broadcast.

    A task's share is three sales here, so that almost every customer has more and is spread.
    """
    lookup = replace(_SALES_FACT.lookups[0], carry=("provincia",))
    sales, dims = loaded_part(spark, sf, "stg_ventas", "dim_cliente")
    keyed = lookup_keys(
        sales.select("id_venta", "id_cliente"),
        dims,
        [lookup],
        "id_venta",
        hot_rows=3,
        max_broadcast=0,
    )
    return keyed.select("id_venta", "sk_cliente", "provincia")


_DAY_ROLES = tuple(lk for lk in _SALES_FACT.lookups if lk.dimension == "dim_tiempo")


@query(f"""
    SELECT v.id_venta, d1.sk_tiempo AS sk_tiempo_venta, d2.sk_tiempo AS sk_tiempo_entrega
    FROM {STAGED_SQL["ventas"]} AS v JOIN {CALENDAR_SQL} AS d1 ON v.fecha = d1.fecha
    JOIN {CALENDAR_SQL} AS d2 ON v.fecha_entrega = d2.fecha""")
def role_playing_dates(spark, sf):
    sales, dims = loaded_part(spark, sf, "stg_ventas", "dim_tiempo")
    keyed = lookup_keys(sales.select("id_venta", "fecha", "fecha_entrega"), dims, _DAY_ROLES, "id_venta")
    return keyed.select("id_venta", "sk_tiempo_venta", "sk_tiempo_entrega")


_BRANCH_ROLES = tuple(
    lk for lk in _SALES_FACT.lookups if lk.dimension in ("dim_sucursal", "dim_empleado")
)


@query(f"""
    SELECT v.id_venta, b.sk_sucursal, e.sk_empleado
    FROM {STAGED_SQL["ventas"]} AS v
    JOIN {keyed_sql("sucursales", "id_sucursal", "sk_sucursal")} AS b ON v.id_sucursal = b.id_sucursal
    LEFT JOIN {keyed_sql("empleados", "id_empleado, sucursal", "sk_empleado")} AS e
           ON v.id_empleado = e.id_empleado AND b.sucursal = e.sucursal""")
def left_composite_lookup(spark, sf):
    sales, dims = loaded_part(spark, sf, "stg_ventas", "dim_sucursal", "dim_empleado")
    keyed = lookup_keys(sales.select("id_venta", "id_sucursal", "id_empleado"), dims, _BRANCH_ROLES, "id_venta")
    return keyed.select("id_venta", "sk_sucursal", "sk_empleado")


_SHORT_END = "1999-12-31"  # a calendar that ends before the last orders


@query(f"""
    WITH v AS (SELECT * FROM {STAGED_SQL["ventas"]} AS s),
    c AS (SELECT * FROM {STAGED_SQL["clientes"]} AS s), p AS (SELECT * FROM {STAGED_SQL["productos"]} AS s),
    b AS (SELECT * FROM {STAGED_SQL["sucursales"]} AS s), e AS (SELECT * FROM {STAGED_SQL["empleados"]} AS s),
    ch AS (SELECT * FROM {STAGED_SQL["canal_venta"]} AS s),
    d AS (SELECT fecha FROM {CALENDAR_SQL} AS x WHERE fecha <= DATE '{_SHORT_END}'),
    vb AS (SELECT v.id_venta, v.id_empleado, b.sucursal FROM v
           JOIN b ON v.id_sucursal = b.id_sucursal)
    SELECT 'dim_cliente' AS dimension, 'sk_cliente' AS role,
           count(*) FILTER (WHERE id_cliente IS NULL) AS null_keys,
           count(*) FILTER (WHERE id_cliente NOT IN (SELECT id_cliente FROM c)) AS unknown_keys FROM v
    UNION ALL SELECT 'dim_producto', 'sk_producto', count(*) FILTER (WHERE id_producto IS NULL),
           count(*) FILTER (WHERE id_producto NOT IN (SELECT id_producto FROM p)) FROM v
    UNION ALL SELECT 'dim_sucursal', 'sk_sucursal', count(*) FILTER (WHERE id_sucursal IS NULL),
           count(*) FILTER (WHERE id_sucursal NOT IN (SELECT id_sucursal FROM b)) FROM v
    UNION ALL SELECT 'dim_empleado', 'sk_empleado',
           count(*) FILTER (WHERE vb.id_empleado IS NULL OR vb.sucursal IS NULL),
           count(*) FILTER (WHERE vb.id_empleado IS NOT NULL AND vb.sucursal IS NOT NULL
                            AND e.id_empleado IS NULL)
           FROM vb LEFT JOIN e ON vb.id_empleado = e.id_empleado AND vb.sucursal = e.sucursal
    UNION ALL SELECT 'dim_tiempo', 'sk_tiempo_venta', count(*) FILTER (WHERE fecha IS NULL),
           count(*) FILTER (WHERE fecha NOT IN (SELECT fecha FROM d)) FROM v
    UNION ALL SELECT 'dim_tiempo', 'sk_tiempo_entrega', count(*) FILTER (WHERE fecha_entrega IS NULL),
           count(*) FILTER (WHERE fecha_entrega NOT IN (SELECT fecha FROM d)) FROM v
    UNION ALL SELECT 'dim_canal', 'sk_canal', count(*) FILTER (WHERE id_canal IS NULL),
           count(*) FILTER (WHERE id_canal NOT IN (SELECT id_canal FROM ch)) FROM v""")
def unmatched_lookups(spark, sf):
    sales, dims = loaded_part(spark, sf, "stg_ventas", *_SALES_DIMENSIONS)
    dims["dim_tiempo"] = dims["dim_tiempo"].where(F.col("fecha") <= _SHORT_END)
    return unmatched_report(sales, dims, _SALES_FACT.lookups, _SALES_FACT.key)


@query("""
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
    GROUP BY o_custkey""")
def orphaned_foreign_keys(spark, sf):
    kept = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    return orphaned_keys(table(spark, sf, "orders"), "o_custkey", kept, "c_custkey")


@query(f"""
    SELECT 'telefono' AS "column", 'not_null' AS rule, count(*) FILTER (WHERE telefono IS NULL)
           AS violations FROM {STAGED_SQL["clientes"]} AS c
    UNION ALL SELECT 'edad', 'not_null', count(*) FILTER (WHERE edad IS NULL)
           FROM {STAGED_SQL["clientes"]} AS c
    UNION ALL SELECT 'id_cliente', 'not_null', 0
    UNION ALL SELECT 'provincia', 'max_length_8', count(*) FILTER (WHERE length(rtrim(provincia)) > 8)
           FROM {STAGED_SQL["clientes"]} AS c
    UNION ALL SELECT 'domicilio', 'max_length_200', 0""")
def constraint_violations(spark, sf):
    clients, _ = loaded_part(spark, sf, "stg_clientes")
    required = clients.select("id_cliente", "telefono", "edad").schema
    for field in required:
        field.nullable = False
    return check_constraints(clients, required, {"provincia": 8, "domicilio": 200})


def _examples_sql(column: str, rule: str, broken: str) -> str:
    """The least key breaking a rule in each of three classes by hash, in order."""
    key = "cast(id_cliente AS VARCHAR)"
    least = [
        f"min({key}) FILTER (WHERE ({broken}) AND cast('0x' || substr(md5({key}), 1, 7) AS INTEGER) % 3 = {n})" for n in range(3)
    ]
    return f"""
    SELECT '{column}' AS "column", '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations,
           array_to_string(list_sort(list_filter([{", ".join(least)}], lambda x: x IS NOT NULL)), '; ') AS examples
    FROM {STAGED_SQL["clientes"]} AS c"""


@query(" UNION ALL ".join([
    _examples_sql("telefono", "not_null", "telefono IS NULL"),
    _examples_sql("edad", "not_null", "edad IS NULL"),
    _examples_sql("provincia", "max_length_8", "length(rtrim(provincia)) > 8"),
    _examples_sql("domicilio", "max_length_200", "length(rtrim(domicilio)) > 200"),
]))
def constraint_examples(spark, sf):
    """The rules that rows break, and some of these rows by key."""
    clients, _ = loaded_part(spark, sf, "stg_clientes")
    required = clients.select("telefono", "edad").schema
    for field in required:
        field.nullable = False
    found = check_constraints(clients, required, {"provincia": 8, "domicilio": 200}, ("id_cliente",))
    return found.withColumn("examples", F.array_join("examples", "; "))


@query(f"""
    SELECT c.id_compra, p.sk_producto, s.sk_proveedor, d.sk_tiempo, c.cantidad,
           c.precio AS precio_unitario, cast(c.precio * c.cantidad AS DECIMAL(15,3)) AS monto_total
    FROM {STAGED_SQL["compras"]} AS c
    JOIN {keyed_sql("productos", "id_producto", "sk_producto")} AS p ON c.id_producto = p.id_producto
    JOIN {keyed_sql("proveedores", "id_proveedor", "sk_proveedor")} AS s
         ON c.id_proveedor = s.id_proveedor
    JOIN {CALENDAR_SQL} AS d ON c.fecha = d.fecha""")
def purchases_fact(spark, sf):
    purchases, dims = loaded_part(spark, sf, "stg_compras", "dim_producto", "dim_proveedor", "dim_tiempo")
    return fact_rows(purchases, dims, _PURCHASES_FACT)


@query(f"""
    SELECT g.id_gasto, b.sk_sucursal, d.sk_tiempo, t.sk_tipo_gasto, g.monto
    FROM {STAGED_SQL["gastos"]} AS g
    JOIN {keyed_sql("sucursales", "id_sucursal", "sk_sucursal")} AS b ON g.id_sucursal = b.id_sucursal
    JOIN {CALENDAR_SQL} AS d ON g.fecha = d.fecha
    JOIN {keyed_sql("tipo_gasto", "id_tipo_gasto", "sk_tipo_gasto")} AS t
         ON g.id_tipo_gasto = t.id_tipo_gasto""")
def expenses_fact(spark, sf):
    expenses, dims = loaded_part(spark, sf, "stg_gastos", "dim_sucursal", "dim_tipo_gasto", "dim_tiempo")
    return fact_rows(expenses, dims, _EXPENSES_FACT)
