"""Cleaning, key tests and conforming."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.functions import (
    blank_to_null,
    clean_text,
    line_amount,
    to_date_iso,
    to_decimal,
    to_int,
    valid_key,
    with_default,
)
from stratamart.operators import conform, rejected
from stratamart.plans.queries.registry import query, table
from stratamart.plans.queries.roles import STAGED_SQL, entity, raw, raw_sql


@query(f"""
    SELECT trim(idproveedor) AS id, coalesce(trim(nombre), 'Sin Dato') AS nombre,
           nullif(trim(nombre), '') AS nombre_o_nulo, coalesce(trim(country), 'Sin Dato') AS pais
    FROM {raw_sql("raw_proveedores")} AS r""")
def clean_text_defaults(spark, sf):
    r = raw(spark, sf, "raw_proveedores")
    return r.select(
        clean_text(F.col("idproveedor")).alias("id"),
        with_default(clean_text(F.col("nombre")), "Sin Dato").alias("nombre"),
        blank_to_null(F.col("nombre")).alias("nombre_o_nulo"),
        with_default(clean_text(F.col("country")), "Sin Dato").alias("pais"),
    )


_AMOUNTS = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN ' '
                ELSE replace(cast(cast(l_extendedprice AS decimal(15,2))
                     * cast(1 - l_discount AS decimal(5,2)) AS string), '.', ',') END AS neto,
           ' ' || replace(cast(cast(l_discount AS decimal(5,2)) AS string), '.', ',') AS descuento,
           CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL
                ELSE cast(cast(l_quantity AS bigint) AS string) || ' ' END AS cantidad
    FROM {lineitem}"""


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           coalesce(cast(replace(nullif(trim(neto), ''), ',', '.') AS DECIMAL(15,3)), 0) AS neto,
           cast(replace(nullif(trim(descuento), ''), ',', '.') AS DECIMAL(13,10)) AS descuento
    FROM ({_AMOUNTS.format(lineitem="lineitem")}) AS r""")
def clean_decimal_comma(spark, sf):
    r = spark.sql(_AMOUNTS, lineitem=table(spark, sf, "lineitem"))
    return r.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        with_default(to_decimal(F.col("neto"), 15, 3), 0, "decimal(15,3)").alias("neto"),
        to_decimal(F.col("descuento"), 13, 10).alias("descuento"),
    )


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           coalesce(cast(replace(nullif(trim(cantidad), ''), ',', '.') AS INTEGER), 1) AS cantidad,
           cast(coalesce(cast(replace(nullif(trim(neto), ''), ',', '.') AS DECIMAL(15,3)), 0)
                * coalesce(cast(nullif(trim(cantidad), '') AS INTEGER), 1) AS DECIMAL(15,3)) AS monto
    FROM ({_AMOUNTS.format(lineitem="lineitem")}) AS r""")
def clean_whole_quantities(spark, sf):
    r = spark.sql(_AMOUNTS, lineitem=table(spark, sf, "lineitem"))
    quantity = with_default(to_int(F.col("cantidad"), decimal_comma=True), 1)
    price = with_default(to_decimal(F.col("neto"), 15, 3), 0, "decimal(15,3)")
    return r.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        quantity.alias("cantidad"),
        line_amount(price, quantity).alias("monto"),
    )


_DATES = """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '  '
                WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
                WHEN o_orderstatus = 'F'
                    THEN cast(cast(o_orderdate AS date) AS string) || ' 10:11:12 '
                ELSE ' ' || cast(cast(o_orderdate AS date) AS string) END AS fecha,
           CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate AS date) AS string)
                ELSE substr(cast(cast(o_orderdate AS date) AS string), 9, 2) || '/'
                     || substr(cast(cast(o_orderdate AS date) AS string), 6, 2) || '/'
                     || substr(cast(cast(o_orderdate AS date) AS string), 1, 4) END AS fecha_mixta
    FROM {orders}"""


@query(f"""
    SELECT o_orderkey, cast(substr(nullif(trim(fecha), ''), 1, 10) AS DATE) AS fecha,
           CASE WHEN fecha_mixta LIKE '%/%' THEN cast(strptime(fecha_mixta, '%d/%m/%Y') AS DATE)
                ELSE cast(fecha_mixta AS DATE) END AS fecha_mixta
    FROM ({_DATES.format(orders="orders")}) AS r""")
def clean_dates(spark, sf):
    r = spark.sql(_DATES, orders=table(spark, sf, "orders"))
    return r.select(
        "o_orderkey",
        to_date_iso(F.col("fecha")).alias("fecha"),
        to_date_iso(F.col("fecha_mixta"), ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("fecha_mixta"),
    )


@query(f"""
    SELECT cast(trim(idventa) AS BIGINT) AS id_venta
    FROM (SELECT idventa FROM {raw_sql("raw_ventas")} AS r
          WHERE regexp_full_match(trim(idventa), '[0-9]+')) AS ok""")
def valid_key_filter(spark, sf):
    key = F.col("idventa")
    kept = raw(spark, sf, "raw_ventas").where(valid_key(key))
    return kept.select(F.when(valid_key(key), F.trim(key).cast("bigint")).alias("id_venta"))


@query(f"""
    SELECT idventa, fecha, idcliente, idsucursal FROM {raw_sql("raw_ventas")} AS r
    WHERE idventa IS NULL OR NOT regexp_full_match(trim(idventa), '[0-9]+')""")
def rejected_keys(spark, sf):
    r = rejected(raw(spark, sf, "raw_ventas"), entity("ventas"))
    return r.select("idventa", "fecha", "idcliente", "idsucursal")


def _conform(name: str):
    def run(spark, sf):
        spec = entity(name)
        return conform(raw(spark, sf, spec.source), spec)

    return run


def _register(query_name: str, entity_name: str) -> None:
    fn = _conform(entity_name)
    fn.__name__ = query_name
    query(f"SELECT * FROM {STAGED_SQL[entity_name]} AS s")(fn)


# The ten entity specs, each conformed over the whole of its tables.
for _query_name, _entity_name in {
    "conform_orders": "ventas",
    "conform_customers": "clientes",
    "conform_parts": "productos",
    "conform_purchases": "compras",
    "conform_expenses": "gastos",
    "conform_employees": "empleados",
    "conform_branches": "sucursales",
    "conform_suppliers": "proveedores",
    "conform_channels": "canal_venta",
    "conform_expense_types": "tipo_gasto",
}.items():
    _register(_query_name, _entity_name)
