"""The driver's tables in the roles of retail feeds.

``RAW`` holds one SELECT per landing table. It turns typed columns into feed text with the usual
flaws: padding, blanks, missing values, decimal commas, leading zeros and unusable keys. Which rows
get which flaw depends on their own attributes. The text is valid in Spark SQL and DuckDB alike and
only prepares input: what is under test is written twice, as DataFrame code and as SQL.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from stratamart.plans.queries.registry import table
from stratamart.plans.retail import RETAIL, with_wide_ids
from stratamart.specs import CalendarSpec, EntitySpec, WarehouseModel

T0 = dt.datetime(2024, 6, 1, 6, 0, 0)
T1 = dt.datetime(2024, 6, 2, 6, 0, 0)
RUN = dt.datetime(2024, 6, 3, 6, 0, 0)

MODEL: WarehouseModel = replace(
    with_wide_ids(RETAIL), calendar=CalendarSpec("dim_tiempo", "sk_tiempo", "1995-01-01", "2025-12-31")
)


def entity(name: str) -> EntitySpec:
    return next(e for e in MODEL.entities if e.name == name)


RAW = {
    "raw_clientes": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' || cast(c_custkey AS string) || '  '
                    WHEN c_mktsegment = 'MACHINERY' THEN '00' || cast(c_custkey AS string)
                    ELSE cast(c_custkey AS string) END AS id,
               CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 5 THEN '   '
                    ELSE '  ' || c_mktsegment || ' ' END AS provincia,
               CASE WHEN c_nationkey = 4 THEN '' ELSE c_name END AS nombre_y_apellido,
               CASE WHEN c_nationkey = 7 THEN NULL ELSE 'Street ' || cast(c_nationkey AS string) END
                   AS domicilio,
               CASE WHEN c_nationkey = 8 THEN NULL ELSE ' 555-' || cast(c_custkey AS string) END
                   AS telefono,
               CASE WHEN c_nationkey = 9 THEN '  ' ELSE cast(20 + c_nationkey AS string) END AS edad,
               CASE WHEN c_nationkey = 10 THEN NULL ELSE 'City' END AS localidad,
               CASE WHEN c_nationkey = 11 THEN NULL
                    ELSE '-5' || cast(c_nationkey AS string) || ',320500' END AS x,
               '-3' || cast(c_nationkey AS string) || ',25' AS y,
               CASE WHEN c_nationkey = 12 THEN '' ELSE '2018-03-09' END AS fecha_alta,
               'u' AS usuario_alta,
               CASE WHEN c_nationkey = 13 THEN NULL ELSE ' 2019-04-10 ' END
                   AS fecha_ultima_modificacion,
               'u' AS usuario_ultima_modificacion,
               CASE WHEN c_nationkey = 14 THEN '1' END AS marca_baja,
               cast(NULL AS string) AS col10
        FROM {customer}""",
    "raw_ventas": """
        SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ' ' || cast(o_orderkey AS string) || ' '
                    WHEN o_orderpriority = '1-URGENT' THEN '0' || cast(o_orderkey AS string)
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AND c_nationkey = 1
                        THEN '-' || cast(o_orderkey AS string)
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AND c_nationkey = 2
                        THEN cast(o_orderkey AS string) || 'x'
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AND c_nationkey = 3
                        THEN '  '
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AND c_nationkey = 4
                        THEN NULL
                    ELSE cast(o_orderkey AS string) END AS idventa,
               CASE WHEN c_nationkey = 5 THEN ' ' || cast(cast(o_orderdate AS date) AS string)
                    ELSE cast(cast(o_orderdate AS date) AS string) END AS fecha,
               cast(cast(o_orderdate AS date) + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 9 END
                    AS string) AS fecha_entrega,
               substr(o_orderpriority, 1, 1) AS idcanal,
               CASE WHEN o_orderstatus = 'P' AND c_nationkey = 6 THEN ' '
                    ELSE cast(o_custkey AS string) END AS idcliente,
               CASE WHEN c_nationkey = 7 AND o_orderstatus = 'F' THEN '9999'
                    ELSE cast(c_nationkey AS string) END AS idsucursal,
               CASE WHEN o_orderstatus = 'O' AND c_nationkey = 8 THEN NULL
                    ELSE cast(o_custkey AS string) END AS idempleado,
               cast(partkey AS string) AS idproducto,
               CASE WHEN c_nationkey = 9 AND o_orderstatus = 'F' THEN ''
                    ELSE replace(cast(cast(o_totalprice AS decimal(15,2)) AS string), '.', ',') END
                   AS precio,
               CASE WHEN c_nationkey = 10 THEN NULL ELSE cast(qty AS string) END AS cantidad
        FROM {orders}
        JOIN {customer} ON c_custkey = o_custkey
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS partkey,
                          cast(sum(l_quantity) AS bigint) AS qty
                   FROM {lineitem} GROUP BY l_orderkey) AS lines ON l_orderkey = o_orderkey""",
    "raw_productos": """
        SELECT cast(p_partkey AS string) AS id_producto, ' ' || p_name AS concepto,
               CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '' ELSE p_type END AS tipo,
               replace(cast(cast(p_retailprice AS decimal(15,2)) AS string), '.', ',') AS precio
        FROM {part}""",
    "raw_compras": """
        SELECT cast(l_orderkey AS string) AS idcompra,
               cast(cast(min(l_shipdate) AS date) AS string) AS fecha,
               cast(max(l_partkey) AS string) AS idproducto,
               cast(cast(sum(l_quantity) AS bigint) AS string) AS cantidad,
               cast(cast(max(l_extendedprice) AS decimal(15,2)) AS string) AS precio,
               cast(max(l_suppkey) AS string) AS idproveedor
        FROM {lineitem} GROUP BY l_orderkey""",
    "raw_gastos": """
        SELECT cast(event_id AS string) AS idgasto, cast(c_nationkey AS string) AS idsucursal,
               CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '3'
                               WHEN 'signup' THEN '4' ELSE '5' END AS idtipogasto,
               cast(cast(ts AS date) AS string) AS fecha,
               CASE WHEN event_type = 'error' AND c_nationkey = 1 THEN ' '
                    ELSE replace(cast(cast(value AS decimal(15,2)) AS string), '.', ',') END AS monto
        FROM {events} JOIN {customer} ON c_custkey = user_id""",
    "raw_empleados": """
        SELECT cast(c_custkey AS string) AS id_empleado, c_name AS apellido,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE ' ' || c_name END AS nombre,
               CASE WHEN n_nationkey = 11 THEN n_name || '_old' WHEN n_nationkey = 12 THEN NULL
                    ELSE ' ' || n_name END AS sucursal,
               c_mktsegment AS sector, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'Seller ' END
                   AS cargo,
               replace(cast(cast(c_acctbal AS decimal(15,2)) AS string), '.', ',') AS salario
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        UNION ALL
        SELECT cast(c_custkey AS string), c_name, c_name, r_name, c_mktsegment, 'Visitor', NULL
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        JOIN {region} ON r_regionkey = n_regionkey""",
    "raw_sucursales": """
        SELECT cast(n_nationkey AS string) AS id, n_name AS sucursal,
               CASE WHEN n_regionkey = 1 THEN NULL ELSE 'Main ' || n_name END AS direccion,
               'City ' AS localidad, r_name AS provincia,
               '-3' || cast(n_nationkey AS string) || ',5' AS latitud,
               CASE WHEN n_regionkey = 2 THEN '' ELSE '-61,2300000' END AS longitud
        FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    "raw_proveedores": """
        SELECT cast(s_suppkey AS string) AS idproveedor,
               CASE WHEN s_nationkey = 1 THEN NULL WHEN s_nationkey = 2 THEN ' '
                    ELSE ' ' || s_name || '  ' END AS nombre,
               'Dock' AS address, n_name AS city, r_name AS state,
               CASE WHEN n_regionkey = 3 THEN NULL ELSE 'ARGENTINA' END AS country,
               n_name AS departamen
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
        JOIN {region} ON r_regionkey = n_regionkey""",
    "raw_canal_venta": """
        SELECT substr(o_orderpriority, 1, 1) AS codigo,
               ' ' || substr(max(o_orderpriority), 3) AS descripcion
        FROM {orders} GROUP BY substr(o_orderpriority, 1, 1)""",
    "raw_tipo_gasto": """
        SELECT CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '3'
                               WHEN 'signup' THEN '4' ELSE '5' END AS idtipogasto,
               event_type AS descripcion,
               cast(cast(max(value) AS decimal(15,2)) AS string) AS monto_aproximado
        FROM {events} GROUP BY event_type""",
}

_TABLES = re.compile(r"\{(\w+)\}")


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A landing table's rows as a DataFrame."""
    text = RAW[name]
    return spark.sql(text, **{t: table(spark, folder, t) for t in set(_TABLES.findall(text))})


def raw_sql(name: str) -> str:
    """The same as a sub-select for the SQL side."""
    return "(" + _TABLES.sub(r"\1", RAW[name]) + ")"


# Typed staging rows in plain SQL, written from the cleaning rules and not from the specs.
_KEY = "regexp_full_match(trim({0}), '[0-9]+')"


def _text(c: str) -> str:
    return f"coalesce(trim({c}), 'Sin Dato')"


def _int(c: str) -> str:
    return f"cast(nullif(trim({c}), '') AS INTEGER)"


def _long(c: str) -> str:
    return f"cast(nullif(trim({c}), '') AS BIGINT)"


def _dec(c: str, p: int, s: int) -> str:
    return f"coalesce(cast(replace(nullif(trim({c}), ''), ',', '.') AS DECIMAL({p},{s})), 0)"


def _date(c: str) -> str:
    return f"cast(nullif(trim({c}), '') AS DATE)"


def _select(source: str, key: str, columns: dict[str, str]) -> str:
    # The key test is a CTE of its own so that casts only ever see usable keys.
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    usable = f"SELECT * FROM {raw_sql(source)} AS r WHERE {_KEY.format(key)}"
    return f"(SELECT {listed} FROM ({usable}) AS usable)"


STAGED_SQL = {
    "clientes": _select("raw_clientes", "id", {
        "id_cliente": _long("id"), "provincia": _text("provincia"),
        "nombre_apellido": _text("nombre_y_apellido"), "domicilio": _text("domicilio"),
        "telefono": "trim(telefono)", "edad": _int("edad"), "localidad": _text("localidad"),
        "latitud": _dec("y", 13, 10), "longitud": _dec("x", 13, 10),
        "fecha_alta": _date("fecha_alta"),
        "fecha_ultima_modificacion": _date("fecha_ultima_modificacion"),
        "marca_baja": f"coalesce({_int('marca_baja')}, 0)",
    }),
    "ventas": _select("raw_ventas", "idventa", {
        "id_venta": _long("idventa"), "fecha": _date("fecha"), "fecha_entrega": _date("fecha_entrega"),
        "id_canal": _long("idcanal"), "id_cliente": _long("idcliente"),
        "id_sucursal": _long("idsucursal"), "id_empleado": _long("idempleado"),
        "id_producto": _long("idproducto"), "precio": _dec("precio", 15, 3),
        "cantidad": "coalesce(cast(replace(nullif(trim(cantidad), ''), ',', '.') AS INTEGER), 1)",
    }),
    "productos": _select("raw_productos", "id_producto", {
        "id_producto": _long("id_producto"), "producto": _text("concepto"), "tipo": _text("tipo"),
        "precio": _dec("precio", 15, 3),
    }),
    "compras": _select("raw_compras", "idcompra", {
        "id_compra": _long("idcompra"), "fecha": _date("fecha"), "id_producto": _long("idproducto"),
        "cantidad": _int("cantidad"), "precio": _dec("precio", 15, 3),
        "id_proveedor": _long("idproveedor"),
    }),
    "gastos": _select("raw_gastos", "idgasto", {
        "id_gasto": _long("idgasto"), "id_sucursal": _long("idsucursal"),
        "id_tipo_gasto": _long("idtipogasto"), "fecha": _date("fecha"), "monto": _dec("monto", 15, 2),
    }),
    "empleados": _select("raw_empleados", "id_empleado", {
        "id_empleado": _long("id_empleado"), "apellido": _text("apellido"), "nombre": _text("nombre"),
        "sucursal": _text("sucursal"), "sector": _text("sector"), "cargo": _text("cargo"),
        "salario": _dec("salario", 15, 2),
    }),
    "sucursales": _select("raw_sucursales", "id", {
        "id_sucursal": _long("id"), "sucursal": _text("sucursal"), "domicilio": _text("direccion"),
        "localidad": _text("localidad"), "provincia": _text("provincia"),
        "latitud": _dec("latitud", 13, 10), "longitud": _dec("longitud", 13, 10),
    }),
    "proveedores": _select("raw_proveedores", "idproveedor", {
        "id_proveedor": _long("idproveedor"), "nombre": _text("nombre"), "domicilio": _text("address"),
        "ciudad": _text("city"), "provincia": _text("state"), "pais": _text("country"),
        "departamento": _text("departamen"),
    }),
    "canal_venta": _select("raw_canal_venta", "codigo", {
        "id_canal": _long("codigo"), "canal": _text("descripcion"),
    }),
    "tipo_gasto": _select("raw_tipo_gasto", "idtipogasto", {
        "id_tipo_gasto": _long("idtipogasto"), "descripcion": _text("descripcion"),
        "monto_aproximado": _dec("monto_aproximado", 15, 2),
    }),
}

# The calendar of MODEL with keys in date order.
CALENDAR_SQL = """(SELECT row_number() OVER (ORDER BY d) AS sk_tiempo, cast(d AS DATE) AS fecha,
    cast(year(d) AS INTEGER) AS anio, cast(month(d) AS INTEGER) AS mes, monthname(d) AS mes_nombre
    FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2025-12-31', INTERVAL 1 DAY) AS g(d))"""


def keyed_sql(name: str, key: str, surrogate: str) -> str:
    """A dimension on first load: staged rows numbered in key order."""
    return f"(SELECT *, row_number() OVER (ORDER BY {key}) AS {surrogate} FROM {STAGED_SQL[name]} AS s)"
