"""Merges and surrogate keys.

Source and previous snapshot are cut from one table by attributes such that every row is in at least
one of them and every arm of the merge is taken.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.operators import (
    assign_surrogate_keys,
    change_measures,
    conform,
    duplicate_keys,
    insert_absent,
    latest_per_key,
    merge_soft_delete,
    merge_upsert,
)
from stratamart.operators.calendar import date_dimension_for
from stratamart.plans.queries.registry import query, table
from stratamart.plans.queries.roles import RUN, STAGED_SQL, T0, T1, entity, raw
from stratamart.session import timestamp_literal

_T0, _T1, _RUN = (f"TIMESTAMP '{t}'" for t in (T0, T1, RUN))

_SALES_COLUMNS = ["fecha", "id_cliente", "id_canal", "precio", "cantidad"]
# Sales on channel 1 are new; sales over 400,000 are no longer delivered, except on channel 1;
# those of channel 5 had been deleted before.
_IN_SOURCE = "(precio <= 400000 OR id_canal = 1)"
_IN_TARGET = "(id_canal <> 1)"
_WAS_DELETED = "(id_canal = 5)"


def _sales(spark, sf):
    return conform(raw(spark, sf, "raw_ventas"), entity("ventas"))


def _with_audit(df, deleted):
    gone = F.expr(deleted)
    return df.withColumns(
        {
            "created_at": timestamp_literal(T0),
            "updated_at": F.when(gone, timestamp_literal(T1)).otherwise(timestamp_literal(T0)),
            "is_deleted": gone,
            "deleted_at": F.when(gone, timestamp_literal(T1)),
        }
    )


def _previous_sales(spark, sf):
    old = _sales(spark, sf).where(_IN_TARGET)
    return _with_audit(old.withColumn("cantidad", F.col("cantidad") + 1), _WAS_DELETED)


_OLD_SALES = f"""
    SELECT id_venta, fecha, id_cliente, id_canal, precio, cantidad + 1 AS cantidad,
           {_T0} AS created_at, CASE WHEN {_WAS_DELETED} THEN {_T1} ELSE {_T0} END AS updated_at,
           {_WAS_DELETED} AS is_deleted, CASE WHEN {_WAS_DELETED} THEN {_T1} END AS deleted_at
    FROM {STAGED_SQL["ventas"]} AS v WHERE {_IN_TARGET}"""
_NEW_SALES = f"SELECT * FROM {STAGED_SQL['ventas']} AS v WHERE {_IN_SOURCE}"


def _merge_sql(old: str, new: str, keys: list[str], cols: list[str], run: str = _RUN) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    key = keys[0]
    out = [f"coalesce(s.{k}, t.{k}) AS {k}" for k in keys]
    out += [f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in cols]
    return f"""
        SELECT {", ".join(out)},
               CASE WHEN t.{key} IS NULL THEN {run} ELSE t.created_at END AS created_at,
               CASE WHEN s.{key} IS NOT NULL OR NOT t.is_deleted THEN {run}
                    ELSE t.updated_at END AS updated_at,
               s.{key} IS NULL AS is_deleted,
               CASE WHEN s.{key} IS NOT NULL THEN NULL WHEN t.is_deleted THEN t.deleted_at
                    ELSE {run} END AS deleted_at
        FROM ({old}) AS t FULL JOIN ({new}) AS s ON {on}"""


@query(_merge_sql(_OLD_SALES, _NEW_SALES, ["id_venta"], _SALES_COLUMNS))
def merge_soft_delete_single(spark, sf):
    new = _sales(spark, sf).where(_IN_SOURCE)
    return merge_soft_delete(_previous_sales(spark, sf), new, ["id_venta"], _SALES_COLUMNS, RUN)


@query(f"""
    SELECT count(*) FILTER (WHERE NOT t.is_deleted) AS active_before,
           count(*) FILTER (WHERE NOT t.is_deleted AND s.id_venta IS NULL) AS deleted_now,
           count(*) FILTER (WHERE t.is_deleted AND s.id_venta IS NOT NULL) AS revived_now
    FROM ({_OLD_SALES}) AS t FULL JOIN ({_NEW_SALES}) AS s ON t.id_venta = s.id_venta""")
def merge_changes(spark, sf):
    """What a merge with revivals and deletions changes, as the deletion guard counts it."""
    new = _sales(spark, sf).where(_IN_SOURCE)
    marked = merge_soft_delete(_previous_sales(spark, sf), new, ["id_venta"], _SALES_COLUMNS, RUN, mark=True)
    return marked.agg(*[c.alias(n.replace(" ", "_")) for n, c in change_measures().items()])


_STAFF_KEYS = ["id_empleado", "sucursal"]
_STAFF_COLUMNS = ["apellido", "nombre", "sector", "cargo", "salario"]
_STAFF_SOURCE = "(sector <> 'BUILDING' OR cargo = 'Visitor')"
_STAFF_TARGET = "(cargo <> 'Visitor')"
_STAFF_DELETED = "(salario < 0)"


@query(_merge_sql(
    f"""SELECT id_empleado, sucursal, apellido, 'before' AS nombre, sector, cargo, salario,
               {_T0} AS created_at, CASE WHEN {_STAFF_DELETED} THEN {_T1} ELSE {_T0} END AS updated_at,
               {_STAFF_DELETED} AS is_deleted,
               CASE WHEN {_STAFF_DELETED} THEN {_T1} END AS deleted_at
        FROM {STAGED_SQL["empleados"]} AS e WHERE {_STAFF_TARGET}""",
    f"SELECT * FROM {STAGED_SQL['empleados']} AS e WHERE {_STAFF_SOURCE}",
    _STAFF_KEYS, _STAFF_COLUMNS,
))
def merge_soft_delete_composite(spark, sf):
    staff = conform(raw(spark, sf, "raw_empleados"), entity("empleados"))
    old = staff.where(_STAFF_TARGET).withColumn("nombre", F.lit("before"))
    old = _with_audit(old, _STAFF_DELETED)
    return merge_soft_delete(old, staff.where(_STAFF_SOURCE), _STAFF_KEYS, _STAFF_COLUMNS, RUN)


@query(_merge_sql(
    f"""SELECT id_cliente, 'gone' AS nombre_apellido, provincia, {_T0} AS created_at,
               {_T1} AS updated_at, true AS is_deleted, {_T1} AS deleted_at
        FROM {STAGED_SQL["clientes"]} AS c""",
    f"SELECT * FROM {STAGED_SQL['clientes']} AS c WHERE provincia <> 'BUILDING'",
    ["id_cliente"], ["nombre_apellido", "provincia"],
))
def merge_reactivate(spark, sf):
    clients = conform(raw(spark, sf, "raw_clientes"), entity("clientes"))
    old = _with_audit(clients.withColumn("nombre_apellido", F.lit("gone")), "true")
    back = clients.where("provincia <> 'BUILDING'")
    return merge_soft_delete(old, back, ["id_cliente"], ["nombre_apellido", "provincia"], RUN)


@query(_merge_sql(
    _OLD_SALES, f"SELECT * FROM {STAGED_SQL['ventas']} AS v WHERE false", ["id_venta"], _SALES_COLUMNS
))
def merge_empty_source(spark, sf):
    nothing = _sales(spark, sf).where("false")
    return merge_soft_delete(_previous_sales(spark, sf), nothing, ["id_venta"], _SALES_COLUMNS, RUN)


@query(_merge_sql(
    f"SELECT *, {_T0} AS created_at, {_T0} AS updated_at, false AS is_deleted, "
    f"cast(NULL AS TIMESTAMP) AS deleted_at FROM {STAGED_SQL['ventas']} AS v WHERE false",
    f"SELECT * FROM {STAGED_SQL['ventas']} AS v", ["id_venta"], _SALES_COLUMNS,
))
def merge_first_load(spark, sf):
    sales = _sales(spark, sf)
    return merge_soft_delete(
        _with_audit(sales.where("false"), "false"), sales, ["id_venta"], _SALES_COLUMNS, RUN
    )


@query(_merge_sql(
    _merge_sql(_OLD_SALES, _NEW_SALES, ["id_venta"], _SALES_COLUMNS, _T1),
    _NEW_SALES, ["id_venta"], _SALES_COLUMNS,
))
def merge_repeat_run(spark, sf):
    new = _sales(spark, sf).where(_IN_SOURCE)
    once = merge_soft_delete(_previous_sales(spark, sf), new, ["id_venta"], _SALES_COLUMNS, T1)
    return merge_soft_delete(once, new, ["id_venta"], _SALES_COLUMNS, RUN)


def _upsert_sql(old: str, new: str, key: str, cols: list[str], sk: str) -> str:
    out = [f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in cols]
    return f"""
        WITH t AS ({old}), s AS ({new}),
        fresh AS (SELECT {key}, (SELECT coalesce(max({sk}), 0) FROM t)
                         + row_number() OVER (ORDER BY {key}) AS {sk}
                  FROM s WHERE {key} NOT IN (SELECT {key} FROM t))
        SELECT coalesce(t.{sk}, fresh.{sk}) AS {sk}, coalesce(s.{key}, t.{key}) AS {key},
               {", ".join(out)}, coalesce(t.created_at, {_RUN}) AS created_at,
               CASE WHEN s.{key} IS NOT NULL THEN {_RUN} ELSE t.updated_at END AS updated_at
        FROM t FULL JOIN s ON t.{key} = s.{key} LEFT JOIN fresh ON fresh.{key} = s.{key}"""


def _numbered_before(df, keys, sk):
    """A previous snapshot whose surrogate keys start at 101."""
    stamp = timestamp_literal(T0)
    return assign_surrogate_keys(df, keys, 100, sk).withColumns({"created_at": stamp, "updated_at": stamp})


_PRODUCT_COLUMNS = ["producto", "tipo", "precio"]


@query(_upsert_sql(
    f"""SELECT id_producto, producto, 'old' AS tipo, precio, {_T0} AS created_at, {_T0} AS updated_at,
               100 + row_number() OVER (ORDER BY id_producto) AS sk_producto
        FROM {STAGED_SQL["productos"]} AS p WHERE tipo <> 'ECONOMY'""",
    f"SELECT * FROM {STAGED_SQL['productos']} AS p WHERE tipo <> 'SMALL'",
    "id_producto", _PRODUCT_COLUMNS, "sk_producto",
))
def scd1_upsert(spark, sf):
    parts = conform(raw(spark, sf, "raw_productos"), entity("productos"))
    old = parts.where("tipo <> 'ECONOMY'").withColumn("tipo", F.lit("old"))
    old = _numbered_before(old, ["id_producto"], "sk_producto")
    new = parts.where("tipo <> 'SMALL'")
    return merge_upsert(old, new, ["id_producto"], _PRODUCT_COLUMNS, RUN, "sk_producto")


@query(_upsert_sql(
    f"""SELECT id_venta, id_cliente, id_canal, precio, cantidad + 1 AS cantidad,
               {_T0} AS created_at, {_T0} AS updated_at,
               100 + row_number() OVER (ORDER BY id_venta) AS sk_venta
        FROM {STAGED_SQL["ventas"]} AS v WHERE {_IN_TARGET}""",
    _NEW_SALES, "id_venta", ["id_cliente", "id_canal", "precio", "cantidad"], "sk_venta",
))
def fact_upsert(spark, sf):
    columns = ["id_cliente", "id_canal", "precio", "cantidad"]
    sales = _sales(spark, sf)
    old = sales.where(_IN_TARGET).withColumn("cantidad", F.col("cantidad") + 1)
    old = _numbered_before(old.select("id_venta", *columns), ["id_venta"], "sk_venta")
    return merge_upsert(old, sales.where(_IN_SOURCE), ["id_venta"], columns, RUN, "sk_venta")


_SPAN = "SELECT min(cast(o_orderdate AS DATE)) AS lo, max(cast(o_orderdate AS DATE)) AS hi FROM orders"
_DAYS = f"""(SELECT cast(d AS DATE) AS fecha FROM (SELECT unnest(generate_series(cast(lo AS TIMESTAMP),
             cast(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM ({_SPAN}) AS b) AS g)"""


@query(f"""
    SELECT fecha, 'kept' AS origen FROM (SELECT DISTINCT cast(o_orderdate AS DATE) AS fecha FROM orders
                                         WHERE o_orderpriority = '1-URGENT') AS k
    UNION ALL
    SELECT fecha, 'added' FROM {_DAYS} AS d
    WHERE fecha NOT IN (SELECT cast(o_orderdate AS DATE) FROM orders
                        WHERE o_orderpriority = '1-URGENT')""")
def insert_absent_dates(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("fecha"), "o_orderpriority"
    )
    present = orders.where("o_orderpriority = '1-URGENT'").select("fecha").distinct()
    every = date_dimension_for(orders, F.col("fecha"), F.col("fecha")).select("fecha")
    return insert_absent(
        present.withColumn("origen", F.lit("kept")), every.withColumn("origen", F.lit("added")), ["fecha"]
    )


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders")
def surrogate_keys_initial(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return assign_surrogate_keys(rows, ["o_orderkey"])


@query("""
    WITH old AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders
                 WHERE o_orderstatus <> 'O')
    SELECT * FROM old UNION ALL
    SELECT o_orderkey, (SELECT max(sk) FROM old) + row_number() OVER (ORDER BY o_orderkey)
    FROM orders WHERE o_orderstatus = 'O'""")
def surrogate_keys_incremental(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    old = assign_surrogate_keys(orders.where("o_orderstatus <> 'O'"), ["o_orderkey"])
    newest = old.agg(F.max("sk")).first()[0]
    new = assign_surrogate_keys(orders.where("o_orderstatus = 'O'"), ["o_orderkey"], newest)
    return old.unionByName(new).select("o_orderkey", "sk")


@query(f"""
    SELECT id_empleado, sucursal, cargo, row_number() OVER (ORDER BY id_empleado, sucursal) AS sk
    FROM {STAGED_SQL["empleados"]} AS e""")
def surrogate_keys_composite(spark, sf):
    staff = conform(raw(spark, sf, "raw_empleados"), entity("empleados"))
    return assign_surrogate_keys(
        staff.select("id_empleado", "sucursal", "cargo"), ["id_empleado", "sucursal"]
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n
        FROM lineitem) AS x WHERE n = 1""")
def dedupe_latest(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique_key_violations(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
