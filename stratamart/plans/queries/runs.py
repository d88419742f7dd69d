"""Queries that write and read back: feeds, snapshots and whole loads."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators import active, monthly_sales
from stratamart.plans.jobs import (
    UNCHANGED,
    land_feed,
    load_balance,
    load_fact,
    reject_report,
    run_warehouse,
    service_summary,
    stage_entity,
    staging_summary,
)
from stratamart.plans.queries.loaded import (
    load,
    load_twice,
    loaded,
    loaded_twice,
    new_warehouse,
    write_feed,
    write_feed_of,
    write_feeds,
)
from stratamart.plans.queries.merging import _RUN, _T0, _merge_sql
from stratamart.plans.queries.registry import SQL, query, table
from stratamart.plans.queries.reports import _MONTHLY_SQL
from stratamart.plans.queries.roles import CALENDAR_SQL, MODEL, RUN, STAGED_SQL, T0, entity, raw, raw_sql
from stratamart.sources import land, read_feed
from stratamart.sources.shared_folder import fresh_folder
from stratamart.specs import LANDING, SERVICE, STAGING, TRANSFORMATION, FeedSpec

@query(_MONTHLY_SQL)
def retail_monthly_sales(spark, sf):
    """The whole warehouse: land, stage, build the star schema, report sales by month."""
    warehouse, _ = load(spark, sf)
    return monthly_sales(warehouse.read(SERVICE, "fact_ventas"), warehouse.read(SERVICE, "dim_tiempo"))


_SECOND_STAGED = f"(SELECT * FROM {STAGED_SQL['ventas']} AS v WHERE id_canal <> 2)"


@query(_merge_sql(
    f"""SELECT *, {_T0} AS created_at, {_T0} AS updated_at, false AS is_deleted,
               cast(NULL AS TIMESTAMP) AS deleted_at FROM {STAGED_SQL["ventas"]} AS v""",
    f"SELECT * FROM {_SECOND_STAGED} AS s",
    ["id_venta"], ["fecha", "id_cliente", "precio", "cantidad"], _RUN,
))
def retail_second_load(spark, sf):
    """Load everything, then again without the sales of one channel: those are soft-deleted."""
    warehouse, _ = load_twice(spark, sf)
    return warehouse.read(STAGING, "stg_ventas").select(
        "id_venta", "fecha", "id_cliente", "precio", "cantidad",
        "created_at", "updated_at", "is_deleted", "deleted_at",
    )


# Feeds that load_report_with_failures spoils.
_BROKEN = ("raw_gastos", "raw_proveedores")
_STAGED_TABLES = {e.table: e.name for e in MODEL.entities}


@query("\nUNION ALL\n".join(
    [f"SELECT 'land {f.file}' AS step, true AS ok, count(*) AS rows FROM {raw_sql(f.table)} AS r" for f in MODEL.feeds]
    + [
        f"SELECT 'merge {t}' AS step, true AS ok, count(*) AS rows FROM {STAGED_SQL[e]} AS s"
        for t, e in _STAGED_TABLES.items()
    ]
))
def load_report(spark, sf):
    """What a first load reports for its landing and staging steps."""
    _, report = loaded(spark, sf)
    steps = report.to_df(spark).select("step", "ok", "rows")
    return steps.where(F.col("step").startswith("land ") | F.col("step").startswith("merge stg_"))


@query("\nUNION ALL\n".join(
    f"SELECT 'land {f.file}' AS step, {str(f.table not in _BROKEN).lower()} AS ok, "
    + ("cast(0 AS bigint) AS rows" if f.table in _BROKEN else f"count(*) AS rows FROM {raw_sql(f.table)} AS r")
    for f in MODEL.feeds
))
def load_report_with_failures(spark, sf):
    """One feed has a row that is too short, another is missing: these fail, the others are landed."""
    warehouse = new_warehouse(spark, sf)
    folder = write_feeds(spark, sf, {"raw_proveedores": None})
    expenses = next(f for f in MODEL.feeds if f.table == "raw_gastos")
    short = spark.createDataFrame([("idgasto,idsucursal",), ("1,2",)], "value string").coalesce(1)
    short.write.mode("append").text(f"{folder}/{expenses.file}")
    report = run_warehouse(warehouse, MODEL, folder, T0)
    return report.to_df(spark).select("step", "ok", "rows")


# The raw key of each entity, and the rows whose key cannot be used.
_RAW_KEYS = {e.name: e.key_rules()[0].source for e in MODEL.entities}
_REJECTED_SQL = "{key} IS NULL OR NOT regexp_full_match(trim({key}), '[0-9]+')"


@query("\nUNION ALL\n".join(
    f"""SELECT '{e.table}' AS tabla,
               CASE WHEN nullif(trim({_RAW_KEYS[e.name]}), '') IS NULL THEN '{_RAW_KEYS[e.name]} missing'
                    ELSE '{_RAW_KEYS[e.name]} not a whole number' END AS motivo, count(*) AS cantidad
        FROM {raw_sql(e.source)} AS r WHERE {_REJECTED_SQL.format(key=_RAW_KEYS[e.name])} GROUP BY ALL"""
    for e in MODEL.entities
))
def rejected_by_reason(spark, sf):
    """What a first load could not stage, by table and reason."""
    warehouse, _ = loaded(spark, sf)
    return reject_report(warehouse, MODEL.entities)


@query("\nUNION ALL\n".join(
    f"""SELECT '{e.table}' AS tabla, count(*) AS recibidas,
               count(*) FILTER (WHERE NOT ({_REJECTED_SQL.format(key=_RAW_KEYS[e.name])})) AS cargadas,
               count(*) FILTER (WHERE {_REJECTED_SQL.format(key=_RAW_KEYS[e.name])}) AS rechazadas
        FROM {raw_sql(e.source)} AS r"""
    for e in MODEL.entities
))
def landed_staged_rejected(spark, sf):
    """Every landed row is either staged or rejected, as counted in the writes of a first load."""
    warehouse, _ = loaded(spark, sf)
    return load_balance(warehouse, MODEL.entities)


_SPOILED = next(e for e in MODEL.entities if e.name == "gastos")


@query("\nUNION ALL\n".join(
    [
        f"SELECT 'land {f.file}' AS step, true AS ok, count(*) AS rows, {str(f.table == _SPOILED.source).lower()} AS done_again "
        f"FROM {raw_sql(f.table)} AS r" for f in MODEL.feeds
    ] + [
        f"SELECT 'merge {t}', true, count(*), {str(t == _SPOILED.table).lower()} FROM {STAGED_SQL[e]} AS s"
        for t, e in _STAGED_TABLES.items()
    ]
))
def resumed_run(spark, sf):
    """A run fails over one bad amount; with the feed mended it is resumed, and only what failed is done again."""
    warehouse = new_warehouse(spark, sf)
    bad = raw(spark, sf, _SPOILED.source).withColumn("monto", F.lit("ten"))
    folder = write_feeds(spark, sf, {_SPOILED.source: bad})
    failed = run_warehouse(warehouse, MODEL, folder, T0, create_schema=True, create=True).failures()
    if list(failed) != [f"merge {_SPOILED.table}"]:
        raise ValueError(f"one step was to fail: {failed}")
    place, feed = next((i, f) for i, f in enumerate(MODEL.feeds) if f.table == _SPOILED.source)
    write_feed_of(spark, sf, place, feed, folder)
    report = run_warehouse(warehouse, MODEL, folder, T0, create=True, resume=True).to_df(spark)
    steps = report.where(F.col("step").startswith("land ") | F.col("step").startswith("merge stg_"))
    return steps.select("step", "ok", "rows", (F.col("message") != UNCHANGED).alias("done_again"))


def _summary_sql(name: str, key: str, dropped: str, labels, amount: str | None) -> str:
    money = ", cast(sum({0}) AS DECIMAL(38,3)) AS monto_total".format(amount) if amount else ""
    none = ", cast(0 AS DECIMAL(38,3))" if amount else ""
    return f"""
    SELECT '{name}' AS tabla, '{labels.active}' AS descripcion, count(*) AS cantidad{money}
    FROM {STAGED_SQL[name]} AS s WHERE NOT ({dropped})
    UNION ALL SELECT '{name}', '{labels.deleted}', count(*){none} FROM {STAGED_SQL[name]} AS s WHERE {dropped}"""


_SUMMARISED = [e for e in MODEL.entities if e.amount]


@query(" UNION ALL ".join(
    _summary_sql(e.name, e.keys[0], "id_canal = 2" if e.name == "ventas" else "false", e.labels, e.amount)
    for e in _SUMMARISED
))
def summaries_from_commits(spark, sf):
    """Load summaries after a second load that deletes sales, taken from the commits without a scan."""
    warehouse, _ = loaded_twice(spark, sf)
    lines = [staging_summary(warehouse, e).select(F.lit(e.name).alias("tabla"), "*") for e in _SUMMARISED]
    return reduce(DataFrame.unionByName, lines)


@query(" UNION ALL ".join(
    f"""SELECT tabla, total_registros, cast({f.total_label} AS DECIMAL(38,3)) AS total
        FROM ({SQL[name]}) AS t""" for f, name in zip(MODEL.facts, ("sales_totals", "purchase_totals", "expense_totals"), strict=True)
))
def totals_from_commits(spark, sf):
    """Fact totals taken from the commits without a scan."""
    warehouse, _ = loaded(spark, sf)
    totals = [service_summary(warehouse, f).select("tabla", "total_registros", F.col(f.total_label).alias("total")) for f in MODEL.facts]
    return reduce(DataFrame.unionByName, totals)


_BY_ID = replace(entity("empleados"), keys=("id_empleado",))
_DIMENSION_OF = {d.table: next(e.name for e in MODEL.entities if e.table == d.source) for d in MODEL.dimensions}
_FACT_SQL = {"fact_ventas": SQL["star_lookup"], "fact_compras": SQL["purchases_fact"], "fact_gastos": SQL["expenses_fact"]}


@query("\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS tabla, count(*) AS registros, count(*) AS registros_commit FROM {rows} AS r"
    for layer, name, rows in (
        *[(LANDING, f.table, raw_sql(f.table)) for f in MODEL.feeds],
        *[(STAGING, e.table, STAGED_SQL[e.name]) for e in MODEL.entities if e.name != "empleados"],
        *[(TRANSFORMATION, e.table, raw_sql(e.source)) for e in MODEL.entities],
        (STAGING, "stg_empleados", f"(SELECT DISTINCT id_empleado FROM {STAGED_SQL['empleados']} AS s)"),
        *[(SERVICE, table, STAGED_SQL[name]) for table, name in _DIMENSION_OF.items()],
        (SERVICE, MODEL.calendar.table, CALENDAR_SQL),
        *[(SERVICE, name, f"({sql})") for name, sql in _FACT_SQL.items()],
    )
))
def layer_row_counts(spark, sf):
    """Layers reset, tables created and loaded, one rebuilt with another key: listed, and what each holds."""
    warehouse, _ = load(spark, sf)
    warehouse.create(STAGING, _BY_ID.table, _BY_ID.schema())
    stage_entity(warehouse, _BY_ID, RUN, dedupe=("sucursal",))
    listed = {(layer, name): warehouse.read(layer, name) for layer in warehouse.layers() for name in warehouse.tables(layer)}
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("tabla"),
            "registros",
            F.lit(warehouse.count(layer, name)).cast("bigint").alias("registros_commit"),
        )
        for (layer, name), df in listed.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_PATTERNS = {
    "fact_%": [(name, f"({sql})") for name, sql in _FACT_SQL.items()],
    "dim_c%": [(name, STAGED_SQL[entity_name]) for name, entity_name in _DIMENSION_OF.items() if name.startswith("dim_c")],
    "%_tiempo": [(MODEL.calendar.table, CALENDAR_SQL)],
}


@query("\nUNION ALL\n".join(
    f"SELECT '{pattern}' AS patron, '{name}' AS tabla, count(*) AS registros FROM {rows} AS r"
    for pattern, listed in _PATTERNS.items() for name, rows in listed
))
def tables_like(spark, sf):
    """Tables of the service layer whose names are like a pattern, with their rows."""
    warehouse, _ = loaded(spark, sf)
    counts = [
        warehouse.read(SERVICE, name).agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(pattern).alias("patron"), F.lit(name).alias("tabla"), "registros"
        )
        for pattern in _PATTERNS for name in warehouse.tables(SERVICE, like=pattern)
    ]
    return reduce(DataFrame.unionByName, counts)


@query(SQL["star_lookup"])
def fact_load_without_broadcast(spark, sf):
    """The sales fact loaded once more with every dimension taken to be too large to be broadcast."""
    warehouse, _ = load(spark, sf)
    spec = next(f for f in MODEL.facts if f.table == "fact_ventas")
    load_fact(warehouse, spec, RUN, max_broadcast=0)
    return warehouse.read(SERVICE, "fact_ventas").select(spec.key, *[lk.output for lk in spec.lookups], *spec.measures)


_LINE_TEXT = """
    SELECT cast(l_orderkey AS string) AS pedido, cast(l_linenumber AS string) AS linea,
           cast(l_partkey AS string) AS producto, cast(l_suppkey AS string) AS proveedor,
           CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN ''
                ELSE 'said "' || l_linestatus || '"; twice' END AS nota,
           replace(cast(cast(l_extendedprice AS decimal(15,2)) AS string), '.', ',') AS precio
    FROM {lineitem}"""
_LINE_FEED = FeedSpec(
    "lines", "raw_lines", ("pedido", "linea", "producto", "proveedor", "nota", "precio")
)


@query(_LINE_TEXT.format(lineitem="lineitem"))
def feed_roundtrip(spark, sf):
    """Lines written as delimited files, then read back: delimiter sniffed, '' and NULL kept apart."""
    folder = fresh_folder(spark, "feed")
    write_feed(spark.sql(_LINE_TEXT, lineitem=table(spark, sf, "lineitem")), folder)
    return read_feed(spark, folder, _LINE_FEED)


_LATIN_TEXT = """
    SELECT cast(c_custkey AS string) AS id, 'Peña ' || c_name AS nombre,
           'Córdoba' || chr(10) || c_mktsegment AS lugar
    FROM {customer}"""


@query(_LATIN_TEXT.format(customer="customer"))
def feed_latin1_multiline(spark, sf):
    """Another encoding, and quoted fields with line breaks in them."""
    folder = fresh_folder(spark, "feed")
    text = spark.sql(_LATIN_TEXT, customer=table(spark, sf, "customer"))
    write_feed(text, folder, ",", encoding="ISO-8859-1")
    spec = FeedSpec("c", "raw_c", ("id", "nombre", "lugar"), encoding="ISO-8859-1", multiline=True)
    return read_feed(spark, folder, spec)


@query(f"""
    SELECT *, {_T0} AS created_at FROM ({_LINE_TEXT.format(lineitem="lineitem")}) AS a
    UNION ALL SELECT *, {_RUN} AS created_at FROM ({_LINE_TEXT.format(lineitem="lineitem")}) AS b""")
def landing_append(spark, sf):
    """Landing without truncation keeps what was there and adds the new rows with their own time."""
    warehouse = new_warehouse(spark, sf)
    lines = spark.sql(_LINE_TEXT, lineitem=table(spark, sf, "lineitem"))
    land(warehouse, lines, "raw_lines", T0)
    land(warehouse, lines, "raw_lines", RUN, truncate=False)
    return warehouse.read(LANDING, "raw_lines")


@query(f"""
    SELECT *, {_T0} AS created_at FROM ({_LINE_TEXT.format(lineitem="lineitem")}) AS a WHERE linea <> '1'
    UNION ALL SELECT *, {_RUN} AS created_at FROM ({_LINE_TEXT.format(lineitem="lineitem")}) AS b WHERE linea = '1'""")
def landing_append_once(spark, sf):
    """A folder of feed files is landed, repeated, landed with more files in it, and repeated: every file counts once."""
    warehouse, folder = new_warehouse(spark, sf), fresh_folder(spark, "feed")
    lines = spark.sql(_LINE_TEXT, lineitem=table(spark, sf, "lineitem"))
    write_feed(lines.where("linea <> '1'"), folder)
    for run in (T0, RUN):
        land_feed(warehouse, _LINE_FEED, folder, run, truncate=False)
    write_feed(lines.where("linea = '1'"), folder, mode="append")
    for _ in range(2):
        land_feed(warehouse, _LINE_FEED, folder, RUN, truncate=False)
    return warehouse.read(LANDING, _LINE_FEED.table)


@query(f"SELECT *, {_RUN} AS created_at FROM ({_LINE_TEXT.format(lineitem='lineitem')}) AS a")
def landing_truncate(spark, sf):
    """Landing with truncation replaces the previous rows."""
    warehouse = new_warehouse(spark, sf)
    lines = spark.sql(_LINE_TEXT, lineitem=table(spark, sf, "lineitem"))
    land(warehouse, lines, "raw_lines", T0)
    land(warehouse, lines, "raw_lines", RUN)
    return warehouse.read(LANDING, "raw_lines")


@query("""
    SELECT 'before publish' AS moment, count(*) AS rows FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'after publish', count(*) FROM orders""")
def snapshot_publish(spark, sf):
    """A written version stays invisible until it is published."""
    warehouse = new_warehouse(spark, sf)
    orders = table(spark, sf, "orders")
    first = warehouse.write(STAGING, "orders", orders.where("o_orderstatus = 'O'"), ("o_orderkey",))
    warehouse.publish(first)
    second = warehouse.write(STAGING, "orders", orders, ("o_orderkey",))
    before = warehouse.read(STAGING, "orders")
    warehouse.publish(second)
    after = warehouse.read(STAGING, "orders")
    counted = F.count(F.lit(1)).alias("rows")
    return (
        before.agg(counted)
        .select(F.lit("before publish").alias("moment"), "rows")
        .unionByName(after.agg(counted).select(F.lit("after publish").alias("moment"), "rows"))
    )


@query(f"SELECT id_venta, id_cliente, precio FROM {_SECOND_STAGED} AS s")
def active_sales(spark, sf):
    """The rows the service layer sees after a second load: soft-deleted ones are out."""
    warehouse, _ = loaded_twice(spark, sf)
    return active(warehouse.read(STAGING, "stg_ventas")).select("id_venta", "id_cliente", "precio")
