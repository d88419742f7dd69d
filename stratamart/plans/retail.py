"""The retail warehouse: ten feeds, ten staging tables, eight dimensions, three facts."""

from __future__ import annotations

from dataclasses import replace

from stratamart.specs import (
    CalendarSpec,
    DimensionSpec,
    DimLookup,
    EntitySpec,
    FactSpec,
    FeedSpec,
    SummaryLabels,
    WarehouseModel,
    date,
    decimal,
    integer,
    text,
)

# Feed files, table and column names, types, lengths, defaults and summary labels are
# the data contract of this warehouse.
NO_DATA = "Sin Dato"


def _label(name: str, size: int, source: str | None = None):
    """Text that is never NULL."""
    return text(name, size, default=NO_DATA, source=source)


FEEDS = (
    FeedSpec(
        "Clientes.csv",
        "raw_clientes",
        (
            "id", "provincia", "nombre_y_apellido", "domicilio", "telefono", "edad", "localidad",
            "x", "y", "fecha_alta", "usuario_alta", "fecha_ultima_modificacion",
            "usuario_ultima_modificacion", "marca_baja", "col10",
        ),
        delimiter=";",
    ),
    FeedSpec(
        "Venta.csv",
        "raw_ventas",
        (
            "idventa", "fecha", "fecha_entrega", "idcanal", "idcliente", "idsucursal",
            "idempleado", "idproducto", "precio", "cantidad",
        ),
    ),
    FeedSpec("Productos.csv", "raw_productos", ("id_producto", "concepto", "tipo", "precio")),
    FeedSpec(
        "Compra.csv",
        "raw_compras",
        ("idcompra", "fecha", "idproducto", "cantidad", "precio", "idproveedor"),
    ),
    FeedSpec("Gasto.csv", "raw_gastos", ("idgasto", "idsucursal", "idtipogasto", "fecha", "monto")),
    FeedSpec(
        "Empleados.csv",
        "raw_empleados",
        ("id_empleado", "apellido", "nombre", "sucursal", "sector", "cargo", "salario"),
    ),
    FeedSpec(
        "Sucursales.csv",
        "raw_sucursales",
        ("id", "sucursal", "direccion", "localidad", "provincia", "latitud", "longitud"),
        delimiter=";",
    ),
    FeedSpec(
        "Proveedores.csv",
        "raw_proveedores",
        ("idproveedor", "nombre", "address", "city", "state", "country", "departamen"),
    ),
    FeedSpec("CanalDeVenta.csv", "raw_canal_venta", ("codigo", "descripcion")),
    FeedSpec("TiposDeGasto.csv", "raw_tipo_gasto", ("idtipogasto", "descripcion", "monto_aproximado")),
)

CLIENTES = EntitySpec(
    "clientes", "raw_clientes", "stg_clientes", ("id_cliente",),
    (
        integer("id_cliente", source="id"),
        _label("provincia", 50),
        _label("nombre_apellido", 150, "nombre_y_apellido"),
        _label("domicilio", 200),
        text("telefono", 30),
        integer("edad"),
        _label("localidad", 80),
        decimal("latitud", 13, 10, default=0, source="y"),
        decimal("longitud", 13, 10, default=0, source="x"),
        date("fecha_alta"),
        date("fecha_ultima_modificacion"),
        integer("marca_baja", default=0),
    ),
    SummaryLabels("Clientes Activos", "Clientes Eliminados (Soft Delete)"),
)

VENTAS = EntitySpec(
    "ventas", "raw_ventas", "stg_ventas", ("id_venta",),
    (
        integer("id_venta", source="idventa"),
        date("fecha", nullable=False),
        date("fecha_entrega", nullable=False),
        integer("id_canal", source="idcanal"),
        integer("id_cliente", source="idcliente"),
        integer("id_sucursal", source="idsucursal"),
        integer("id_empleado", source="idempleado"),
        integer("id_producto", source="idproducto"),
        decimal("precio", 15, 3, default=0),
        integer("cantidad", default=1, decimal_comma=True),
    ),
    SummaryLabels("Ventas Activas", "Ventas Eliminadas (Soft Delete)"),
    amount="precio * cantidad",
)

PRODUCTOS = EntitySpec(
    "productos", "raw_productos", "stg_productos", ("id_producto",),
    (
        integer("id_producto"),
        _label("producto", 150, "concepto"),
        _label("tipo", 50),
        decimal("precio", 15, 3, default=0),
    ),
)

COMPRAS = EntitySpec(
    "compras", "raw_compras", "stg_compras", ("id_compra",),
    (
        integer("id_compra", source="idcompra"),
        date("fecha", nullable=False),
        integer("id_producto", source="idproducto"),
        integer("cantidad"),
        decimal("precio", 15, 3, default=0),
        integer("id_proveedor", source="idproveedor"),
    ),
    SummaryLabels("Compras Activas", "Compras Eliminadas (Soft Delete)"),
    amount="precio * cantidad",
)

GASTOS = EntitySpec(
    "gastos", "raw_gastos", "stg_gastos", ("id_gasto",),
    (
        integer("id_gasto", source="idgasto"),
        integer("id_sucursal", source="idsucursal"),
        integer("id_tipo_gasto", source="idtipogasto"),
        date("fecha", nullable=False),
        decimal("monto", 15, 2, default=0),
    ),
    SummaryLabels("Gastos Activos", "Gastos Eliminados"),
    amount="monto",
)

EMPLEADOS = EntitySpec(
    "empleados", "raw_empleados", "stg_empleados", ("id_empleado", "sucursal"),
    (
        integer("id_empleado"),
        _label("apellido", 100),
        _label("nombre", 100),
        _label("sucursal", 80),
        _label("sector", 50),
        _label("cargo", 50),
        decimal("salario", 15, 2, default=0),
    ),
    SummaryLabels("Empleados Activos", "Empleados Eliminados"),
)

SUCURSALES = EntitySpec(
    "sucursales", "raw_sucursales", "stg_sucursales", ("id_sucursal",),
    (
        integer("id_sucursal", source="id"),
        _label("sucursal", 80),
        _label("domicilio", 200, "direccion"),
        _label("localidad", 80),
        _label("provincia", 50),
        decimal("latitud", 13, 10, default=0),
        decimal("longitud", 13, 10, default=0),
    ),
    SummaryLabels("Sucursales Activas", "Sucursales Eliminadas"),
)

PROVEEDORES = EntitySpec(
    "proveedores", "raw_proveedores", "stg_proveedores", ("id_proveedor",),
    (
        integer("id_proveedor", source="idproveedor"),
        _label("nombre", 150),
        _label("domicilio", 200, "address"),
        _label("ciudad", 80, "city"),
        _label("provincia", 50, "state"),
        _label("pais", 50, "country"),
        _label("departamento", 80, "departamen"),
    ),
    SummaryLabels("Proveedores Activos", "Proveedores Eliminados"),
)

CANAL_VENTA = EntitySpec(
    "canal_venta", "raw_canal_venta", "stg_canal_venta", ("id_canal",),
    (integer("id_canal", source="codigo"), _label("canal", 50, "descripcion")),
    SummaryLabels("Canales Activos", "Canales Eliminados"),
)

TIPO_GASTO = EntitySpec(
    "tipo_gasto", "raw_tipo_gasto", "stg_tipo_gasto", ("id_tipo_gasto",),
    (
        integer("id_tipo_gasto", source="idtipogasto"),
        _label("descripcion", 150),
        decimal("monto_aproximado", 15, 2, default=0),
    ),
    SummaryLabels("Tipos de Gasto Activos", "Tipos de Gasto Eliminados"),
)

# Small reference tables first, transactions last.
ENTITIES = (
    CANAL_VENTA, TIPO_GASTO, SUCURSALES, PROVEEDORES, PRODUCTOS,
    CLIENTES, EMPLEADOS, VENTAS, COMPRAS, GASTOS,
)

CALENDAR = CalendarSpec("dim_tiempo", "sk_tiempo", "2015-01-01", "2025-12-31")


def _dimension(table, entity, surrogate, attributes, renamed=None) -> DimensionSpec:
    """Types and lengths follow from the staging columns the attributes are copied from."""
    origin = {name: (renamed or {}).get(name, name) for name in attributes}
    rules = {name: entity.rule(source) for name, source in origin.items()}
    rules |= {key: entity.rule(key) for key in entity.keys}
    return DimensionSpec(
        table,
        entity.table,
        surrogate,
        entity.keys,
        origin,
        {name: rule.data_type for name, rule in rules.items()},
        {name: rule.max_length for name, rule in rules.items() if rule.max_length},
    )


DIMENSIONS = (
    _dimension(
        "dim_cliente", CLIENTES, "sk_cliente",
        (
            "nombre_apellido", "provincia", "localidad", "domicilio", "telefono", "edad",
            "latitud", "longitud",
        ),
    ),
    _dimension(
        "dim_producto", PRODUCTOS, "sk_producto", ("producto", "tipo_producto", "precio_lista"),
        {"tipo_producto": "tipo", "precio_lista": "precio"},
    ),
    _dimension(
        "dim_sucursal", SUCURSALES, "sk_sucursal",
        ("sucursal", "domicilio", "localidad", "provincia", "latitud", "longitud"),
    ),
    _dimension(
        "dim_empleado", EMPLEADOS, "sk_empleado",
        ("apellido", "nombre", "sector", "cargo", "salario"),
    ),
    _dimension(
        "dim_proveedor", PROVEEDORES, "sk_proveedor",
        ("nombre", "domicilio", "ciudad", "provincia", "pais"),
    ),
    _dimension("dim_canal", CANAL_VENTA, "sk_canal", ("canal",)),
    _dimension("dim_tipo_gasto", TIPO_GASTO, "sk_tipo_gasto", ("descripcion", "monto_aproximado")),
)


def _by_id(dimension: str, entity: str, output: str | None = None, carry: tuple[str, ...] = ()):
    key, surrogate = f"id_{entity}", f"sk_{entity}"
    return DimLookup(dimension, ((key, key),), surrogate, output or surrogate, carry=carry)


def _by_day(column: str, output: str) -> DimLookup:
    return DimLookup("dim_tiempo", ((column, "fecha"),), "sk_tiempo", output)


FACT_VENTAS = FactSpec(
    "fact_ventas", "stg_ventas", "sk_venta", "id_venta",
    (
        _by_id("dim_cliente", "cliente"),
        _by_id("dim_producto", "producto"),
        _by_id("dim_sucursal", "sucursal", carry=("sucursal",)),
        # An employee is known per branch, so the branch name found above is part of the key.
        DimLookup(
            "dim_empleado",
            (("id_empleado", "id_empleado"), ("sucursal", "sucursal")),
            "sk_empleado", "sk_empleado", how="left",
        ),
        _by_day("fecha", "sk_tiempo_venta"),
        _by_day("fecha_entrega", "sk_tiempo_entrega"),
        _by_id("dim_canal", "canal"),
    ),
    {"cantidad": "cantidad", "precio_unitario": "precio", "monto_total": "precio * cantidad"},
    {
        "id_venta": "int", "cantidad": "int",
        "precio_unitario": "decimal(15,3)", "monto_total": "decimal(15,3)",
    },
    total="monto_total", total_label="monto_total_ventas", date_range="sk_tiempo_venta",
)

FACT_COMPRAS = FactSpec(
    "fact_compras", "stg_compras", "sk_compra", "id_compra",
    (
        _by_id("dim_producto", "producto"),
        _by_id("dim_proveedor", "proveedor"),
        _by_day("fecha", "sk_tiempo"),
    ),
    {"cantidad": "cantidad", "precio_unitario": "precio", "monto_total": "precio * cantidad"},
    {
        "id_compra": "int", "cantidad": "int",
        "precio_unitario": "decimal(15,3)", "monto_total": "decimal(15,3)",
    },
    total="monto_total", total_label="monto_total_compras",
)

FACT_GASTOS = FactSpec(
    "fact_gastos", "stg_gastos", "sk_gasto", "id_gasto",
    (
        _by_id("dim_sucursal", "sucursal"),
        _by_day("fecha", "sk_tiempo"),
        _by_id("dim_tipo_gasto", "tipo_gasto"),
    ),
    {"monto": "monto"},
    {"id_gasto": "int", "monto": "decimal(15,2)"},
    total="monto", total_label="monto_total_gastos",
)

FACTS = (FACT_VENTAS, FACT_COMPRAS, FACT_GASTOS)

RETAIL = WarehouseModel(FEEDS, ENTITIES, CALENDAR, DIMENSIONS, FACTS)


def with_wide_ids(model: WarehouseModel) -> WarehouseModel:
    """The same model with 64-bit natural ids, for volumes beyond two thousand million rows."""

    def is_id(name: str, data_type: str) -> bool:
        return name.startswith("id_") and data_type == "int"

    def widened(types):
        return {n: "bigint" if is_id(n, t) else t for n, t in types.items()}

    def wide_rule(rule):
        return replace(rule, data_type="bigint") if is_id(rule.name, rule.data_type) else rule

    return replace(
        model,
        entities=tuple(replace(e, columns=tuple(map(wide_rule, e.columns))) for e in model.entities),
        dimensions=tuple(replace(d, types=widened(d.types)) for d in model.dimensions),
        facts=tuple(replace(f, types=widened(f.types)) for f in model.facts),
    )
