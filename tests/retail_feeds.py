"""A small set of hand-written retail feeds with the quirks real ones have."""

CLIENTES = """id;provincia;nombre_y_apellido;domicilio;telefono;edad;localidad;x;y;fecha_alta;ua;fm;um;marca_baja;col10
1;Buenos Aires; Ana Paz ;Calle 1;111;30;La Plata;-58,1;-34,9;2018-01-02;u;2018-02-03;u;0;
2;;"";   ;;;;;;;;;;;
007;Cordoba;Luis;;222;41;Cordoba;-64,18;-31,42;2019-05-06;u;;;1;z
-3;Salta;Negativo;;;;;;;;;;;;
x9;Salta;Letra;;;;;;;;;;;;
"""
VENTA = """IdVenta,Fecha,Fecha_Entrega,IdCanal,IdCliente,IdSucursal,IdEmpleado,IdProducto,Precio,Cantidad
1,2018-03-09,2018-03-10,1,1,1,100,10,"10,5",2
2,2018-03-09,2018-03-12,2,2,2,100,10,20.25,
3,2018-04-01,2018-04-02,1,7,1,101,11,,3
4,2018-04-01,2018-04-02,1,99,1,101,11,5,3
5,2031-01-01,2031-01-02,1,1,1,100,10,5,1
6,2018-04-05,2018-04-06,1,1,2,,10,7,1
"""
PRODUCTOS = """ID_PRODUCTO,Concepto,Tipo,Precio\r
10,Mouse ,INFORMATICA,9.99\r
11,"Cable, largo",,0.00\r
"""
COMPRA = """IdCompra,Fecha,IdProducto,Cantidad,Precio,IdProveedor
1,2018-01-05,10,5,4.5,1
2,2018-01-06,11,7,1.125,2
"""
GASTO = """IdGasto,IdSucursal,IdTipoGasto,Fecha,Monto
1,1,1,2018-01-31,1000.50
2,2,2,2018-02-28,"300,25"
"""
EMPLEADOS = "﻿" + """ID_empleado,Apellido,Nombre,Sucursal,Sector,Cargo,Salario
100,Paz,Ana,Centro,Ventas,Vendedor ,32000.00
100,Paz,Ana,Norte,Ventas,Vendedor,32000.00
101,Rey,Luis,Otra,Ventas,Vendedor,30000
"""
SUCURSALES = """ID;Sucursal;Direccion;Localidad;Provincia;Latitud;Longitud
1;Centro;Av. 1;CABA;CABA;-31,1200000;-61,2300000
2;Norte;Av. 2;Tigre;Bs.As. ;-34,4;-58,5
"""
PROVEEDORES = """IDProveedor,Nombre,Address,City,State,Country,departamen
1,,MUELLE 7,PUERTO,LITORAL,ARGENTINA,PUERTO
2,Norte SA,DIQUE 12,RIBERA,LITORAL,ARGENTINA,RIBERA
"""
CANALES = """CODIGO,DESCRIPCION
1,Mostrador ñandú
2,Catálogo
"""
TIPOS = """IdTipoGasto,Descripcion,Monto_Aproximado
1,"Limpieza",800
2,"Seguros",250
"""

FILES = {
    "Clientes.csv": CLIENTES,
    "Venta.csv": VENTA,
    "Productos.csv": PRODUCTOS,
    "Compra.csv": COMPRA,
    "Gasto.csv": GASTO,
    "Empleados.csv": EMPLEADOS,
    "Sucursales.csv": SUCURSALES,
    "Proveedores.csv": PROVEEDORES,
    "CanalDeVenta.csv": CANALES,
    "TiposDeGasto.csv": TIPOS,
}


def write_feeds(folder, **changed):
    """Write all feeds; ``changed`` replaces the text of a feed (by file name without .csv)."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in FILES.items():
        content = changed.get(name.removesuffix(".csv"), content)
        if content is not None:
            (folder / name).write_bytes(content.encode())
    return str(folder)
