"""Fixed values shared by the warehouse build.

Everything below is data that the results depend on (rule messages, allowed
domains, name tables, classification patterns).  The texts are kept in the
source system's language because reports group by them.
"""

# --- fixed values: row status ------------------------------------------------
VALID = "VALID"
REJECTED = "REJECTED"

# --- fixed values: rule messages (first failing rule wins) -------------------
MSG_SALE_DATE = "Fecha NULL o futura"
MSG_SALE_CUSTOMER = "IdCliente no existe en OLTP"
MSG_SALE_PRODUCT = "IdProducto no existe en OLTP"
MSG_QTY_PRICE = "Cantidad o PrecioUnidad no positivos"
MSG_SALE_STATE = "EstadoVenta no permitido"
MSG_PRODUCT_PRICE = "PrecioVenta menor o igual a PrecioCosto"
MSG_PRODUCT_CODE_NULL = "CodigoProducto NULL"
MSG_PRODUCT_CODE_DUP = "Duplicado por CodigoProducto"
MSG_CUSTOMER_REQUIRED = "Nombre, Apellido o NumeroDocumento NULL"
MSG_CUSTOMER_DOC_TYPE = "TipoDocumento no permitido"
MSG_CUSTOMER_SEGMENT = "Segmento no permitido"
MSG_CUSTOMER_DUP = "Duplicado por TipoDocumento + NumeroDocumento"
MSG_INVENTORY_BALANCE = "Inconsistencia: StockFinal != StockInicial + Entrantes - Salientes"
MSG_INVENTORY_NEGATIVE = "Stock negativo detectado"
MSG_RETURN_BEFORE_SALE = "Fecha devolución anterior a fecha de venta"
MSG_RETURN_TYPE = "TipoDevolucion no permitido"
MSG_PURCHASE_SUPPLIER = "IdProveedor no existe en OLTP"
MSG_GOAL_STORE = "TiendaID no resuelto contra OLTP"
MSG_GOAL_CATEGORY = "Categoría del CSV no mapeada a OLTP"
MSG_GOAL_VALUE = "ValorMeta no positivo o no numérico"
MSG_ADJ_STORE = "TiendaID no existe en OLTP"
MSG_ADJ_PRODUCT = "ProductoID no existe en OLTP"
MSG_ADJ_ZERO = "Ajuste = 0, registro sin impacto analítico"
# divergence: an unparseable return date is rejected instead of
# failing the fact load later
MSG_RETURN_DATE = "Fecha devolución NULL o no válida"

# --- fixed values: allowed domains -------------------------------------------
SALE_STATES = ["Completa", "Cancelada", "Pendiente"]
COMPLETED = "Completa"
DOCUMENT_TYPES = ["CC", "NIT", "CE", "Pasaporte", "TI"]
SEGMENTS = ["Minorista", "Mayorista", "Corporativo", "VIP", "Regular"]
RETURN_TYPES = ["Cliente", "Proveedor"]

# --- fixed values: CSV category name -> catalogue category name --------------
# names not listed pass through unchanged
CATEGORY_NAME_MAP = {
    "Electrónica": "Tecnología",
    "Electrodomésticos": "Electrodomésticos",
    "Automotriz": "Automotriz",
    "Ropa y Moda": "Moda y Calzado",
    "Juguetes y Juegos": "Juguetería",
    "Salud y Cuidado": "Salud y Belleza",
    "Herramientas": "Herramientas",
    "Mascotas": "Mascotas",
    "Alimentos": "Alimentos y Bebidas",
    "Belleza y Cuidado": "Salud y Belleza",
    "Ferretería": "Herramientas",
    "Hogar y Decoración": "Hogar y Cocina",
    "Librería y Papelería": "Libros y Papelería",
}

# --- fixed values: adjustment reason classes, in priority order --------------
# (substring, case-insensitive) -> class; no match -> REASON_OTHER
REASON_PATTERNS = [
    ("merma", "Merma"),
    ("vencimiento", "Vencimiento"),
    ("transferencia", "Transferencia"),
    ("error", "Error Sistema"),
    ("exceso", "Exceso"),
    ("devoluci", "Devolución"),
]
REASON_OTHER = "Otro"
ADJ_POSITIVE = "POSITIVO"
ADJ_NEGATIVE = "NEGATIVO"
ADJ_NEUTRAL = "NEUTRO"

# --- fixed values: calendar names (Monday = 1) -------------------------------
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
MONTH_SHORT_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago",
                     "Sep", "Oct", "Nov", "Dic"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado",
                 "Domingo"]

# --- fixed values: warehouse defaults -----------------------------------------
UNKNOWN_KEY = -1
COUNTRY = "Colombia"
SUPPLIER_REGION = "Colombia"
DEFAULT_CALENDAR_RANGE = ("2024-01-01", "2026-12-31")
DEFAULT_SCD_BASE_DATE = "2024-01-01"

# --- run log states -------------------------------------------------------------
RUNNING = "EN EJECUCION"
SUCCEEDED = "EXITOSO"
FAILED = "FALLIDO"
