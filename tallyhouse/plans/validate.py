"""Quality rules per staging table (R1-R28) and the opt-in rules.

Each ``validate_*`` returns the staging rows with ``stg_status`` and
``stg_message``; rules run in the listed order and the first failing rule
wins.  Reference-existence rules take the operational table as ``ref``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.functions.dates import parse_date
from tallyhouse.functions.text import classify_contains, clean_trim, folded, map_values
from tallyhouse.operators.lookup import resolve
from tallyhouse.operators.rules import Dedup, Derive, Rule, apply_rules, judged, missing_ref, ref_flag, settle
from tallyhouse.plans.extracts import MISSING, join_purchase_lines, join_sale_lines, purchase_headers, sale_headers


MSG_CSV_MALFORMED = "Fila CSV con formato no válido"
RAW_LINE = "stg_raw"


def _malformed(stg: DataFrame) -> list[Rule]:
    """Rejects rows whose raw CSV line was kept because a field did not parse."""
    return [Rule(MSG_CSV_MALFORMED, F.col(RAW_LINE).isNotNull())] if RAW_LINE in stg.columns else []


def _marked(stg: DataFrame, side: str, message: str) -> list[Rule]:
    """Rejects rows that an extraction kept although ``side`` is missing."""
    return [Rule(message, F.col(MISSING) == side)] if MISSING in stg.columns else []


def _not_in(col: str, values: Sequence) -> F.Column:
    # NULL -> NULL -> rule does not fire (NOT IN semantics)
    return ~folded(col).isin(list(values))


def _sale_rules(run_date: str) -> dict[int, Rule]:
    """R1 to R5 by rank; 1, 2 and 5 are about the header, 3 and 4 about the line."""
    d = parse_date("sale_date")
    return {
        1: Rule(C.MSG_SALE_DATE, F.col("sale_date").isNull() | d.isNull() | (d > F.lit(run_date).cast("date"))),
        2: Rule(C.MSG_SALE_CUSTOMER, missing_ref("__cust_ok")),
        3: Rule(C.MSG_SALE_PRODUCT, missing_ref("__prod_ok")),
        4: Rule(C.MSG_QTY_PRICE, (F.col("quantity") <= 0) | (F.col("unit_price") <= 0)),
        5: Rule(C.MSG_SALE_STATE, _not_in("sale_state", C.SALE_STATES)),
    }


def validate_sales(stg: DataFrame, customers: DataFrame, products: DataFrame, run_date: str,
                   extra_rules: Sequence = ()) -> DataFrame:
    """R1 date NULL/unparseable/future, R2/R3 unknown customer/product,
    R4 non-positive quantity or price, R5 state outside the domain."""
    df = ref_flag(stg, customers, "customer_id", "customer_id", "__cust_ok")
    df = ref_flag(df, products, "product_id", "product_id", "__prod_ok")
    return apply_rules(df, [*_sale_rules(run_date).values(), *extra_rules]).drop("__cust_ok", "__prod_ok")


HEADER_VERDICT = "header_verdict"


def judge_sale_headers(sales: DataFrame, customers: DataFrame, run_date: str) -> DataFrame:
    """Sale headers as staged, with the verdict of R1, R2 and R5: tested once per
    sale, so no line is ever shuffled on its customer."""
    rules = _sale_rules(run_date)
    flagged = ref_flag(sale_headers(sales), customers, "customer_id", "customer_id", "__cust_ok")
    return judged(flagged, {k: rules[k] for k in (1, 2, 5)}, HEADER_VERDICT).drop("__cust_ok")


def validate_sale_lines(headers: DataFrame, lines: DataFrame, products: DataFrame, run_date: str,
                        loaded_at: str) -> DataFrame:
    """E1 with R1 to R5 over judged headers: the lines add R3 and R4, and the
    first failing rule of either grain gives the message."""
    rules = _sale_rules(run_date)
    out = join_sale_lines(headers, lines, loaded_at, carry=(HEADER_VERDICT,))
    out = judged(ref_flag(out, products, "product_id", "product_id", "__prod_ok"),
                 {k: rules[k] for k in (3, 4)}, "__line").drop("__prod_ok")
    return settle(out, [HEADER_VERDICT, "__line"])


def validate_products(stg: DataFrame, order_by: Sequence = ("product_id",)) -> DataFrame:
    """R6 price <= cost (or NULL), R7 NULL code, R8 duplicate code (first by
    ``order_by`` among rows still pending survives)."""
    rules = [
        Rule(C.MSG_PRODUCT_PRICE, F.col("sale_price").isNull() | F.col("cost_price").isNull() |
             (F.col("sale_price") <= F.col("cost_price"))),
        Rule(C.MSG_PRODUCT_CODE_NULL, F.col("code").isNull()),
        Dedup(C.MSG_PRODUCT_CODE_DUP, ["code"], list(order_by)),
    ]
    return apply_rules(stg, rules)


def validate_customers(stg: DataFrame, order_by: Sequence = ("customer_id",),
                       doc_types: Sequence[str] = tuple(C.DOCUMENT_TYPES),
                       segments: Sequence[str] = tuple(C.SEGMENTS)) -> DataFrame:
    """R9 required fields, R10 document type, R11 segment, R12 duplicate
    document, R13 trim city and region of the surviving rows."""
    rules = [
        Rule(C.MSG_CUSTOMER_REQUIRED, F.col("first_name").isNull() | F.col("last_name").isNull() |
             F.col("doc_number").isNull()),
        Rule(C.MSG_CUSTOMER_DOC_TYPE, _not_in("doc_type", doc_types)),
        Rule(C.MSG_CUSTOMER_SEGMENT, _not_in("segment", segments)),
        Dedup(C.MSG_CUSTOMER_DUP, ["doc_type", "doc_number"], list(order_by)),
        Derive("city", clean_trim("city")),
        Derive("region", clean_trim("region")),
    ]
    return apply_rules(stg, rules)


def validate_inventory(stg: DataFrame) -> DataFrame:
    """R14 closing != opening + in - out, R15 negative stock."""
    rules = [
        Rule(C.MSG_INVENTORY_BALANCE, F.col("closing") != F.col("balance")),
        Rule(C.MSG_INVENTORY_NEGATIVE, (F.col("opening") < 0) | (F.col("closing") < 0)),
    ]
    return apply_rules(stg, rules)


def validate_returns(stg: DataFrame) -> DataFrame:
    """R16 return before the sale, R17 return type outside the domain; an
    unparseable return date is rejected last (divergence, see README)."""
    d = parse_date("return_date")
    rules = [
        Rule(C.MSG_RETURN_BEFORE_SALE, d < F.col("sale_date")),
        Rule(C.MSG_RETURN_TYPE, _not_in("return_type", C.RETURN_TYPES)),
        Rule(C.MSG_RETURN_DATE, d.isNull()),
    ]
    return apply_rules(stg, rules)


def _purchase_rules() -> dict[int, Rule]:
    """R18 and R19 by rank; 1 is about the line, 2 about the header."""
    return {1: Rule(C.MSG_QTY_PRICE, (F.col("quantity") <= 0) | (F.col("unit_price") <= 0)),
            2: Rule(C.MSG_PURCHASE_SUPPLIER, missing_ref("__sup_ok"))}


def validate_purchases(stg: DataFrame, suppliers: DataFrame) -> DataFrame:
    """R18 non-positive quantity or price, R19 unknown supplier."""
    df = ref_flag(stg, suppliers, "supplier_id", "supplier_id", "__sup_ok")
    return apply_rules(df, list(_purchase_rules().values())).drop("__sup_ok")


def judge_purchase_headers(purchases: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Purchase headers as staged, with the verdict of R19: tested once per
    purchase, so no line is ever shuffled on its supplier."""
    flagged = ref_flag(purchase_headers(purchases, suppliers), suppliers, "supplier_id", "supplier_id", "__sup_ok")
    return judged(flagged, {2: _purchase_rules()[2]}, HEADER_VERDICT).drop("__sup_ok")


def validate_purchase_lines(headers: DataFrame, lines: DataFrame, loaded_at: str) -> DataFrame:
    """E6 with R18 and R19 over judged headers."""
    out = join_purchase_lines(headers, lines, loaded_at, carry=(HEADER_VERDICT,))
    return settle(judged(out, {1: _purchase_rules()[1]}, "__line"), [HEADER_VERDICT, "__line"])


def validate_goals(stg: DataFrame, stores: DataFrame, categories: DataFrame,
                   category_map: Mapping[str, str] = C.CATEGORY_NAME_MAP) -> DataFrame:
    """J10/J11 resolve store and category (through the CSV name map), then
    R20 store unresolved, R21 category unresolved, R22 value not a positive
    number."""
    df = resolve(stg, stores, ("store_id", "store_id"), "store_id", "store_id_resolved")
    df = resolve(df, categories, (map_values("category_name", dict(category_map)), "name"),
                 "category_id", "category_id_resolved")
    v = F.col("goal_value").try_cast("decimal(15,2)")
    rules = [
        *_malformed(stg),
        Rule(C.MSG_GOAL_STORE, F.col("store_id_resolved").isNull()),
        Rule(C.MSG_GOAL_CATEGORY, F.col("category_id_resolved").isNull()),
        Rule(C.MSG_GOAL_VALUE, v.isNull() | (v <= 0)),
    ]
    return apply_rules(df, rules)


def validate_adjustments(stg: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """A malformed CSV row, R23/R24 unknown store/product, R25 zero adjustment, then classify the
    sign (R26) and the free-text reason (R27) of the surviving rows."""
    df = ref_flag(stg, stores, "store_id", "store_id", "__store_ok")
    df = ref_flag(df, products, "product_id", "product_id", "__prod_ok")
    sign = (F.when(F.col("adjustment") > 0, F.lit(C.ADJ_POSITIVE))
            .when(F.col("adjustment") < 0, F.lit(C.ADJ_NEGATIVE)).otherwise(F.lit(C.ADJ_NEUTRAL)))
    rules = [
        *_malformed(stg),
        Rule(C.MSG_ADJ_STORE, missing_ref("__store_ok")),
        Rule(C.MSG_ADJ_PRODUCT, missing_ref("__prod_ok")),
        Rule(C.MSG_ADJ_ZERO, F.col("adjustment") == 0),
        Derive("adjustment_type", sign),
        Derive("reason_class", classify_contains("reason", C.REASON_PATTERNS, C.REASON_OTHER)),
    ]
    return apply_rules(df, rules).drop("__store_ok", "__prod_ok")


# --- opt-in rules described by the source system but not enforced ---------------------
MSG_X_STORE = "IdTienda no existe en OLTP"
MSG_X_SALESPERSON = "IdVendedor no existe en OLTP"
MSG_X_EARLY = "Fecha anterior al inicio del proyecto"
MSG_X_NO_SALE = "Venta de origen no existe"
MSG_X_NOT_ON_SALE = "Producto no pertenece a la venta"
MSG_X_DUP_RETURN = "Devolución duplicada por venta y producto"


def optional_sales_rules(stores: DataFrame, salespeople: DataFrame, stg: DataFrame,
                         project_start: str) -> tuple[DataFrame, list]:
    """Store and salesperson must exist; no date before ``project_start``.
    Returns the flagged frame and the rules to pass as ``extra_rules``."""
    df = ref_flag(stg, stores, "store_id", "store_id", "__xs_ok")
    df = ref_flag(df, salespeople, "salesperson_id", "salesperson_id", "__xv_ok")
    d = parse_date("sale_date")
    return df, [Rule(MSG_X_STORE, missing_ref("__xs_ok")),
                Rule(MSG_X_SALESPERSON, missing_ref("__xv_ok")),
                Rule(MSG_X_EARLY, d < F.lit(project_start).cast("date"))]


def validate_returns_strict(stg: DataFrame, sale_lines: DataFrame,
                            order_by: Sequence = ("return_id",)) -> DataFrame:
    """The sale must exist, the product must be on that sale, and a
    (sale, product) pair is returned once; then the default rules."""
    # one row per sale with its products: both tests in one join on the sale id
    sold = sale_lines.groupBy("sale_id").agg(F.collect_set("product_id").alias("__sold"))
    df = stg.join(sold, "sale_id", "left").withColumn("__sale_ok", F.col("__sold").isNotNull()).withColumn(
        "__pair_ok", F.array_contains("__sold", F.col("product_id"))).drop("__sold")
    d = parse_date("return_date")
    rules = [
        *_marked(stg, "sale", MSG_X_NO_SALE),
        Rule(MSG_X_NO_SALE, F.col("sale_id").isNotNull() & ~F.col("__sale_ok")),
        Rule(MSG_X_NOT_ON_SALE, F.col("product_id").isNotNull() & ~F.coalesce("__pair_ok", F.lit(False))),
        Rule(C.MSG_RETURN_BEFORE_SALE, d < F.col("sale_date")),
        Rule(C.MSG_RETURN_TYPE, _not_in("return_type", C.RETURN_TYPES)),
        Dedup(MSG_X_DUP_RETURN, ["sale_id", "product_id"], list(order_by)),
        Rule(C.MSG_RETURN_DATE, d.isNull()),
    ]
    return apply_rules(df, rules).drop("__sale_ok", "__pair_ok")


MSG_X_MIN_STOCK = "StockMinimo negativo"
MSG_X_CATEGORY = "Categoría no existe en catálogo"
MSG_X_INV_RANGE = "Fecha fuera del rango del proyecto"
MSG_X_INV_PRODUCT = "IdProducto no existe en OLTP"
MSG_X_INV_STORE = "IdTienda no existe en OLTP"
MSG_X_GOAL_PERIOD = "Año o Mes no válido"
MSG_X_GOAL_DUP = "Meta duplicada por Año, Mes, Tienda y Categoría"
MSG_X_PRICE_COST = "PrecioUnidad distinto del costo de catálogo"
MSG_X_PURCHASE_DATE = "FechaCompra futura, fuera de rango o no válida"


def validate_products_strict(stg: DataFrame, categories: DataFrame,
                             order_by: Sequence = ("product_id",)) -> DataFrame:
    """Default product rules, then negative minimum stock and a category
    name that is not in the catalogue."""
    df = ref_flag(stg, categories, "category_name", "name", "__cat_ok")
    rules = [
        Rule(C.MSG_PRODUCT_PRICE, F.col("sale_price").isNull() | F.col("cost_price").isNull() |
             (F.col("sale_price") <= F.col("cost_price"))),
        Rule(C.MSG_PRODUCT_CODE_NULL, F.col("code").isNull()),
        Dedup(C.MSG_PRODUCT_CODE_DUP, ["code"], list(order_by)),
        Rule(MSG_X_MIN_STOCK, F.col("min_stock") < 0),
        Rule(MSG_X_CATEGORY, missing_ref("__cat_ok")),
        *_marked(stg, "category", MSG_X_CATEGORY),
    ]
    return apply_rules(df, rules).drop("__cat_ok")


def validate_customers_strict(stg: DataFrame, order_by: Sequence = ("customer_id",)) -> DataFrame:
    """Default customer rules; surviving city and region are trimmed and
    capitalised."""
    rules = [
        Rule(C.MSG_CUSTOMER_REQUIRED, F.col("first_name").isNull() | F.col("last_name").isNull() |
             F.col("doc_number").isNull()),
        Rule(C.MSG_CUSTOMER_DOC_TYPE, _not_in("doc_type", C.DOCUMENT_TYPES)),
        Rule(C.MSG_CUSTOMER_SEGMENT, _not_in("segment", C.SEGMENTS)),
        Dedup(C.MSG_CUSTOMER_DUP, ["doc_type", "doc_number"], list(order_by)),
        Derive("city", F.initcap(clean_trim("city"))),
        Derive("region", F.initcap(clean_trim("region"))),
    ]
    return apply_rules(stg, rules)


def validate_inventory_strict(stg: DataFrame, products: DataFrame, stores: DataFrame,
                              start: str, end: str) -> DataFrame:
    """Default inventory rules, then the date must lie in [start, end]
    and product and store must exist."""
    df = ref_flag(stg, products, "product_id", "product_id", "__prod_ok")
    df = ref_flag(df, stores, "store_id", "store_id", "__store_ok")
    d = parse_date("inv_date")
    rules = [
        Rule(C.MSG_INVENTORY_BALANCE, F.col("closing") != F.col("balance")),
        Rule(C.MSG_INVENTORY_NEGATIVE, (F.col("opening") < 0) | (F.col("closing") < 0)),
        Rule(MSG_X_INV_RANGE, d.isNull() | ~d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))),
        Rule(MSG_X_INV_PRODUCT, missing_ref("__prod_ok")),
        Rule(MSG_X_INV_STORE, missing_ref("__store_ok")),
    ]
    return apply_rules(df, rules).drop("__prod_ok", "__store_ok")


def validate_goals_strict(stg: DataFrame, stores: DataFrame, categories: DataFrame,
                          category_map: Mapping[str, str], first_year: int, last_year: int,
                          order_by: Sequence) -> DataFrame:
    """Default goal rules, then a valid year/month and one goal per
    (year, month, store, resolved category)."""
    df = resolve(stg, stores, ("store_id", "store_id"), "store_id", "store_id_resolved")
    df = resolve(df, categories, (map_values("category_name", dict(category_map)), "name"),
                 "category_id", "category_id_resolved")
    v = F.col("goal_value").try_cast("decimal(15,2)")
    y, m = F.col("year").try_cast("int"), F.col("month").try_cast("int")
    rules = [
        Rule(C.MSG_GOAL_STORE, F.col("store_id_resolved").isNull()),
        Rule(C.MSG_GOAL_CATEGORY, F.col("category_id_resolved").isNull()),
        Rule(C.MSG_GOAL_VALUE, v.isNull() | (v <= 0)),
        Rule(MSG_X_GOAL_PERIOD, y.isNull() | m.isNull() | ~y.between(first_year, last_year) |
             ~m.between(1, 12)),
        Dedup(MSG_X_GOAL_DUP, ["year", "month", "store_id_resolved", "category_id_resolved"],
              list(order_by)),
    ]
    return apply_rules(df, rules)


def validate_purchases_strict(stg: DataFrame, suppliers: DataFrame, stores: DataFrame,
                              products: DataFrame, start: str, run_date: str) -> DataFrame:
    """Default purchase rules, then the store must exist, the unit price
    must equal the catalogue cost, and the date must parse and lie in
    [start, run_date]."""
    marked = _marked(stg, "supplier", C.MSG_PURCHASE_SUPPLIER)
    df = stg if marked else ref_flag(stg, suppliers, "supplier_id", "supplier_id", "__sup_ok")
    df = ref_flag(df, stores, "store_id", "store_id", "__store_ok")
    cost = products.select(F.col("product_id").alias("__pid"), F.col("cost_price").alias("__cost"))
    df = df.join(cost, df["product_id"] == F.col("__pid"), "left").drop("__pid")
    d = parse_date("purchase_date")
    rules = [
        Rule(C.MSG_QTY_PRICE, (F.col("quantity") <= 0) | (F.col("unit_price") <= 0)),
        *(marked or [Rule(C.MSG_PURCHASE_SUPPLIER, missing_ref("__sup_ok"))]),
        Rule(MSG_X_STORE, missing_ref("__store_ok")),
        Rule(MSG_X_PRICE_COST, F.col("unit_price") != F.col("__cost")),
        Rule(MSG_X_PURCHASE_DATE, d.isNull() | (d < F.lit(start).cast("date")) |
             (d > F.lit(run_date).cast("date"))),
    ]
    return apply_rules(df, rules).drop("__sup_ok", "__store_ok", "__cost")
