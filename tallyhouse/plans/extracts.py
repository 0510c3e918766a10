"""Staging extracts (E1-E8): operational tables and CSV feeds -> staging rows.

Staging keeps dates as text so that dirty values can land; the rules parse
them.  Every function is pure (DataFrames in, DataFrame out, no write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyhouse.operators.audit import apply_defaults
from tallyhouse.sources.tables import stamp


def _date_text(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def sale_headers(sales: DataFrame, carry: tuple = ()) -> DataFrame:
    """The header columns of a staged sale line."""
    return sales.select("sale_id", _date_text("sale_date").alias("sale_date"), "customer_id", "channel_id",
                        "campaign_id", F.col("state").alias("sale_state"), *carry)


def extract_sales(sales: DataFrame, lines: DataFrame, loaded_at: str) -> DataFrame:
    """Sale header x lines (both large: a sort-merge join on sale_id,
    without a shuffle if both are bucketed on it)."""
    return join_sale_lines(sale_headers(sales), lines, loaded_at)


MISSING = "missing_side"


def _outer(df: DataFrame, other: DataFrame, key: str, side: str) -> DataFrame:
    """Left join that keeps what does not match and names the side that is missing
    (the first one, if several are); a NULL key misses nothing by itself."""
    found = other.withColumn("__found", F.lit(True))
    out = df.join(found, key, "left")
    mark = F.when(F.col("__found").isNull() & F.col(key).isNotNull(), F.lit(side))
    before = [F.col(MISSING)] if MISSING in df.columns else []
    return out.withColumn(MISSING, F.coalesce(*before, mark)).drop("__found")


def join_sale_lines(headers: DataFrame, lines: DataFrame, loaded_at: str, carry: tuple = (),
                    keep_unmatched: bool = False) -> DataFrame:
    """Lines with their header.  ``keep_unmatched``: lines without one stay, marked."""
    if keep_unmatched:
        j, carry = _outer(lines, headers, "sale_id", "sale"), (*carry, MISSING)
    else:
        j = lines.join(headers, "sale_id")
    out = j.select(
        "sale_id", "sale_date", "customer_id", "store_id", "salesperson_id", "channel_id", "campaign_id",
        "sale_state", "sale_line_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)").alias("subtotal"), *carry)
    return stamp(out, "sales", loaded_at)


def extract_products(products: DataFrame, categories: DataFrame, loaded_at: str,
                     keep_unmatched: bool = False) -> DataFrame:
    """Product x category (the catalogue is small: broadcast by size).
    ``keep_unmatched``: products of an unknown category stay, marked."""
    cat = categories.select("category_id", F.col("name").alias("category_name"))
    j = _outer(products, cat, "category_id", "category") if keep_unmatched else products.join(cat, "category_id")
    out = j.select(
        "product_id", "code", "name", "description", "category_id", "category_name",
        "sale_price", "cost_price", "unit", "min_stock", *([MISSING] if keep_unmatched else []))
    # declared source default: minimum stock 0
    return stamp(apply_defaults(out, {"min_stock": 0}), "products", loaded_at)


def extract_customers(customers: DataFrame, loaded_at: str) -> DataFrame:
    """Customers, registration date as text."""
    out = customers.select(
        "customer_id", "first_name", "last_name", "doc_type", "doc_number", "city", "region",
        "segment", _date_text("registered").alias("registered"))
    return stamp(out, "customers", loaded_at)


def extract_inventory(inventory: DataFrame, loaded_at: str) -> DataFrame:
    """Daily inventory with the computed balance opening + in - out."""
    out = inventory.select(
        "inventory_id", _date_text("inv_date").alias("inv_date"), "product_id", "store_id",
        "opening", "closing", "units_in", "units_out",
        (F.col("opening") + F.col("units_in") - F.col("units_out")).alias("balance"))
    return stamp(out, "inventory", loaded_at)


def extract_returns(returns: DataFrame, sales: DataFrame, loaded_at: str,
                    keep_unmatched: bool = False) -> DataFrame:
    """E5: returns x sale header to fetch the original sale date.
    ``keep_unmatched``: returns without a sale stay, marked."""
    hdr = sales.select("sale_id", F.col("sale_date").alias("sale_date"))
    j = _outer(returns, hdr, "sale_id", "sale") if keep_unmatched else returns.join(hdr, "sale_id")
    out = j.select(
        "return_id", _date_text("return_date").alias("return_date"), "sale_id", "product_id",
        "quantity", "reason", "return_type", "sale_date", *([MISSING] if keep_unmatched else []))
    return stamp(out, "returns", loaded_at)


def purchase_headers(purchases: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The header columns of a staged purchase line; the supplier belongs to the
    header, so no line is ever shuffled on it."""
    sup = suppliers.select("supplier_id", F.col("name").alias("supplier_name"))
    return purchases.join(sup, "supplier_id").select(
        "purchase_id", _date_text("purchase_date").alias("purchase_date"), "supplier_id", "supplier_name",
        "store_id", F.col("state").alias("purchase_state"))


def join_purchase_lines(headers: DataFrame, lines: DataFrame, loaded_at: str, carry: tuple = ()) -> DataFrame:
    """Lines with their header (``purchase_headers``)."""
    return stamp(lines.join(headers, "purchase_id").select(
        *_PURCHASE_HEADER, *_PURCHASE_LINE, _purchase_subtotal(), *carry), "purchases", loaded_at)


_PURCHASE_HEADER = ("purchase_id", "purchase_date", "supplier_id", "supplier_name", "store_id", "purchase_state")
_PURCHASE_LINE = ("purchase_line_id", "product_id", "quantity", "unit_price")


def _purchase_subtotal() -> F.Column:
    return (F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)").alias("subtotal")


def extract_purchases(purchases: DataFrame, lines: DataFrame, suppliers: DataFrame,
                      loaded_at: str, keep_unmatched: bool = False) -> DataFrame:
    """Purchase header x lines x supplier (inner joins).  ``keep_unmatched``:
    lines without a header or supplier stay, marked with the side that is missing."""
    if not keep_unmatched:
        return join_purchase_lines(purchase_headers(purchases, suppliers), lines, loaded_at)
    sup = suppliers.select("supplier_id", F.col("name").alias("supplier_name"))
    j = _outer(_outer(lines, purchases, "purchase_id", "purchase"), sup, "supplier_id", "supplier")
    out = j.withColumn("purchase_date", _date_text("purchase_date")).withColumnRenamed("state", "purchase_state").select(
        *_PURCHASE_HEADER, *_PURCHASE_LINE, _purchase_subtotal(), MISSING)
    return stamp(out, "purchases", loaded_at)


# --- CSV layouts (E7, E8): positional columns, dirty ones as text -----------------
GOALS_CSV_SCHEMA = StructType([
    StructField("year", StringType()), StructField("month", StringType()),
    StructField("store_id", IntegerType()), StructField("store_name", StringType()),
    StructField("category_id", IntegerType()), StructField("category_name", StringType()),
    StructField("goal_value", StringType()),
])
ADJUSTMENTS_CSV_SCHEMA = StructType([
    StructField("year", StringType()), StructField("month", StringType()),
    StructField("store_id", IntegerType()), StructField("store_name", StringType()),
    StructField("product_id", IntegerType()), StructField("physical_stock", IntegerType()),
    StructField("system_stock", IntegerType()), StructField("adjustment", IntegerType()),
    StructField("reason", StringType()),
])


def _by_position(csv_rows: DataFrame, schema: StructType) -> DataFrame:
    """The declared names for the leading columns; further ones (the raw line
    of a malformed row) keep their names."""
    names = [f.name for f in schema.fields]
    return csv_rows.toDF(*names, *csv_rows.columns[len(names):])


def extract_goals(csv_rows: DataFrame, loaded_at: str) -> DataFrame:
    """Goal CSV rows -> staging (columns taken by position)."""
    out = _by_position(csv_rows, GOALS_CSV_SCHEMA)
    return stamp(out, "metas_csv", loaded_at)


def extract_adjustments(csv_rows: DataFrame, loaded_at: str) -> DataFrame:
    """Adjustment CSV rows -> staging (columns taken by position)."""
    out = _by_position(csv_rows, ADJUSTMENTS_CSV_SCHEMA)
    return stamp(out, "ajustes_csv", loaded_at)
