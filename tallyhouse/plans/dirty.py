"""Feeds in which every rule has something to reject.

The stand-in source is clean where its keys come from: its stores, salespeople
and categories exist, and its texts are spelled one way.  Here the same tables
are given rows that break each rule, by arithmetic on natural keys, and go
through the extractions that keep what does not match.  The SQL of these
queries (``oracle_dirty``) states the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans import extracts as E
from tallyhouse.plans import validate as V
from tallyhouse.plans.standin import CALENDAR_START, GOAL_CATEGORY_MAP, UNKNOWN_ID_OFFSET
from tallyhouse.plans.warehouse import Warehouse

OTHER_STORE = 77
COPY_OFFSET = 4000000000


def _change(df: DataFrame, column: str, every: int, value: Column, by: str) -> DataFrame:
    """``value`` in place of ``column`` in the rows whose ``by`` divides by ``every``."""
    return df.withColumn(column, F.when(F.col(by) % every == 0, value).otherwise(F.col(column)).cast(
        df.schema[column].dataType))


def outer_sales(w: Warehouse, project_start: str) -> DataFrame:
    """Sale lines of unknown sales, stores and salespeople."""
    lines = _change(w.landed_sale_lines, "sale_id", 997, F.col("sale_id") + UNKNOWN_ID_OFFSET, "sale_line_id")
    lines = _change(lines, "store_id", 73, F.lit(OTHER_STORE), "sale_line_id")
    lines = _change(lines, "salesperson_id", 89, F.col("salesperson_id") + UNKNOWN_ID_OFFSET, "sale_line_id")
    raw = E.join_sale_lines(E.sale_headers(w.landed_sales), lines, w.loaded_at, keep_unmatched=True)
    flagged, extra = V.optional_sales_rules(w.ref_stores, w.src.salespeople(), raw, project_start)
    return V.validate_sales(flagged, w.src.customers(), w.src.products(), w.run_date, extra_rules=extra)


def outer_products(w: Warehouse) -> DataFrame:
    """Products of an unknown category or with a negative minimum stock."""
    rows = _change(w.src.products(), "category_id", 29, F.lit(99), "product_id")
    rows = _change(rows, "min_stock", 31, -F.col("min_stock"), "product_id")
    raw = E.extract_products(rows, w.src.categories(), w.loaded_at, keep_unmatched=True)
    return V.validate_products_strict(raw, w.src.categories())


def outer_inventory(w: Warehouse) -> DataFrame:
    """Inventory of unknown products and stores."""
    rows = _change(w.src.daily_inventory(), "store_id", 53, F.lit(OTHER_STORE), "product_id")
    rows = _change(rows, "product_id", 41, F.col("product_id") + UNKNOWN_ID_OFFSET, "product_id")
    return V.validate_inventory_strict(E.extract_inventory(rows, w.loaded_at), w.src.products(), w.ref_stores,
                                       CALENDAR_START, w.run_date)


def outer_returns(w: Warehouse) -> DataFrame:
    """Returns of unknown sales and of products not on the sale, returned twice,
    before the sale, or without a date (R16, R17, X6)."""
    rows = w.src.returns()
    rows = rows.unionByName(rows.where(F.col("return_id") % 29 == 0).withColumn(
        "return_id", F.col("return_id") + COPY_OFFSET))
    rows = _change(rows, "return_date", 101, F.lit(None), "return_id")
    rows = _change(rows, "product_id", 43, F.col("product_id") + 1, "sale_id")
    rows = _change(rows, "sale_id", 67, F.col("sale_id") + UNKNOWN_ID_OFFSET, "return_id")
    raw = E.extract_returns(rows, w.landed_sales, w.loaded_at, keep_unmatched=True)
    return V.validate_returns_strict(raw, w.landed_sale_lines)


def outer_goals(w: Warehouse) -> DataFrame:
    """Goals of a thirteenth month and goals stated twice."""
    rows = w.src.goals_csv_rows()
    month = F.col("month").cast("int")
    rows = rows.unionByName(rows.where(month % 5 == 0)).withColumn(
        "month", F.when((month == 12) & (F.col("category_id") == 1), F.lit("13")).otherwise(F.col("month")))
    return V.validate_goals_strict(E.extract_goals(rows, w.loaded_at), w.ref_stores, w.src.categories(),
                                   GOAL_CATEGORY_MAP, 1995, 2001, ["store_id", "category_name", "goal_value"])


def outer_purchases(w: Warehouse, project_start: str) -> DataFrame:
    """Purchase lines at catalogue cost, some above it, of unknown purchases,
    suppliers and stores (R18, R19, X7)."""
    cost = w.src.products().select("product_id", "cost_price")
    lines = w.src.purchase_lines().join(cost, "product_id", "left").withColumn(
        "unit_price", (F.col("cost_price") + F.when(F.col("purchase_line_id") % 19 == 0, 1).otherwise(0)).cast(
            "decimal(12,2)")).drop("cost_price")
    lines = _change(lines, "purchase_id", 97, F.col("purchase_id") + UNKNOWN_ID_OFFSET, "purchase_line_id")
    headers = _change(w.src.purchases(), "store_id", 83, F.lit(OTHER_STORE), "purchase_id")
    raw = E.extract_purchases(headers, lines, w.src.suppliers(), w.loaded_at, keep_unmatched=True)
    return V.validate_purchases_strict(raw, w.src.suppliers(), w.ref_stores, w.src.products(), project_start,
                                       w.run_date)


# --- texts in other spellings --------------------------------------------------------
def respelled(column: str, by: str) -> Column:
    """The text in capitals, in small letters or with blanks behind, by a number."""
    c, k = F.col(column), F.col(by) % 4
    return F.when(k == 1, F.upper(c)).when(k == 2, F.lower(c)).when(k == 3, F.concat(c, F.lit("  "))).otherwise(c)


def collated_customers(w: Warehouse) -> DataFrame:
    """Customers whose texts are spelled four ways: domains, duplicate documents
    and places match all the same (R10, R11, R12, J7)."""
    from tallyhouse.plans.dims import customer_rows
    rows = w.src.customers()
    for c in ("doc_type", "segment", "city", "region"):
        rows = rows.withColumn(c, respelled(c, "customer_id"))
    rows = rows.withColumn("doc_number", F.concat(F.lit("d"), "doc_number")).withColumn(
        "doc_number", respelled("doc_number", "customer_id"))
    stg = V.validate_customers(E.extract_customers(rows, w.loaded_at))
    places = customer_rows(stg, w.dim_geography).select("customer_id", "geography_key")
    return stg.join(places, "customer_id", "left")


def collated_customer_changes(w: Warehouse) -> DataFrame:
    """The first state of the customers, then the second in other spellings: only
    real changes make a version (J19)."""
    from tallyhouse.plans import dims
    from tallyhouse.plans.standin import SCD_BASE_DATE, SCD_CHANGE_DATE
    rows = w.src.customers()
    for c in ("segment", "city", "region"):
        rows = rows.withColumn(c, respelled(c, "customer_id"))
    stg = V.validate_customers(E.extract_customers(rows, w.loaded_at))
    return dims.customer_scd2(w.dim_customer_v1, stg, w.dim_geography, SCD_CHANGE_DATE, SCD_BASE_DATE)


def collated_sale_states(w: Warehouse) -> DataFrame:
    """Sale states in four spellings."""
    sales = w.landed_sales.withColumn("state", respelled("state", "sale_id"))
    headers = V.judge_sale_headers(sales, w.src.customers(), w.run_date)
    return V.validate_sale_lines(headers, w.landed_sale_lines, w.src.products(), w.run_date, w.loaded_at)


def collated_return_types(w: Warehouse) -> DataFrame:
    """Return types in four spellings."""
    rows = w.landed_returns.withColumn("return_type", respelled("return_type", "return_id"))
    return V.validate_returns(E.extract_returns(rows, w.landed_sales, w.loaded_at))


def collated_goals(w: Warehouse) -> DataFrame:
    """Category names of the goal feed in four spellings."""
    rows = w.src.goals_csv_rows()
    rows = rows.withColumn("__m", F.col("month").cast("int")).withColumn(
        "category_name", respelled("category_name", "__m")).drop("__m")
    return w.stg_goals_from(rows)
