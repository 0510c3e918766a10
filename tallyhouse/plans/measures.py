"""Downstream measures (M1-M5) over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numeric import pct


def goal_attainment(fact_sales: DataFrame, fact_goals: DataFrame, dim_product: DataFrame,
                    dim_date: DataFrame) -> DataFrame:
    """M1: sales / goal x 100 by (year, month, store, category).

    Both sides are aggregated to the same grain first, then full-outer
    joined (1:1, no fan-out).  Sales take the category of the product
    version they were sold under."""
    cat = dim_product.select("product_key", "category_id")
    cal = dim_date.select("date_key", F.col("year").cast("int").alias("year"),
                          F.col("month").cast("int").alias("month"))
    s = (fact_sales.join(cat, "product_key").join(cal, "date_key")
         .groupBy("year", "month", "store_key", "category_id")
         .agg(F.sum("sales_amount").cast("decimal(18,2)").alias("sales_amount")))
    g = (fact_goals.groupBy("year", "month", "store_key", "category_id")
         .agg(F.sum("goal_value").cast("decimal(18,2)").alias("goal_amount")))
    j = s.join(g, ["year", "month", "store_key", "category_id"], "full_outer")
    return j.withColumn("attainment_pct", pct("sales_amount", "goal_amount"))


def return_rate(fact_sales: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """M2: returned amount over sold amount per sale (sales without returns: 0)."""
    s = fact_sales.groupBy("sale_id").agg(F.sum("sales_amount").cast("decimal(18,2)").alias("sales_amount"))
    r = fact_returns.groupBy("sale_id").agg(
        F.sum("amount").cast("decimal(18,2)").alias("returned_amount"),
        F.count(F.lit(1)).cast("long").alias("return_lines"))
    j = s.join(r, "sale_id", "left")
    return (j.withColumn("returned_amount", F.coalesce("returned_amount", F.lit(0).cast("decimal(18,2)")))
            .withColumn("return_lines", F.coalesce("return_lines", F.lit(0).cast("long")))
            .withColumn("return_rate_pct", F.coalesce(pct("returned_amount", "sales_amount"), F.lit(0.0))))


def cost_variation(fact_purchases: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M3: purchase unit price against the catalogue cost of the product
    version valid at the purchase (the fact already carries that key)."""
    p = dim_product.select("product_key", F.col("cost_price").alias("catalogue_cost"))
    j = fact_purchases.join(p, "product_key")
    diff = (F.col("unit_price") - F.col("catalogue_cost")).cast("decimal(14,2)")
    return j.select("purchase_line_id", "product_key", "unit_price", "catalogue_cost",
                    diff.alias("cost_difference"),
                    pct(diff, F.col("catalogue_cost")).alias("cost_variation_pct"))


def closing_stock(fact_inventory: DataFrame) -> DataFrame:
    """M4: semi-additive stock - the last closing value of each month per
    (product, store), then summed across stores (never across days).

    ``max_by`` is an aggregate, so it runs partially before the shuffle; a
    hot product/store key cannot pile up in one task."""
    inv = fact_inventory.withColumn("year_month", (F.col("date_key") / 100).cast("int"))
    order = F.struct("date_key", F.coalesce("inventory_id", F.lit(-1).cast("long")), "closing")
    last = (inv.groupBy("year_month", "product_key", "store_key")
            .agg(F.max_by("closing", order).alias("last_closing")))
    return (last.groupBy("year_month", "product_key")
            .agg(F.sum("last_closing").cast("long").alias("closing_stock"),
                 F.count(F.lit(1)).cast("long").alias("stores")))


def sales_by_calendar(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """M5: sales rolled up by year, quarter and month of the calendar."""
    cal = dim_date.select("date_key", "year", "quarter", "month", "month_name")
    return (fact_sales.join(cal, "date_key")
            .groupBy("year", "quarter", "month", "month_name")
            .agg(F.sum("sales_amount").cast("decimal(18,2)").alias("sales_amount"),
                 F.sum("gross_margin").cast("decimal(18,2)").alias("gross_margin"),
                 F.sum("quantity").cast("long").alias("units_sold"),
                 F.count(F.lit(1)).cast("long").alias("sale_lines"),
                 F.countDistinct("sale_id").cast("long").alias("sales")))
