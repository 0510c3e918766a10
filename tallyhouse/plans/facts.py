"""Fact builds (FA1-FA7).

Large inputs (sales lines, inventory days, purchases) join dimensions
through ``lookup`` / ``as_of_join``, where the optimiser and AQE choose between a broadcast and a
shuffle join from measured sizes.  SCD2
dimensions are joined as-of the event date: equality on the business key
plus an interval residual; when such a dimension is large the events are
shuffled on the key and AQE splits a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.functions.dates import date_key, first_of_month, parse_date
from tallyhouse.functions.numeric import exact_pct, half_sum
from tallyhouse.operators.lookup import lookup, pre_agg_join
from tallyhouse.operators.rules import valid
from tallyhouse.operators.scd2 import as_of_join


def sales_fact(stg_sales: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               dim_store: DataFrame, dim_salesperson: DataFrame, dim_channel: DataFrame,
               dim_promotion: DataFrame) -> DataFrame:
    """FA1: valid and completed sale lines; customer and product versions
    valid on the sale date, cost from that product version; promotion -1
    for a NULL or unknown campaign."""
    s = (valid(stg_sales).where(F.col("sale_state") == C.COMPLETED)
         .withColumn("__d", parse_date("sale_date")))
    s = as_of_join(s, dim_customer, "customer_id", "customer_id", "__d",
                   {"customer_key": "customer_key"})
    s = as_of_join(s, dim_product, "product_id", "product_id", "__d",
                   {"product_key": "product_key", "cost_price": "__cost"})
    s = lookup(s, dim_store, ("store_id", "store_id"), {"store_key": "store_key"})
    s = lookup(s, dim_salesperson, ("salesperson_id", "salesperson_id"),
               {"salesperson_key": "salesperson_key"})
    s = lookup(s, dim_channel, ("channel_id", "channel_id"), {"channel_key": "channel_key"})
    s = lookup(s, dim_promotion.where(F.col("campaign_id") != C.UNKNOWN_KEY),
               ("campaign_id", "campaign_id"), {"promotion_key": "promotion_key"},
               default=C.UNKNOWN_KEY, how="left")
    cost = (F.col("quantity") * F.col("__cost")).cast("decimal(14,2)")
    return s.select(
        date_key("__d").alias("date_key"), "customer_key", "product_key", "store_key",
        "salesperson_key", "channel_key", F.col("promotion_key").cast("long").alias("promotion_key"),
        "sale_id", "sale_line_id", "quantity", F.col("unit_price").cast("decimal(12,2)").alias("unit_price"),
        F.col("subtotal").cast("decimal(14,2)").alias("sales_amount"),
        cost.alias("cost_amount"),
        (F.col("subtotal") - cost).cast("decimal(14,2)").alias("gross_margin"))


def _adjustment_month(df: DataFrame) -> F.Column:
    return first_of_month(F.col("year").try_cast("int"), F.col("month").try_cast("int"))


def inventory_base(stg_inventory: DataFrame, stg_adjustments: DataFrame, dim_product: DataFrame,
                   dim_store: DataFrame) -> DataFrame:
    """FA2: valid inventory days; the month's total valid adjustment for the
    same product and store is added to the closing stock of every day of
    that month (pre-aggregated, so the join cannot fan out)."""
    inv = valid(stg_inventory).withColumn("__d", parse_date("inv_date"))
    inv = as_of_join(inv, dim_product, "product_id", "product_id", "__d", {"product_key": "product_key"})
    inv = lookup(inv, dim_store, ("store_id", "store_id"), {"store_key": "store_key"})
    adj = valid(stg_adjustments).withColumn("__m", _adjustment_month(stg_adjustments))
    inv = pre_agg_join(inv, adj, [F.trunc("__d", "month"), "product_id", "store_id"],
                       ["__m", "product_id", "store_id"],
                       {"__adj": F.sum("adjustment").cast("long")}, default=0)
    closing = (F.col("closing") + F.col("__adj")).cast("int")
    return inv.select(
        date_key("__d").alias("date_key"), "product_key", "store_key",
        F.col("inventory_id").cast("long").alias("inventory_id"),
        F.col("opening").cast("int").alias("opening"), closing.alias("closing"),
        half_sum(F.col("opening"), closing).alias("avg_stock"),
        F.col("units_in").cast("int").alias("units_in"),
        F.col("units_out").cast("int").alias("units_out"),
        F.col("__adj").cast("int").alias("manual_adjustment"))


def inventory_orphans(stg_inventory: DataFrame, stg_adjustments: DataFrame, dim_product: DataFrame,
                      dim_store: DataFrame) -> DataFrame:
    """FA3: valid adjustments with no valid inventory day in their month for
    the same product and store; one row each (opening 0, closing = the
    adjustment).  The "no day in [month, next month)" test is an anti join on
    the derived month key - an equi-join instead of a range condition; the
    months are distinct, so they are hashed and neither side is sorted."""
    adj = valid(stg_adjustments).withColumn("__m", _adjustment_month(stg_adjustments))
    months = (valid(stg_inventory)
              .select(F.trunc(parse_date("inv_date"), "month").alias("__m"), "product_id", "store_id")
              .where(F.col("__m").isNotNull()).distinct())
    adj = adj.join(months.hint("shuffle_hash"), ["__m", "product_id", "store_id"], "left_anti")
    adj = as_of_join(adj, dim_product, "product_id", "product_id", "__m", {"product_key": "product_key"})
    adj = lookup(adj, dim_store, ("store_id", "store_id"), {"store_key": "store_key"})
    a = F.col("adjustment").cast("int")
    return adj.select(
        date_key("__m").alias("date_key"), "product_key", "store_key",
        F.lit(None).cast("long").alias("inventory_id"), F.lit(0).alias("opening"),
        a.alias("closing"), half_sum(F.lit(0), a).alias("avg_stock"),
        F.lit(0).alias("units_in"), F.lit(0).alias("units_out"), a.alias("manual_adjustment"))


def inventory_fact(stg_inventory, stg_adjustments, dim_product, dim_store) -> DataFrame:
    """FA2 + FA3."""
    return inventory_base(stg_inventory, stg_adjustments, dim_product, dim_store).unionByName(
        inventory_orphans(stg_inventory, stg_adjustments, dim_product, dim_store))


def goals_fact(stg_goals: DataFrame, dim_store: DataFrame, dim_date: DataFrame) -> DataFrame:
    """FA4: valid goals at the first day of their month (which must exist in
    the calendar), product key -1, raw CSV category name."""
    g = (valid(stg_goals).where(F.col("store_id_resolved").isNotNull() &
                                F.col("category_id_resolved").isNotNull())
         .withColumn("__y", F.col("year").try_cast("int"))
         .withColumn("__mo", F.col("month").try_cast("int"))
         .withColumn("__key", date_key(first_of_month("__y", "__mo"))))
    g = lookup(g, dim_store, ("store_id_resolved", "store_id"), {"store_key": "store_key"})
    g = g.join(dim_date.select(F.col("date_key").alias("__key")), "__key", "left_semi")
    return g.select(
        F.col("__key").alias("date_key"), "store_key",
        F.lit(C.UNKNOWN_KEY).cast("long").alias("product_key"),
        F.col("__y").alias("year"), F.col("__mo").alias("month"),
        F.col("category_id_resolved").cast("int").alias("category_id"),
        "category_name",
        F.col("goal_value").try_cast("decimal(15,2)").alias("goal_value"))


def returns_fact(stg_returns: DataFrame, dim_product: DataFrame, fact_sales: DataFrame,
                 dedup: str = "all") -> DataFrame:
    """FA5: valid returns, matched to the sales fact on the sale and the product
    version of the sale date, for store, customer, sale date and the real unit
    price.  A product sold on two lines of one sale matches both (``dedup='all'``,
    as in the source system); ``dedup='first'`` matches only the sale's first line
    of that product.

    The fact row already holds the version that was valid on the sale date, and a
    version belongs to one product, so the lines of the sale are taken first (a
    join on the sale id alone, without a shuffle where both are bucketed on it)
    and the product is compared through the version's business key."""
    r = valid(stg_returns).withColumn("__d", parse_date("return_date"))
    if dedup == "first":
        from tallyhouse.operators.aggregate import dedup_first
        fact_sales = dedup_first(fact_sales.select("sale_id", "product_key", "sale_line_id", "date_key",
                                                   "store_key", "customer_key", "unit_price"),
                                 ["sale_id", "product_key"], ["sale_line_id"])
    elif dedup != "all":
        raise ValueError(f"dedup must be 'all' or 'first', not {dedup!r}")
    fs = fact_sales.select("sale_id", "product_key", F.col("date_key").alias("sale_date_key"), "store_key",
                           "customer_key", F.col("unit_price").alias("__price"))
    r = lookup(r.join(fs, "sale_id"), dim_product, ("product_key", "product_key"), {"product_id": "__pid"})
    return r.where(F.col("__pid") == F.col("product_id")).select(
        date_key("__d").alias("date_key"), "sale_date_key", "product_key", "store_key",
        "customer_key", "return_id", "sale_id", "return_type", "reason",
        F.col("quantity").alias("quantity"),
        (F.col("quantity") * F.col("__price")).cast("decimal(14,2)").alias("amount"))


def purchases_fact(stg_purchases: DataFrame, dim_product: DataFrame, dim_supplier: DataFrame,
                   dim_store: DataFrame) -> DataFrame:
    """FA6: valid and completed purchase lines, product version as of the
    purchase date (an unparseable date simply matches no version)."""
    p = (valid(stg_purchases).where(F.col("purchase_state") == C.COMPLETED)
         .withColumn("__d", parse_date("purchase_date")))
    p = as_of_join(p, dim_product, "product_id", "product_id", "__d", {"product_key": "product_key"})
    p = lookup(p, dim_supplier, ("supplier_id", "supplier_id"), {"supplier_key": "supplier_key"})
    p = lookup(p, dim_store, ("store_id", "store_id"), {"store_key": "store_key"})
    return p.select(
        date_key("__d").alias("date_key"), "product_key", "supplier_key", "store_key",
        "purchase_id", "purchase_line_id", "quantity",
        F.col("unit_price").cast("decimal(12,2)").alias("unit_price"),
        F.col("subtotal").cast("decimal(14,2)").alias("amount"))


def profitability_fact(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """FA7: monthly totals per product and store from the sales fact.

    ``count(DISTINCT sale_id)`` per group is planned as partial aggregation
    on (group, sale_id) before the shuffle, then a merge - no Expand."""
    cal = dim_date.select("date_key", "year", "month")
    j = fact_sales.join(cal, "date_key")
    g = j.groupBy("year", "month", "product_key", "store_key").agg(
        F.sum("sales_amount").alias("__s"), F.sum("cost_amount").alias("__c"),
        F.sum("quantity").cast("long").alias("units_sold"),
        F.countDistinct("sale_id").cast("long").alias("transactions"))
    margin = F.col("__s") - F.col("__c")
    return g.select(
        date_key(first_of_month(F.col("year").cast("int"), F.col("month").cast("int"))).alias("date_key"),
        "product_key", "store_key", F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("__s").cast("decimal(16,2)").alias("total_sales"),
        F.col("__c").cast("decimal(16,2)").alias("total_cost"),
        margin.cast("decimal(16,2)").alias("gross_margin"),
        F.coalesce(exact_pct(margin, F.col("__s"), 6, "decimal(6,2)"), F.lit(0)).cast("decimal(6,2)").alias("margin_pct"),
        "units_sold", "transactions")
