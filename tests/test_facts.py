"""Fact builds on handmade rows (FIXTURES §5)."""

import datetime as dt
from decimal import Decimal as Dec

from tallyhouse import constants as C
from tallyhouse.plans import dims, facts

D = dt.date
PRODUCT = ("product_key long, product_id long, cost_price decimal(12,2), category_id int, "
           "valid_from date, valid_to date, is_current boolean")


def _dim_product(spark):
    return spark.createDataFrame([
        (1, 7, Dec("2.00"), 1, D(2024, 1, 1), D(2024, 2, 29), False),
        (2, 7, Dec("3.00"), 1, D(2024, 3, 1), None, True),
        (3, 8, Dec("1.00"), 2, D(2024, 1, 1), None, True),
    ], PRODUCT)


def _dim_store(spark):
    return spark.createDataFrame([(11, 1), (12, 2)], "store_key long, store_id int")


INV = ("inventory_id long, inv_date string, product_id long, store_id int, opening int, closing int, "
       "units_in int, units_out int, balance int, stg_status string")
ADJ = ("year string, month string, store_id int, product_id long, adjustment int, stg_status string")


def test_inventory_month_adjustments_and_orphans(spark):
    inv = spark.createDataFrame([
        (100, "2024-01-10", 7, 1, 10, 8, 0, 2, 8, C.VALID),
        (101, "2024-01-20", 7, 1, 8, 5, 0, 3, 5, C.VALID),
        (102, "2024-01-20", 8, 1, 8, 5, 0, 3, 5, C.REJECTED),
    ], INV)
    adj = spark.createDataFrame([
        ("2024", "1", 1, 7, 2, C.VALID),     # two adjustments in a month with 2 inventory days:
        ("2024", "1", 1, 7, -1, C.VALID),    # total +1 lands on both days
        ("2024", "2", 1, 7, 4, C.VALID),     # month without inventory: orphans stay two rows
        ("2024", "2", 1, 7, 4, C.VALID),
        ("2024", "1", 1, 8, 5, C.VALID),     # only inventory row for product 8 is rejected: orphan
        ("2024", "1", 1, 7, 9, C.REJECTED),
    ], ADJ)
    base = facts.inventory_base(inv, adj, _dim_product(spark), _dim_store(spark))
    got = sorted((r["inventory_id"], r["closing"], r["manual_adjustment"], str(r["avg_stock"]))
                 for r in base.collect())
    assert got == [(100, 9, 1, "9.50"), (101, 6, 1, "7.00")]
    orph = facts.inventory_orphans(inv, adj, _dim_product(spark), _dim_store(spark))
    got = sorted((r["date_key"], r["product_key"], r["closing"], str(r["avg_stock"]), r["opening"])
                 for r in orph.collect())
    assert got == [(20240101, 3, 5, "2.50", 0), (20240201, 1, 4, "2.00", 0), (20240201, 1, 4, "2.00", 0)]


SALES_F = ("date_key int, customer_key long, product_key long, store_key long, sale_id long, "
           "sale_line_id long, quantity int, unit_price decimal(12,2), sales_amount decimal(14,2), "
           "cost_amount decimal(14,2), gross_margin decimal(14,2)")


def test_returns_fan_out_and_profitability(spark):
    fs = spark.createDataFrame([
        (20240105, 1, 3, 11, 900, 1, 2, Dec("5.00"), Dec("10.00"), Dec("2.00"), Dec("8.00")),
        (20240105, 1, 3, 11, 900, 2, 1, Dec("6.00"), Dec("6.00"), Dec("1.00"), Dec("5.00")),
        (20240106, 1, 3, 11, 901, 3, 1, Dec("0.00"), Dec("0.00"), Dec("1.00"), Dec("-1.00")),
    ], SALES_F)
    ret = spark.createDataFrame([
        (1, "2024-01-09", 900, 8, 1, "r", "Cliente", D(2024, 1, 5), C.VALID),   # product on 2 lines
        (2, "2024-01-09", 902, 8, 1, "r", "Cliente", D(2024, 1, 5), C.VALID),   # sale not in fact
    ], "return_id long, return_date string, sale_id long, product_id long, quantity int, reason string, "
       "return_type string, sale_date date, stg_status string")
    r = facts.returns_fact(ret, _dim_product(spark), fs)
    assert sorted(str(x["amount"]) for x in r.collect()) == ["5.00", "6.00"]
    cal = dims.calendar(spark, "2024-01-01", "2024-01-31")
    p = facts.profitability_fact(fs, cal).collect()
    assert len(p) == 1
    row = p[0]
    assert row["transactions"] == 2 and row["units_sold"] == 4
    assert str(row["total_sales"]) == "16.00" and str(row["gross_margin"]) == "12.00"
    assert row["margin_pct"] == 75.0
    zero = facts.profitability_fact(fs.where("sale_id = 901"), cal).collect()[0]
    assert zero["margin_pct"] == 0.0


def test_sales_fact_promotion_default(spark):
    stg = spark.createDataFrame([
        (1, "2024-03-05", 1, 1, 1, 1, None, "Completa", 1, 7, 2, Dec("4.00"), Dec("8.00"), C.VALID),
        (1, "2024-03-05", 1, 1, 1, 1, 42, "Completa", 2, 7, 1, Dec("4.00"), Dec("4.00"), C.VALID),
        (2, "2024-02-05", 1, 1, 1, 1, 5, "Completa", 3, 7, 1, Dec("4.00"), Dec("4.00"), C.VALID),
        (3, "2024-02-05", 1, 1, 1, 1, 5, "Pendiente", 4, 7, 1, Dec("4.00"), Dec("4.00"), C.VALID),
    ], "sale_id long, sale_date string, customer_id long, store_id int, salesperson_id long, "
       "channel_id int, campaign_id int, sale_state string, sale_line_id long, product_id long, "
       "quantity int, unit_price decimal(12,2), subtotal decimal(14,2), stg_status string")
    cust = spark.createDataFrame([(21, 1, D(2024, 1, 1), None)],
                                 "customer_key long, customer_id long, valid_from date, valid_to date")
    sp = spark.createDataFrame([(31, 1)], "salesperson_key long, salesperson_id long")
    ch = spark.createDataFrame([(41, 1)], "channel_key long, channel_id int")
    pr = spark.createDataFrame([(-1, -1), (51, 5)], "promotion_key long, campaign_id int")
    f = facts.sales_fact(stg, cust, _dim_product(spark), _dim_store(spark), sp, ch, pr)
    got = {r["sale_line_id"]: (r["promotion_key"], r["product_key"], str(r["cost_amount"]))
           for r in f.collect()}
    # NULL and unknown campaign -> -1; cost from the product version valid on the sale date
    assert got == {1: (-1, 2, "6.00"), 2: (-1, 2, "3.00"), 3: (51, 1, "2.00")}


def test_returns_first_line_option(spark):
    fs = spark.createDataFrame([
        (20240105, 1, 3, 11, 900, 1, 2, Dec("5.00"), Dec("10.00"), Dec("2.00"), Dec("8.00")),
        (20240105, 1, 3, 11, 900, 2, 1, Dec("6.00"), Dec("6.00"), Dec("1.00"), Dec("5.00")),
    ], SALES_F)
    ret = spark.createDataFrame([(1, "2024-01-09", 900, 8, 1, "r", "Cliente", D(2024, 1, 5), C.VALID)],
                                "return_id long, return_date string, sale_id long, product_id long, "
                                "quantity int, reason string, return_type string, sale_date date, "
                                "stg_status string")
    r = facts.returns_fact(ret, _dim_product(spark), fs, dedup="first").collect()
    assert [str(x["amount"]) for x in r] == ["5.00"]
