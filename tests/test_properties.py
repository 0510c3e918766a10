"""Properties of the whole build on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.operators.rules import valid
from tallyhouse.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse.shared(spark, SF)


def test_valid_plus_rejected_is_total(w):
    for name in ["stg_sales", "stg_products", "stg_customers", "stg_inventory", "stg_returns",
                 "stg_purchases", "stg_goals", "stg_adjustments"]:
        df = getattr(w, name)
        c = {r["stg_status"]: r["count"] for r in df.groupBy("stg_status").count().collect()}
        assert set(c) <= {C.VALID, C.REJECTED}
        assert sum(c.values()) == df.count()
        # a rejected row always has a message, a valid one never
        assert df.where((F.col("stg_status") == C.REJECTED) == F.col("stg_message").isNull()).count() == 0


def test_profitability_sums_equal_sales(w):
    s = w.fact_sales.agg(F.sum("sales_amount"), F.sum("cost_amount"), F.sum("quantity")).first()
    p = w.fact_profitability.agg(F.sum("total_sales"), F.sum("total_cost"), F.sum("units_sold")).first()
    assert tuple(s) == tuple(p)


def test_adjustment_merged_or_orphan_never_both(w):
    adj = valid(w.stg_adjustments).select(
        F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)).alias("m"),
        "product_id", "store_id").distinct()
    inv_months = valid(w.stg_inventory).select(
        F.trunc(F.to_date("inv_date"), "month").alias("m"), "product_id", "store_id").distinct()
    merged = adj.join(inv_months, ["m", "product_id", "store_id"], "left_semi").count()
    orphan_groups = adj.join(inv_months, ["m", "product_id", "store_id"], "left_anti").count()
    assert merged + orphan_groups == adj.count()
    # the base fact carries the month total on its rows; orphans never share a month with a base row
    base_m = w.fact_inventory_base.select((F.col("date_key") / 100).cast("int").alias("ym"),
                                          "product_key", "store_key").distinct()
    orph_m = w.fact_inventory_orphans.select((F.col("date_key") / 100).cast("int").alias("ym"),
                                             "product_key", "store_key").distinct()
    assert base_m.join(orph_m, ["ym", "product_key", "store_key"]).count() == 0


def test_scd2_one_current_version_and_disjoint_intervals(w):
    for dim, key in [(w.dim_customer, "customer_id"), (w.dim_product, "product_id")]:
        assert dim.where("is_current").groupBy(key).count().where("count > 1").count() == 0
        a, b = dim.alias("a"), dim.alias("b")
        overlap = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) &
                         (F.col("a.valid_from") < F.col("b.valid_from")) &
                         (F.coalesce(F.col("a.valid_to"), F.lit("9999-12-31").cast("date")) >=
                          F.col("b.valid_from")))
        assert overlap.count() == 0
        # keys are dense and unique
        n = dim.count()
        assert dim.select("*").agg(F.countDistinct(dim.columns[0])).first()[0] == n


def test_as_of_never_multiplies_rows(w):
    completed = valid(w.stg_sales).where(F.col("sale_state") == C.COMPLETED).count()
    assert w.fact_sales.count() <= completed


def test_sql_over_registered_views(spark, w):
    w.register_views(["fact_sales", "fact_profitability", "stg_sales"])
    got = spark.sql("""
        SELECT 'fact_sales' AS table_name, COUNT(*) AS total FROM fact_sales
        UNION ALL SELECT 'fact_profitability', COUNT(*) FROM fact_profitability""").collect()
    assert {r["table_name"]: r["total"] for r in got} == {
        "fact_sales": w.fact_sales.count(), "fact_profitability": w.fact_profitability.count()}
    rej = spark.sql("SELECT stg_message, COUNT(*) AS n FROM stg_sales WHERE stg_status = 'REJECTED' "
                    "GROUP BY stg_message ORDER BY n DESC").collect()
    assert sum(r["n"] for r in rej) == w.stg_sales.where("stg_status = 'REJECTED'").count()
