"""Row-quality rules: order, NULL tolerance, dedup among survivors, classification."""

from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.operators.rules import Dedup, Derive, Rule, apply_rules, ref_flag
from tallyhouse.plans import validate as V

SALES_SCHEMA = ("sale_id long, sale_date string, customer_id long, store_id int, salesperson_id long, "
                "channel_id int, campaign_id int, sale_state string, sale_line_id long, product_id long, "
                "quantity int, unit_price decimal(12,2), subtotal decimal(14,2)")


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def _msgs(df, key):
    return {r[key]: (r["stg_status"], r["stg_message"]) for r in df.collect()}


def test_first_failing_rule_wins_and_null_tolerance(spark):
    from decimal import Decimal as D
    customers = spark.createDataFrame([(1,), (2,)], "customer_id long")
    products = spark.createDataFrame([(10,)], "product_id long")
    rows = [
        # bad date AND bad quantity -> only the date message
        (1, "2024-13-01", 1, 1, 1, 1, None, "Completa", 1, 10, 0, D("1.00"), None),
        # NULL customer, NULL quantity, NULL state -> valid (NULL never fails NOT IN / <=)
        (2, "2024-01-05", None, 1, 1, 1, None, None, 2, 10, None, D("1.00"), None),
        # unknown customer
        (3, "2024-01-05", 99, 1, 1, 1, None, "Completa", 3, 10, 1, D("1.00"), None),
        # unknown product
        (4, "2024-01-05", 1, 1, 1, 1, None, "Completa", 4, 77, 1, D("1.00"), None),
        # future date (run date 2024-06-30)
        (5, "2024-07-01", 1, 1, 1, 1, None, "Completa", 5, 10, 1, D("1.00"), None),
        # partial date is not a date
        (6, "2024-01", 1, 1, 1, 1, None, "Completa", 6, 10, 1, D("1.00"), None),
        (7, "31/12/2023", 1, 1, 1, 1, None, "Completa", 7, 10, 1, D("1.00"), None),
        (8, None, 1, 1, 1, 1, None, "Completa", 8, 10, 1, D("1.00"), None),
        (9, "2024-01-05", 2, 1, 1, 1, None, "Borrador", 9, 10, 1, D("1.00"), None),
        (10, "2024-01-05", 2, 1, 1, 1, None, "Pendiente", 10, 10, 2, D("0.00"), None),
    ]
    out = _msgs(V.validate_sales(_sales(spark, rows), customers, products, "2024-06-30"), "sale_line_id")
    assert out[1] == (C.REJECTED, C.MSG_SALE_DATE)
    assert out[2] == (C.VALID, None)
    assert out[3] == (C.REJECTED, C.MSG_SALE_CUSTOMER)
    assert out[4] == (C.REJECTED, C.MSG_SALE_PRODUCT)
    assert out[5] == (C.REJECTED, C.MSG_SALE_DATE)
    assert out[6] == (C.REJECTED, C.MSG_SALE_DATE)
    assert out[7] == (C.REJECTED, C.MSG_SALE_DATE)
    assert out[8] == (C.REJECTED, C.MSG_SALE_DATE)
    assert out[9] == (C.REJECTED, C.MSG_SALE_STATE)
    assert out[10] == (C.REJECTED, C.MSG_QTY_PRICE)


def test_dedup_only_among_rows_still_pending(spark):
    from decimal import Decimal as D
    schema = ("product_id long, code string, name string, description string, category_id int, "
              "category_name string, sale_price decimal(12,2), cost_price decimal(12,2), unit string, "
              "min_stock int")
    rows = [
        # lowest id rejected by price -> second survives, third is the duplicate
        (1, "A", "p1", None, 1, "X", D("5.00"), D("5.00"), "U", 1),   # equal price/cost: rejected
        (2, "A", "p2", None, 1, "X", D("6.00"), D("5.00"), "U", 1),
        (3, "A", "p3", None, 1, "X", D("6.00"), D("5.00"), "U", 1),
        (4, None, "p4", None, 1, "X", D("6.00"), D("5.00"), "U", 1),
        (5, "B", "p5", None, 1, "X", None, D("5.00"), "U", 1),
    ]
    out = _msgs(V.validate_products(spark.createDataFrame(rows, schema)), "product_id")
    assert out[1] == (C.REJECTED, C.MSG_PRODUCT_PRICE)
    assert out[2] == (C.VALID, None)
    assert out[3] == (C.REJECTED, C.MSG_PRODUCT_CODE_DUP)
    assert out[4] == (C.REJECTED, C.MSG_PRODUCT_CODE_NULL)
    assert out[5] == (C.REJECTED, C.MSG_PRODUCT_PRICE)


def test_customers_trim_only_survivors(spark):
    schema = ("customer_id long, first_name string, last_name string, doc_type string, doc_number string, "
              "city string, region string, segment string, registered string")
    rows = [
        (1, "a", "b", "CC", "1", " Cali ", " Valle ", "VIP", "2024-01-01"),
        (2, None, "b", "CC", "2", " Cali ", "Valle", "VIP", "2024-01-01"),
        (3, "a", "b", "XX", "3", "Cali", "Valle", "VIP", "2024-01-01"),
        (4, "a", "b", "CC", "4", "Cali", "Valle", "Otro", "2024-01-01"),
        (5, "a", "b", "CC", "1", "Cali", "Valle", "VIP", "2024-01-01"),
    ]
    out = {r["customer_id"]: r for r in V.validate_customers(spark.createDataFrame(rows, schema)).collect()}
    assert out[1]["stg_status"] == C.VALID and out[1]["city"] == "Cali" and out[1]["region"] == "Valle"
    assert out[2]["stg_message"] == C.MSG_CUSTOMER_REQUIRED and out[2]["city"] == " Cali "
    assert out[3]["stg_message"] == C.MSG_CUSTOMER_DOC_TYPE
    assert out[4]["stg_message"] == C.MSG_CUSTOMER_SEGMENT
    assert out[5]["stg_message"] == C.MSG_CUSTOMER_DUP


def test_adjustment_classification(spark):
    stores = spark.createDataFrame([(1,)], "store_id int")
    products = spark.createDataFrame([(7,)], "product_id long")
    schema = ("year string, month string, store_id int, store_name string, product_id long, "
              "physical_stock int, system_stock int, adjustment int, reason string")
    rows = [
        ("2024", "1", 1, "s", 7, 0, 0, -2, "MERMA en bodega"),
        ("2024", "1", 1, "s", 7, 0, 0, 3, "Error en transferencia"),   # transferencia first
        ("2024", "1", 1, "s", 7, 0, 0, 1, "Ajuste sin causa"),
        ("2024", "1", 1, "s", 7, 0, 0, 0, "Merma"),                    # zero: rejected
        ("2024", "1", 2, "s", 7, 0, 0, 1, "Merma"),                    # unknown store
        ("2024", "1", 1, "s", 8, 0, 0, 1, "Merma"),                    # unknown product
        ("2024", "1", 1, "s", 7, 0, 0, None, "devolución cliente"),
    ]
    df = V.validate_adjustments(spark.createDataFrame(rows, schema), stores, products)
    got = [(r["stg_message"], r["adjustment_type"], r["reason_class"]) for r in
           df.orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(got, key=str) == sorted([
        (None, C.ADJ_NEGATIVE, "Merma"),
        (None, C.ADJ_POSITIVE, "Transferencia"),
        (None, C.ADJ_POSITIVE, C.REASON_OTHER),
        (C.MSG_ADJ_ZERO, None, None),
        (C.MSG_ADJ_STORE, None, None),
        (C.MSG_ADJ_PRODUCT, None, None),
        (None, C.ADJ_NEUTRAL, "Devolución"),
    ], key=str)


def test_goal_resolution(spark):
    stores = spark.createDataFrame([(1,), (2,)], "store_id int")
    cats = spark.createDataFrame([(1, "Tecnología"), (2, "Salud y Belleza"), (3, "Mascotas")],
                                 "category_id int, name string")
    schema = ("year string, month string, store_id int, store_name string, category_id int, "
              "category_name string, goal_value string")
    rows = [
        ("2024", "1", 1, "s", 9, "Electrónica", "100"),          # mapped
        ("2024", "1", 1, "s", 9, "Salud y Cuidado", "100"),      # two names -> one category
        ("2024", "1", 1, "s", 9, "Belleza y Cuidado", "100"),
        ("2024", "1", 1, "s", 9, "Mascotas", "100"),             # passes through unchanged
        ("2024", "1", 1, "s", 9, "Juguetes raros", "100"),       # unmapped
        ("2024", "1", 5, "s", 9, "Mascotas", "100"),             # unknown store
        ("2024", "1", 1, "s", 9, "Mascotas", "abc"),
        ("2024", "1", 1, "s", 9, "Mascotas", "0"),
        ("2024", "1", 1, "s", 9, "Mascotas", "-5"),
    ]
    df = V.validate_goals(spark.createDataFrame(rows, schema), stores, cats)
    got = [(r["category_name"], r["goal_value"], r["category_id_resolved"], r["stg_message"])
           for r in df.collect()]
    assert ("Electrónica", "100", 1, None) in got
    assert ("Salud y Cuidado", "100", 2, None) in got
    assert ("Belleza y Cuidado", "100", 2, None) in got
    assert ("Mascotas", "100", 3, None) in got
    assert ("Juguetes raros", "100", None, C.MSG_GOAL_CATEGORY) in got
    assert [g for g in got if g[3] == C.MSG_GOAL_STORE]
    assert sum(1 for g in got if g[3] == C.MSG_GOAL_VALUE) == 3


def test_ref_flag_plans_no_nested_loop(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    ref = spark.range(50).withColumnRenamed("id", "k2")
    plan = ref_flag(df, ref, "k", "k2", "ok")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_derive_only_on_pending(spark):
    df = spark.createDataFrame([(1, 5), (2, -1)], "id int, v int")
    out = apply_rules(df, [Rule("neg", F.col("v") < 0), Derive("w", F.col("v") * 2),
                           Dedup("dup", ["id"], ["id"])])
    got = {r["id"]: (r["w"], r["stg_status"]) for r in out.collect()}
    assert got == {1: (10, C.VALID), 2: (None, C.REJECTED)}


def test_defaults_fill_nulls_only(spark):
    from tallyhouse.operators.audit import apply_defaults
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None)], "id int, stock int, state string")
    out = apply_defaults(df, {"stock": 0, "state": "Pendiente"}).collect()
    assert [tuple(r) for r in out] == [(1, 0, "a"), (2, 5, "Pendiente")]


def test_quality_summary_keeps_empty_tables(spark):
    from tallyhouse.plans.quality import quality_summary
    full = spark.createDataFrame([(C.VALID,), (C.REJECTED,), (C.REJECTED,), (C.VALID,)], "stg_status string")
    empty = spark.createDataFrame([], "stg_status string")
    got = {r["table_name"]: tuple(r)[1:] for r in quality_summary({"a": full, "b": empty}).collect()}
    assert got == {"a": (4, 2, 2, 50.0), "b": (0, None, None, None)}
