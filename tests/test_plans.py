"""What the plans shuffle, with broadcasts off as at size."""

import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import extracts, facts, validate
from tallyhouse.plans.warehouse import Warehouse

SMALL = "/root/testdata/sf0.001"


def exchanges(df):
    """The keys of every shuffle in the plan that would run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_joins_on_the_sale_id_do_not_shuffle(spark, no_broadcast):
    w = Warehouse.shared(spark, SMALL)
    assert exchanges(extracts.extract_sales(w.landed_sales, w.landed_sale_lines, w.loaded_at)) == []
    assert exchanges(extracts.extract_returns(w.landed_returns, w.landed_sales, w.loaded_at)) == []
    lines = w.landed_purchase_lines.join(w.landed_purchases, "purchase_id")
    assert exchanges(lines) == []
    keys = exchanges(facts.returns_fact(w.stg_returns, w.dim_product, w.fact_sales))
    assert keys and not any("sale_id" in k for k in keys)


def test_header_rules_run_at_header_grain(spark, no_broadcast):
    w = Warehouse.shared(spark, SMALL)
    s = w.src
    by_line = validate.validate_sales(extracts.extract_sales(s.sales(), s.sale_lines(), w.loaded_at),
                                      s.customers(), s.products(), w.run_date)
    by_grain = validate.validate_sale_lines(w.judged_headers, w.landed_sale_lines, s.products(), w.run_date,
                                            w.loaded_at)
    both = [sorted(map(str, df.select(sorted(by_line.columns)).collect())) for df in (by_line, by_grain)]
    assert both[0] == both[1] and set(by_line.columns) == set(by_grain.columns)
    n = [exchanges(df) for df in (by_line, by_grain)]
    assert len(n[0]) - len(n[1]) >= 2
    assert n[1].count("product_id") == 1 and not any("sale_id" in k or "customer_id" in k for k in n[1])


def test_verdicts_of_two_grains_meet_in_rule_order(spark):
    from tallyhouse.operators.rules import Rule, judged, settle
    rows = [(1, True, True), (2, True, False), (3, False, True), (4, False, False), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, h boolean, l boolean")
    out = settle(judged(judged(df, {1: Rule("h1", F.lit(False)), 4: Rule("h4", F.col("h"))}, "a"),
                        {3: Rule("l3", F.col("l")), 9: Rule("l9", F.lit(False))}, "b"), ["a", "b"])
    assert {r["id"]: r["stg_message"] for r in out.collect()} == {1: "l3", 2: "h4", 3: "l3", 4: None, 5: None}


def test_purchase_lines_are_not_shuffled_on_their_supplier(spark, no_broadcast):
    w = Warehouse.shared(spark, SMALL)
    s = w.src
    by_line = validate.validate_purchases(extracts.extract_purchases(
        s.purchases(), s.purchase_lines(), s.suppliers(), w.loaded_at), s.suppliers())
    by_grain = validate.validate_purchase_lines(w.judged_purchases, w.landed_purchase_lines, w.loaded_at)
    assert exchanges(by_grain) == [] and by_line.columns == by_grain.columns
    both = [sorted(map(str, df.collect())) for df in (by_line, by_grain)]
    assert both[0] == both[1] and both[0]


def test_a_feed_is_not_dealt_out_by_its_few_stores(spark):
    """The estimate for the stores as derived is the product of their inputs; the table
    written once is seen to be small."""
    w = Warehouse.shared(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        keys = exchanges(w.stg_adjustments_from(w.src.adjustments_csv_rows()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("store_id" in k and "product_id" not in k for k in keys)


def test_the_session_is_fitted_to_the_input(spark):
    from tallyhouse import session
    have = {k: spark.conf.get(k, None) for k in [*session.SIZED, session._INITIAL]}
    try:
        for k in have:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5m")
        session.fit_session(spark, 8 * session._MB * 3)
        assert session.shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "5m"  # what the session sets stands
        assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "8.0"
        session.fit_session(spark, 8 * session._MB * 900)
        assert session.shuffle_partitions(spark) == 900
        session.fit_session(spark, 8 * session._MB * 50)
        assert session.shuffle_partitions(spark) == 900
    finally:
        for k, v in have.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_inventory_and_adjustments_meet_unsorted(spark, no_broadcast):
    """The side with one row a month, product and store is hashed; neither is sorted."""
    inv = spark.createDataFrame(
        [("VALID", "1996-03-05", 1, 1, 10, 10, 0, 0, 1), ("VALID", "1996-03-05", 1, 1, 10, 10, 0, 0, 1),
         ("VALID", "1996-03-09", None, 1, 5, 5, 0, 0, 2), ("REJECTED", "1996-04-01", 1, 1, 5, 5, 0, 0, 3)],
        "stg_status string, inv_date string, product_id long, store_id int, opening int, closing int, units_in int, "
        "units_out int, inventory_id long")
    adj = spark.createDataFrame(
        [("VALID", "1996", "3", 1, 1, 4), ("VALID", "1996", "3", 1, 1, -1), ("VALID", "1996", "4", 1, 1, 7),
         ("VALID", "1996", "4", 1, 1, 7), ("VALID", "x", "4", 1, 1, 9), ("VALID", "1996", "3", None, 1, 2)],
        "stg_status string, year string, month string, product_id long, store_id int, adjustment int")
    product = spark.sql("SELECT 1L product_id, 11L product_key, DATE '1990-01-01' valid_from, CAST(NULL AS DATE) valid_to")
    store = spark.sql("SELECT 1 store_id, 21L store_key")
    base = facts.inventory_base(inv, adj, product, store)
    orphans = facts.inventory_orphans(inv, adj, product, store)
    for df, kind in ((base, "LeftOuter"), (orphans, "LeftAnti")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"ShuffledHashJoin .*{kind}", plan)
    assert [(r["date_key"], r["closing"], r["manual_adjustment"]) for r in base.collect()] == [(19960305, 13, 3)] * 2
    assert [(r["date_key"], r["closing"]) for r in orphans.collect()] == [(19960401, 7)] * 2


def test_buckets_are_written_without_a_sort(spark, tmp_path):
    """A task writes one bucket, so its rows need no sort; each bucket is one file
    and joins still shuffle nothing; the session's own setting stands."""
    from tallyhouse import session
    from tallyhouse.operators.keys import pin_bucketed
    key = next(iter(session.UNSORTED))
    rows = spark.range(0, 3000).select((F.col("id") % 700).alias("k"), "id").union(
        spark.createDataFrame([(None, -1), (None, -2)], "k long, id long"))
    a = pin_bucketed(rows, "k", "a", str(tmp_path), 5)
    b = pin_bucketed(rows, "k", "b", str(tmp_path), 5)
    assert spark.conf.get(key, None) is None
    table = a.inputFiles()[0].split("/")[-2]
    spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert spec["Num Buckets"] == "5" and spec.get("Sort Columns", "[]") == "[]"
    assert len(a.inputFiles()) <= 6  # one per bucket, and one without rows at most
    assert sorted(map(str, a.collect())) == sorted(map(str, rows.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b.withColumnRenamed("id", "other"), "k")
        assert exchanges(joined) == [] and joined.count() == 700 * 16 + 200 * (25 - 16)
        spark.conf.set(key, "0")
        with session.scoped(spark, session.UNSORTED):
            assert spark.conf.get(key) == "0"
        assert spark.conf.get(key) == "0"
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
