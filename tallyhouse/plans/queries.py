"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (whole tables, no sampling) through the
stand-in source and returns one warehouse artefact or report.  Column names
match the SQL in ``tallyhouse.plans.oracle_queries``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _w(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.shared(spark, sf_dir)


STG_OUT = ["stg_status", "stg_message"]


@query("validate_sales")
def validate_sales(spark, sf_dir):
    return _w(spark, sf_dir).stg_sales.select(
        "sale_line_id", "sale_id", "customer_id", "product_id", "quantity", "sale_state", *STG_OUT)


@query("validate_products_dedup")
def validate_products_dedup(spark, sf_dir):
    return _w(spark, sf_dir).stg_products.select(
        "product_id", "code", "category_name", "sale_price", "cost_price", *STG_OUT)


@query("dedup_tied_feed")
def dedup_tied_feed(spark, sf_dir):
    """The duplicate rule over a feed without a key: order lines reduced to
    order, flag and status, where most duplicates are equal rows.  One row per
    order and flag survives."""
    from tallyhouse import constants as C
    from tallyhouse.operators.rules import Dedup, apply_rules
    feed = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_returnflag", "l_linestatus")
    out = apply_rules(feed, [Dedup("duplicate", ["l_orderkey", "l_returnflag"], ["l_linestatus"])])
    kept = F.col("stg_status") == C.VALID
    return out.groupBy("l_orderkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(kept).alias("n_valid"),
        F.max(F.when(kept, F.col("l_linestatus"))).alias("kept_status"))


@query("validate_customers")
def validate_customers(spark, sf_dir):
    return _w(spark, sf_dir).stg_customers.select(
        "customer_id", "doc_type", "doc_number", "city", "region", "segment", *STG_OUT)


@query("validate_inventory")
def validate_inventory(spark, sf_dir):
    return _w(spark, sf_dir).stg_inventory.select(
        "inventory_id", "inv_date", "product_id", "store_id", "opening", "closing", "balance", *STG_OUT)


@query("validate_returns")
def validate_returns(spark, sf_dir):
    return _w(spark, sf_dir).stg_returns.select(
        "return_id", "return_date", "sale_id", "product_id", "return_type", "sale_date", *STG_OUT)


@query("validate_purchases")
def validate_purchases(spark, sf_dir):
    return _w(spark, sf_dir).stg_purchases.select(
        "purchase_line_id", "supplier_id", "supplier_name", "quantity", "subtotal", *STG_OUT)


@query("validate_goals")
def validate_goals(spark, sf_dir):
    return _w(spark, sf_dir).stg_goals.select(
        "year", "month", "store_id", "category_name", "goal_value", "store_id_resolved",
        "category_id_resolved", *STG_OUT)


@query("classify_adjustments")
def classify_adjustments(spark, sf_dir):
    return _w(spark, sf_dir).stg_adjustments.select(
        "year", "month", "store_id", "product_id", "adjustment", "reason", "adjustment_type",
        "reason_class", *STG_OUT)


@query("scd2_customer")
def scd2_customer(spark, sf_dir):
    return _w(spark, sf_dir).dim_customer


@query("scd2_product")
def scd2_product(spark, sf_dir):
    return _w(spark, sf_dir).dim_product


@query("fact_sales")
def fact_sales(spark, sf_dir):
    return _w(spark, sf_dir).fact_sales


@query("fact_profitability")
def fact_profitability(spark, sf_dir):
    return _w(spark, sf_dir).fact_profitability


@query("fact_inventory_base")
def fact_inventory_base(spark, sf_dir):
    return _w(spark, sf_dir).fact_inventory_base


@query("fact_inventory_orphans")
def fact_inventory_orphans(spark, sf_dir):
    return _w(spark, sf_dir).fact_inventory_orphans


@query("fact_inventory")
def fact_inventory(spark, sf_dir):
    return _w(spark, sf_dir).fact_inventory


@query("fact_goals")
def fact_goals(spark, sf_dir):
    return _w(spark, sf_dir).fact_goals


@query("fact_returns")
def fact_returns(spark, sf_dir):
    return _w(spark, sf_dir).fact_returns


@query("fact_purchases")
def fact_purchases(spark, sf_dir):
    return _w(spark, sf_dir).fact_purchases


@query("calendar_dim")
def calendar_dim(spark, sf_dir):
    """The calendar over the span of the orders in the input."""
    from tallyhouse.plans.dims import calendar
    span = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("a"), F.max(F.col("o_orderdate").cast("date")).alias("b")).first()
    return calendar(spark, span["a"].isoformat(), span["b"].isoformat())


@query("geography_dim")
def geography_dim(spark, sf_dir):
    return _w(spark, sf_dir).dim_geography


@query("promotion_dim_unknown")
def promotion_dim_unknown(spark, sf_dir):
    """Campaigns and the unknown member, with the sales that fall to each."""
    sales = campaign_on_date(spark, sf_dir).groupBy(F.coalesce("active_campaign_id", F.lit(-1)).alias("campaign_id")).agg(
        F.count(F.lit(1)).alias("n_sales"))
    return _w(spark, sf_dir).dim_promotion.join(sales, "campaign_id", "left").fillna(0, ["n_sales"])


@query("supplier_dim")
def supplier_dim(spark, sf_dir):
    return _w(spark, sf_dir).dim_supplier


@query("store_dim")
def store_dim(spark, sf_dir):
    return _w(spark, sf_dir).dim_store


@query("salesperson_dim")
def salesperson_dim(spark, sf_dir):
    return _w(spark, sf_dir).dim_salesperson


@query("insert_only_dim")
def insert_only_dim(spark, sf_dir):
    return _w(spark, sf_dir).dim_channel


@query("insert_only_two_loads")
def insert_only_two_loads(spark, sf_dir):
    """Suppliers loaded twice: those without debts first, then all under new
    names.  The plain load adds the unknown ones and changes nothing else;
    ``upsert`` also renames the known ones and keeps their keys."""
    from tallyhouse.operators.keys import pin
    from tallyhouse.operators.lookup import insert_new
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    first = rows.filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"))
    second = rows.select(F.col("s_suppkey").alias("supplier_id"), F.concat("s_name", F.lit(" (2)")).alias("name"))
    dim = pin(insert_new(None, first, "supplier_id", "supplier_key"), "suppliers")
    loads = [insert_new(dim, second, "supplier_id", "supplier_key", mode=mode).select(
        F.lit(mode).alias("load_mode"), "supplier_key", "supplier_id", "name") for mode in ("insert", "upsert")]
    return loads[0].unionByName(loads[1])


# --- reports ------------------------------------------------------------------------
def _stg_tables(w: Warehouse) -> dict:
    return {"stg_sales": w.stg_sales, "stg_products": w.stg_products,
            "stg_customers": w.stg_customers, "stg_inventory": w.stg_inventory,
            "stg_returns": w.stg_returns, "stg_purchases": w.stg_purchases,
            "stg_goals": w.stg_goals, "stg_adjustments": w.stg_adjustments}


@query("quality_summary")
def quality_summary(spark, sf_dir):
    from tallyhouse.plans.quality import quality_summary as qs
    return qs(_stg_tables(_w(spark, sf_dir)))


@query("quality_reasons")
def quality_reasons(spark, sf_dir):
    from tallyhouse.plans.quality import quality_reasons as qr
    return qr(_stg_tables(_w(spark, sf_dir)))


@query("validation_status_counts")
def validation_status_counts(spark, sf_dir):
    from tallyhouse.plans.quality import status_counts
    return status_counts(_stg_tables(_w(spark, sf_dir)))


@query("fact_counts")
def fact_counts(spark, sf_dir):
    from tallyhouse.plans.quality import row_counts
    w = _w(spark, sf_dir)
    return row_counts({"fact_sales": w.fact_sales, "fact_inventory": w.fact_inventory,
                       "fact_goals": w.fact_goals, "fact_returns": w.fact_returns,
                       "fact_purchases": w.fact_purchases,
                       "fact_profitability": w.fact_profitability})


@query("load_reconciliation")
def load_reconciliation(spark, sf_dir):
    from tallyhouse.operators.rules import valid
    from tallyhouse.plans.quality import load_reconciliation as lr
    w = _w(spark, sf_dir)
    one = F.lit(1).alias("x")
    inv_read = valid(w.stg_inventory).select(one).unionByName(valid(w.stg_adjustments).select(one))
    return lr({"fact_sales": (valid(w.stg_sales), w.fact_sales),
               "fact_inventory": (inv_read, w.fact_inventory),
               "fact_goals": (valid(w.stg_goals), w.fact_goals),
               "fact_returns": (valid(w.stg_returns), w.fact_returns),
               "fact_purchases": (valid(w.stg_purchases), w.fact_purchases),
               "fact_profitability": (w.fact_sales, w.fact_profitability)})


# --- measures -----------------------------------------------------------------------
@query("goal_attainment")
def goal_attainment(spark, sf_dir):
    from tallyhouse.plans.measures import goal_attainment as ga
    w = _w(spark, sf_dir)
    return ga(w.fact_sales, w.fact_goals, w.dim_product, w.dim_date)


@query("return_rate")
def return_rate(spark, sf_dir):
    from tallyhouse.plans.measures import return_rate as rr
    w = _w(spark, sf_dir)
    return rr(w.fact_sales, w.fact_returns)


@query("cost_variation")
def cost_variation(spark, sf_dir):
    from tallyhouse.plans.measures import cost_variation as cv
    w = _w(spark, sf_dir)
    return cv(w.fact_purchases, w.dim_product)


@query("closing_stock")
def closing_stock(spark, sf_dir):
    from tallyhouse.plans.measures import closing_stock as cs
    return cs(_w(spark, sf_dir).fact_inventory)


@query("sales_by_calendar")
def sales_by_calendar(spark, sf_dir):
    from tallyhouse.plans.measures import sales_by_calendar as sc
    w = _w(spark, sf_dir)
    return sc(w.fact_sales, w.dim_date)


# --- extracts -----------------------------------------------------------------------
def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("stg_loaded_at")


@query("extract_sales_lines")
def extract_sales_lines(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    w = _w(spark, sf_dir)
    return _no_ts(E.extract_sales(w.landed_sales, w.landed_sale_lines, w.loaded_at))


@query("extract_products")
def extract_products(spark, sf_dir):
    return _no_ts(_w(spark, sf_dir).stg_products_raw(2))


@query("extract_customers")
def extract_customers(spark, sf_dir):
    return _no_ts(_w(spark, sf_dir).stg_customers_raw(2))


@query("extract_inventory")
def extract_inventory(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    w = _w(spark, sf_dir)
    return _no_ts(E.extract_inventory(w.src.daily_inventory(), w.loaded_at))


@query("extract_returns")
def extract_returns(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    w = _w(spark, sf_dir)
    return _no_ts(E.extract_returns(w.landed_returns, w.landed_sales, w.loaded_at))


@query("extract_purchases")
def extract_purchases(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    w = _w(spark, sf_dir)
    return _no_ts(E.extract_purchases(w.landed_purchases, w.landed_purchase_lines, w.src.suppliers(), w.loaded_at))


# --- joins, keys, ordering ------------------------------------------------------------
@query("asof_product")
def asof_product(spark, sf_dir):
    from tallyhouse.functions.dates import parse_date
    from tallyhouse.operators.rules import valid
    from tallyhouse.operators.scd2 import as_of_join
    w = _w(spark, sf_dir)
    s = valid(w.stg_sales).withColumn("sale_day", parse_date("sale_date"))
    out = as_of_join(s, w.dim_product, "product_id", "product_id", "sale_day",
                     {"product_key": "product_key", "sale_price": "list_price",
                      "valid_from": "version_from"})
    return out.select("sale_line_id", "product_id", "sale_day", "product_key", "list_price",
                      "version_from")


@query("asof_product_by_month")
def asof_product_by_month(spark, sf_dir):
    from tallyhouse.functions.dates import parse_date
    from tallyhouse.operators.rules import valid
    from tallyhouse.operators.scd2 import as_of_join_by_month
    w = _w(spark, sf_dir)
    s = valid(w.stg_sales).withColumn("sale_day", parse_date("sale_date"))
    out = as_of_join_by_month(s, w.dim_product, "product_id", "product_id", "sale_day",
                              {"product_key": "product_key", "sale_price": "list_price",
                               "valid_from": "version_from"})
    return out.select("sale_line_id", "product_id", "sale_day", "product_key", "list_price",
                      "version_from")


@query("asof_purchase_price")
def asof_purchase_price(spark, sf_dir):
    """What each sold product last cost on the day of its sale: a version per
    product and day of purchase."""
    from tallyhouse.functions.dates import parse_date
    from tallyhouse.operators.rules import valid
    from tallyhouse.operators.scd2 import as_of_join_by_month, versions_of
    w = _w(spark, sf_dir)
    prices = (valid(w.stg_purchases).groupBy("product_id", parse_date("purchase_date").alias("day"))
              .agg(F.max("unit_price").alias("price")))
    s = valid(w.stg_sales).select("sale_line_id", "product_id", parse_date("sale_date").alias("sale_day"))
    return as_of_join_by_month(s, versions_of(prices, "product_id", "day"), "product_id", "product_id", "sale_day",
                               {"price": "purchase_price", "valid_from": "purchased_on"}, how="left")


@query("campaign_on_date")
def campaign_on_date(spark, sf_dir):
    """The campaign active on each sale date (lowest id when several are).

    Campaign intervals are expanded to days and reduced to one row per day
    (bounded by the calendar span), so the sales side joins on equality -
    no range or nested-loop join over the large table."""
    w = _w(spark, sf_dir)
    days = (w.src.campaigns()
            .select("campaign_id", F.explode(F.sequence("start_date", "end_date")).alias("day"))
            .groupBy("day").agg(F.min("campaign_id").alias("campaign_id")))
    s = w.src.sales().select("sale_id", "sale_date")
    return s.join(days, s.sale_date == days.day, "left").select(
        "sale_id", "sale_date", F.col("campaign_id").alias("active_campaign_id"))


def _day_store_product(w: Warehouse) -> DataFrame:
    s, li = w.src.sales(), w.src.sale_lines()
    return (li.join(s.select("sale_id", "sale_date"), "sale_id")
            .select("sale_date", "store_id", "product_id").distinct())


@query("distinct_day_store_product")
def distinct_day_store_product(spark, sf_dir):
    return _day_store_product(_w(spark, sf_dir))


@query("dense_keys")
def dense_keys(spark, sf_dir):
    """Dense keys over the distinct (day, store, product) triples."""
    from tallyhouse.operators.keys import assign_keys
    return assign_keys(_day_store_product(_w(spark, sf_dir)), "movement_key",
                       ["sale_date", "store_id", "product_id"])


SAMPLE_N = 2500


@query("sample_top_n")
def sample_top_n(spark, sf_dir):
    """A reproducible sample of N sales: order by a fixed arithmetic hash of
    the key (identical in any engine, values 0..10006) and keep the first N.
    Each task keeps N rows at most before they are merged."""
    from tallyhouse.operators.aggregate import top_n
    s = _w(spark, sf_dir).src.sales().select(
        "sale_id", "sale_date", (F.col("sale_id") * 7919 % 10007).alias("sample_key"))
    return top_n(s, SAMPLE_N, ["sample_key", "sale_id"])


@query("first_per_key")
def first_per_key(spark, sf_dir):
    """First sale of each customer (by date, then id).  A min over a struct
    is an aggregate: partial results are combined before the shuffle, so a
    customer with a third of all sales is no hot task."""
    s = _w(spark, sf_dir).src.sales()
    g = s.groupBy("customer_id").agg(F.min(F.struct("sale_date", "sale_id")).alias("f"))
    return g.select("customer_id", F.col("f.sale_date").alias("first_sale_date"),
                    F.col("f.sale_id").alias("first_sale_id"))


@query("lateral_movements")
def lateral_movements(spark, sf_dir):
    """Row-wise expansion of each valid inventory day into its in and out
    movements (a lateral VALUES list; planned as Expand, no join)."""
    from tallyhouse.operators.rules import valid
    inv = valid(_w(spark, sf_dir).stg_inventory)
    return inv.unpivot(["inventory_id"], ["units_in", "units_out"], "movement", "units")


@query("adjustments_by_month")
def adjustments_by_month(spark, sf_dir):
    from tallyhouse.functions.dates import date_key, first_of_month
    from tallyhouse.operators.rules import valid
    a = valid(_w(spark, sf_dir).stg_adjustments)
    m = date_key(first_of_month(F.col("year").try_cast("int"), F.col("month").try_cast("int")))
    return (a.groupBy(m.alias("month_key"), "product_id", "store_id")
            .agg(F.sum("adjustment").cast("long").alias("total_adjustment"),
                 F.count(F.lit(1)).cast("long").alias("adjustments")))


@query("predicate_mix")
def predicate_mix(spark, sf_dir):
    """Projections and predicates over valid sale lines: ranges, IN / NOT IN,
    NULL tests, strict date parsing, date arithmetic, NULL-safe defaults,
    integer division and modulo.  All filters are plain column predicates,
    so they stay inside whole-stage code generation."""
    from tallyhouse.functions.dates import parse_date, seconds_between
    from tallyhouse.operators.rules import valid
    w = _w(spark, sf_dir)
    cost = w.src.products().select("product_id", "cost_price")
    d = parse_date("sale_date")
    s = (valid(w.stg_sales).join(cost, "product_id", "left")
         .where(F.col("quantity").between(5, 45))
         .where(F.col("sale_state").isin("Completa", "Pendiente"))
         .where(~F.col("store_id").isin(3, 7))
         .where(F.col("campaign_id").isNotNull() | F.col("customer_id").isNull())
         .where(d.isNotNull() & (d <= F.lit(w.run_date).cast("date")))
         .where(F.col("unit_price") != F.col("sale_line_id")))
    margin = F.col("unit_price") - F.col("cost_price")
    return s.select(
        "sale_line_id",
        margin.cast("decimal(14,2)").alias("unit_margin"),
        (F.round(margin.cast("double") / F.nullif(F.col("unit_price").cast("double"), F.lit(0.0)) * 100, 2))
        .alias("margin_pct"),
        F.add_months(d, 1).alias("due_date"), F.date_add(d, 7).alias("week_after"),
        seconds_between(d, F.lit(w.run_date).cast("date")).alias("seconds_to_run"),
        F.floor(F.col("quantity") / 10).cast("int").alias("quantity_tens"),
        (F.col("quantity") % 7).alias("quantity_mod7"),
        F.coalesce(F.col("campaign_id"), F.lit(-1)).alias("campaign_or_none"),
        F.nullif(F.col("quantity") - 10, F.lit(0)).alias("quantity_minus_ten"))


# --- write patterns, reruns -------------------------------------------------------
@query("scd2_rerun_noop")
def scd2_rerun_noop(spark, sf_dir):
    """Applying the same staging again on the same day changes nothing."""
    from tallyhouse.plans import dims
    from tallyhouse.plans.standin import SCD_BASE_DATE, SCD_CHANGE_DATE
    w = _w(spark, sf_dir)
    return dims.customer_scd2(w.dim_customer, w.stg_customers, w.dim_geography,
                              SCD_CHANGE_DATE, SCD_BASE_DATE)


@query("refresh_readback")
def refresh_readback(spark, sf_dir):
    """Full refresh as versioned overwrite: write two versions of the
    customer extract, read back the committed one."""
    from tallyhouse.session import scratch_path
    from tallyhouse.sources.sinks import overwrite, read_current
    w = _w(spark, sf_dir)
    base = scratch_path(spark, "stg_customers")
    overwrite(_no_ts(w.stg_customers_raw(1)), base)
    overwrite(_no_ts(w.stg_customers_raw(2)), base)
    return read_current(spark, base)


@query("upsert_readback")
def upsert_readback(spark, sf_dir):
    """SCD2 load against a stored dimension version: read the committed
    version, compute the next one, write it as a new version, read back."""
    from tallyhouse.plans import dims
    from tallyhouse.plans.standin import SCD_BASE_DATE, SCD_CHANGE_DATE
    from tallyhouse.session import scratch_path
    from tallyhouse.sources.sinks import overwrite, read_current
    w = _w(spark, sf_dir)
    base = scratch_path(spark, "dim_customer")
    overwrite(w.dim_customer_v1, base)
    stored = read_current(spark, base)
    nxt = dims.customer_scd2(stored, w.stg_customers, w.dim_geography, SCD_CHANGE_DATE,
                             SCD_BASE_DATE)
    overwrite(nxt, base)
    return read_current(spark, base)


def _csv_roundtrip(spark, df: DataFrame, name: str, schema) -> DataFrame:
    from tallyhouse.session import scratch_path
    from tallyhouse.sources.csv import read_csv, write_csv
    from tallyhouse.plans.validate import RAW_LINE
    path = write_csv(df, scratch_path(spark, name))
    return read_csv(spark, path, schema, corrupt_column=RAW_LINE)


@query("csv_adjustments")
def csv_adjustments(spark, sf_dir):
    """Adjustment feed through a real CSV file (header, comma, UTF-8, declared
    schema), then staging rules and reason classification."""
    from tallyhouse.plans.extracts import ADJUSTMENTS_CSV_SCHEMA
    w = _w(spark, sf_dir)
    rows = _csv_roundtrip(spark, w.src.adjustments_csv_rows(), "ajustes_csv", ADJUSTMENTS_CSV_SCHEMA)
    return w.stg_adjustments_from(rows).select(
        "year", "month", "store_id", "product_id", "adjustment", "reason", "adjustment_type",
        "reason_class", "stg_source", *STG_OUT)


@query("csv_malformed")
def csv_malformed(spark, sf_dir):
    """The adjustment feed with a word where the store number belongs in part
    of its rows: these are quarantined with a message, the others pass."""
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    from tallyhouse.session import scratch_path
    from tallyhouse.sources.csv import read_csv, write_csv
    w = _w(spark, sf_dir)
    bad = F.pmod("product_id", F.lit(7)) == 0
    feed = w.src.adjustments_csv_rows().withColumn(
        "store_id", F.when(bad, F.lit("uno")).otherwise(F.col("store_id").cast("string")))
    path = write_csv(feed, scratch_path(spark, "ajustes_csv_malos"))
    rows = read_csv(spark, path, E.ADJUSTMENTS_CSV_SCHEMA, corrupt_column=V.RAW_LINE)
    out = V.validate_adjustments(E.extract_adjustments(rows, w.loaded_at), w.ref_stores, w.src.products())
    return out.select("year", "month", "product_id", "adjustment", "reason", *STG_OUT)


@query("csv_goals")
def csv_goals(spark, sf_dir):
    """Monthly goal feed through a real CSV file, then resolution and rules."""
    from tallyhouse.plans.extracts import GOALS_CSV_SCHEMA
    w = _w(spark, sf_dir)
    rows = _csv_roundtrip(spark, w.src.goals_csv_rows(), "metas_csv", GOALS_CSV_SCHEMA)
    return w.stg_goals_from(rows).select(
        "year", "month", "store_id", "category_name", "goal_value", "store_id_resolved",
        "category_id_resolved", "stg_source", *STG_OUT)


# --- audit checks -------------------------------------------------------------------
@query("audit_not_null")
def audit_not_null(spark, sf_dir):
    from tallyhouse.operators.aggregate import union_all
    from tallyhouse.operators.audit import NotNull, audit
    s = _w(spark, sf_dir).src
    return union_all([
        audit(s.sales(), [NotNull("sale_date_nn", "sale_date"), NotNull("customer_nn", "customer_id"),
                          NotNull("channel_nn", "channel_id"), NotNull("state_nn", "state")], "sales"),
        audit(s.products(), [NotNull("code_nn", "code"), NotNull("cost_nn", "cost_price"),
                             NotNull("category_nn", "category_id")], "products"),
        audit(s.sale_lines(), [NotNull("quantity_nn", "quantity")], "sale_lines"),
        audit(s.customers(), [NotNull("first_name_nn", "first_name")], "customers"),
    ])


@query("audit_check")
def audit_check(spark, sf_dir):
    from tallyhouse import constants as C
    from tallyhouse.operators.aggregate import union_all
    from tallyhouse.operators.audit import Check, Domain, audit
    w = _w(spark, sf_dir)
    s = w.src
    col = F.col
    return union_all([
        audit(s.products(), [Check("price_positive", col("sale_price") > 0),
                             Check("cost_positive", col("cost_price") > 0),
                             Check("price_ge_cost", col("sale_price") >= col("cost_price"))], "products"),
        audit(s.sale_lines(), [Check("quantity_positive", col("quantity") > 0),
                               Check("price_positive", col("unit_price") > 0)], "sale_lines"),
        audit(s.daily_inventory(), [
            Check("stock_non_negative", (col("opening") >= 0) & (col("closing") >= 0)),
            Check("balance", col("closing") == col("opening") + col("units_in") - col("units_out"))],
            "inventory"),
        audit(s.sales(), [Domain("state_domain", "state", C.SALE_STATES),
                          Check("not_future", col("sale_date") <= F.lit(w.run_date).cast("date"))],
              "sales"),
        audit(s.customers(), [Domain("doc_type_domain", "doc_type", C.DOCUMENT_TYPES),
                              Domain("segment_domain", "segment", C.SEGMENTS)], "customers"),
        audit(s.returns(), [Domain("return_type_domain", "return_type", C.RETURN_TYPES)], "returns"),
        audit(s.campaigns(), [Check("dates_ordered", col("end_date") >= col("start_date"))], "campaigns"),
    ])


@query("audit_unique")
def audit_unique(spark, sf_dir):
    from tallyhouse.operators.aggregate import union_all
    from tallyhouse.operators.audit import Unique, audit
    s = _w(spark, sf_dir).src
    return union_all([
        audit(s.customers(), [Unique("document_unique", ["doc_type", "doc_number"])], "customers"),
        audit(s.products(), [Unique("code_unique", ["code"])], "products"),
        audit(s.daily_inventory(), [Unique("day_product_store_unique",
                                           ["inv_date", "product_id", "store_id"])], "inventory"),
        audit(s.sale_lines(), [Unique("line_id_unique", ["sale_line_id"])], "sale_lines"),
    ])


@query("audit_fk")
def audit_fk(spark, sf_dir):
    from tallyhouse.operators.aggregate import union_all
    from tallyhouse.operators.audit import ForeignKey, audit
    s = _w(spark, sf_dir).src
    return union_all([
        audit(s.sale_lines(), [ForeignKey("line_product_fk", ["product_id"], s.products()),
                               ForeignKey("line_sale_fk", ["sale_id"], s.sales())], "sale_lines"),
        audit(s.sales(), [ForeignKey("sale_customer_fk", ["customer_id"], s.customers())], "sales"),
        audit(s.returns(), [ForeignKey("return_sale_fk", ["sale_id"], s.sales())], "returns"),
        audit(s.purchases(), [ForeignKey("purchase_supplier_fk", ["supplier_id"], s.suppliers())],
              "purchases"),
    ])


# --- opt-in rules -------------------------------------------------------------------
PROJECT_START = "1995-03-01"


@query("optional_rules_sales")
def optional_rules_sales(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    w = _w(spark, sf_dir)
    s = w.src
    raw = E.extract_sales(s.sales(), s.sale_lines(), w.loaded_at)
    flagged, extra = V.optional_sales_rules(w.ref_stores, s.salespeople(), raw, PROJECT_START)
    out = V.validate_sales(flagged, s.customers(), s.products(), w.run_date, extra_rules=extra)
    return out.select("sale_line_id", "sale_id", "product_id", *STG_OUT)


@query("optional_rules_returns")
def optional_rules_returns(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    w = _w(spark, sf_dir)
    raw = E.extract_returns(w.landed_returns, w.landed_sales, w.loaded_at)
    out = V.validate_returns_strict(raw, w.landed_sale_lines)
    return out.select("return_id", "sale_id", "product_id", *STG_OUT)


# --- pipeline ---------------------------------------------------------------------
_STORED: dict = {}


def stored_warehouse(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A folder with two runs, and the last log id of the second: the first run
    loads the dimensions from the earlier state of the sources, the second is a
    whole run over the later state and adds to them.  Built once a session."""
    from tallyhouse.plans.pipeline import DIMENSIONS, STEPS, last_log_id, run_pipeline
    from tallyhouse.plans.standin import SCD_BASE_DATE
    from tallyhouse.session import scratch_path, session_key
    from tallyhouse.sources.commits import listing
    key, files = (session_key(spark), sf_dir.rstrip("/")), listing(spark, sf_dir)
    if _STORED.get(key, (None,))[0] != files:
        base = scratch_path(spark, "stored-warehouse")
        early = ["stg_products", "stg_customers", *DIMENSIONS]
        run_pipeline(spark, sf_dir, base, [s for s in STEPS if s.name in early], snapshot=1, load_date=SCD_BASE_DATE)
        run_pipeline(spark, sf_dir, base)
        _STORED[key] = (files, base, last_log_id(spark, base))
    return _STORED[key][1:]


def _committed(spark, base: str, table: str) -> DataFrame:
    from tallyhouse.sources.sinks import Store
    store = Store(spark, base)
    return store.read(table, store.latest().tables[table])


@query("pipeline_log")
def pipeline_log(spark, sf_dir):
    """The log of two runs into one folder, read back (deterministic columns only)."""
    from tallyhouse.plans.pipeline import latest_first, read_log
    base, last = stored_warehouse(spark, sf_dir)
    return latest_first(read_log(spark, base).filter(F.col("log_id") <= last).select(
        "log_id", "step", "phase", "status", "rows_written", "rows_read", "rows_loaded",
        "rows_rejected", "message"))


@query("stored_customers_two_runs")
def stored_customers_two_runs(spark, sf_dir):
    """The customer dimension as two runs have left it in its closed and current parts."""
    return _committed(spark, stored_warehouse(spark, sf_dir)[0], "dim_customer")


@query("stored_products_two_runs")
def stored_products_two_runs(spark, sf_dir):
    return _committed(spark, stored_warehouse(spark, sf_dir)[0], "dim_product")


@query("rerun_returns_fact")
def rerun_returns_fact(spark, sf_dir):
    """One fact built again from the committed tables alone: the step is given
    a source that does not exist."""
    from tallyhouse.plans.pipeline import run_step
    base, _ = stored_warehouse(spark, sf_dir)
    run_step(spark, f"{base}/no-source", base, "fact_returns")
    return _committed(spark, base, "fact_returns").drop("month_key")


@query("optional_rules_products")
def optional_rules_products(spark, sf_dir):
    from tallyhouse.plans import validate as V
    w = _w(spark, sf_dir)
    out = V.validate_products_strict(w.stg_products_raw(2), w.src.categories())
    return out.select("product_id", "code", "min_stock", *STG_OUT)


@query("optional_rules_customers")
def optional_rules_customers(spark, sf_dir):
    from tallyhouse.plans import validate as V
    w = _w(spark, sf_dir)
    out = V.validate_customers_strict(w.stg_customers_raw(2))
    return out.select("customer_id", "city", "region", *STG_OUT)


@query("optional_rules_inventory")
def optional_rules_inventory(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    from tallyhouse.plans.standin import CALENDAR_START
    w = _w(spark, sf_dir)
    raw = E.extract_inventory(w.src.daily_inventory(), w.loaded_at)
    out = V.validate_inventory_strict(raw, w.src.products(), w.ref_stores, CALENDAR_START, w.run_date)
    return out.select("inventory_id", "inv_date", "product_id", "store_id", *STG_OUT)


@query("optional_rules_goals")
def optional_rules_goals(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    from tallyhouse.plans.standin import GOAL_CATEGORY_MAP
    w = _w(spark, sf_dir)
    raw = E.extract_goals(w.src.goals_csv_rows(), w.loaded_at)
    out = V.validate_goals_strict(raw, w.ref_stores, w.src.categories(), GOAL_CATEGORY_MAP,
                                  1995, 2001, ["store_id", "category_name", "goal_value"])
    return out.select("year", "month", "store_id", "category_name", "goal_value", *STG_OUT)


@query("optional_rules_purchases")
def optional_rules_purchases(spark, sf_dir):
    from tallyhouse.plans import extracts as E
    from tallyhouse.plans import validate as V
    w = _w(spark, sf_dir)
    s = w.src
    raw = E.extract_purchases(s.purchases(), s.purchase_lines(), s.suppliers(), w.loaded_at)
    out = V.validate_purchases_strict(raw, s.suppliers(), w.ref_stores, s.products(), PROJECT_START,
                                      w.run_date)
    return out.select("purchase_line_id", "product_id", "unit_price", *STG_OUT)


# --- feeds in which every rule fires, texts in several spellings ------------------------
@query("outer_sales")
def outer_sales(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_sales(_w(spark, sf_dir), PROJECT_START).select(
        "sale_line_id", "sale_id", "store_id", "salesperson_id", "missing_side", *STG_OUT)


@query("outer_products")
def outer_products(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_products(_w(spark, sf_dir)).select(
        "product_id", "category_id", "category_name", "min_stock", "missing_side", *STG_OUT)


@query("outer_inventory")
def outer_inventory(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_inventory(_w(spark, sf_dir)).select(
        "inventory_id", "product_id", "store_id", *STG_OUT)


@query("outer_returns")
def outer_returns(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_returns(_w(spark, sf_dir)).select(
        "return_id", "sale_id", "product_id", "sale_date", "missing_side", *STG_OUT)


@query("outer_goals")
def outer_goals(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_goals(_w(spark, sf_dir)).select(
        "year", "month", "store_id", "category_name", "goal_value", *STG_OUT)


@query("outer_purchases")
def outer_purchases(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.outer_purchases(_w(spark, sf_dir), PROJECT_START).select(
        "purchase_line_id", "purchase_id", "supplier_id", "store_id", "unit_price", "missing_side", *STG_OUT)


@query("collated_customers")
def collated_customers(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.collated_customers(_w(spark, sf_dir)).select(
        "customer_id", "doc_type", "doc_number", "city", "segment", "geography_key", *STG_OUT)


@query("collated_customer_changes")
def collated_customer_changes(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.collated_customer_changes(_w(spark, sf_dir))


@query("collated_sale_states")
def collated_sale_states(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.collated_sale_states(_w(spark, sf_dir)).select("sale_line_id", "sale_state", *STG_OUT)


@query("collated_return_types")
def collated_return_types(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.collated_return_types(_w(spark, sf_dir)).select("return_id", "return_type", *STG_OUT)


@query("collated_goals")
def collated_goals(spark, sf_dir):
    from tallyhouse.plans import dirty
    return dirty.collated_goals(_w(spark, sf_dir)).select(
        "year", "month", "store_id", "category_name", "category_id_resolved", *STG_OUT)


@query("audit_between")
def audit_between(spark, sf_dir):
    """Ranges and ordered dates over the goal feed and the order lines."""
    from tallyhouse.operators.aggregate import union_all
    from tallyhouse.operators.audit import Check, audit
    w = _w(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"),
        "l_orderkey")
    goals = w.src.goals_csv_rows()
    return union_all([
        audit(goals, [Check("year_between", F.col("year").cast("int").between(1996, 2000)),
                      Check("month_between", F.col("month").cast("int").between(2, 11)),
                      Check("store_between", F.col("store_id").between(1, 10))], "goals"),
        audit(lines, [Check("discount_between", F.col("l_discount").between(0.02, 0.08)),
                      Check("ship_after_order", F.col("l_shipdate") >= F.col("o_orderdate"))], "lines"),
    ])


@query("declared_defaults")
def declared_defaults(spark, sf_dir):
    """Declared defaults where the input has no value: the minimum stock and the
    day a customer was registered."""
    from tallyhouse.operators.audit import apply_defaults
    w = _w(spark, sf_dir)
    products = w.src.products().select(
        F.col("product_id").alias("id"), F.when(F.col("product_id") % 7 != 0, F.col("min_stock")).alias("min_stock"))
    customers = w.src.customers().select(
        F.col("customer_id").alias("id"), F.when(F.col("customer_id") % 5 != 0, F.col("registered")).alias("registered"))
    products = apply_defaults(products, {"min_stock": 0})
    customers = apply_defaults(customers, {"registered": w.run_date})
    return products.select(F.lit("products").alias("table_name"), "id", F.col("min_stock").cast("string").alias("value")).unionByName(
        customers.select(F.lit("customers").alias("table_name"), "id", F.col("registered").cast("string").alias("value")))
