"""The warehouse over the stand-in source, wired step by step.

``Warehouse(spark, sf_dir)`` exposes every staging table, dimension and
fact as a lazily built DataFrame (memoised per instance, so a plan that
needs the same dimension twice builds it once).  Every finished table -
validated staging, dimensions, facts - is pinned (written to the shared
checkpoint folder and read back), as the source system writes each step's
table once and later steps read it.  Two loads are modelled for
the SCD2 dimensions: the first at ``SCD_BASE_DATE`` from the earlier
snapshot, the second at ``SCD_CHANGE_DATE`` from the current one.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import CODEC, pin, pin_bucketed
from tallyhouse.session import fit_session, scratch_path, session_key, shuffle_partitions
from tallyhouse.sources.commits import listing
from tallyhouse.plans import dims, extracts, facts, validate
from tallyhouse.plans.standin import (
    CALENDAR_END, CALENDAR_START, GOAL_CATEGORY_MAP, RUN_DATE, RUN_TS, SCD_BASE_DATE,
    SCD_CHANGE_DATE, Source,
)


def table(fn=None, *, bucket: str | None = None):
    """A warehouse table: built once per instance and pinned (written to the
    shared checkpoint folder and read back), so later steps read a table
    instead of re-running its plan.  ``bucket``: the key on which it is bucketed,
    for joins that need no shuffle."""
    if fn is None:
        return lambda f: table(f, bucket=bucket)

    def build(self):
        if bucket:
            return pin_bucketed(fn(self), bucket, fn.__name__, self.folder, self.buckets)
        return pin(fn(self), fn.__name__, self.folder, CODEC)
    build.__name__ = fn.__name__
    build.__doc__ = fn.__doc__
    build.plan = fn
    return cached_property(build)


class Warehouse:
    _shared: dict = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """One warehouse per session and input folder: dimensions are built
        (and pinned) once per run and reused by every later query, as a
        pipeline loads dimensions once before the facts.  Files that were
        added or changed since give a new one."""
        key, files = (session_key(spark), sf_dir.rstrip("/")), listing(spark, sf_dir)
        have = cls._shared.get(key)
        if have is None or have[0] != files:
            have = cls._shared[key] = (files, cls(spark, sf_dir))
        return have[1]

    def __init__(self, spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE,
                 loaded_at: str = RUN_TS, snapshot: int = 2):
        self.spark = spark
        # all tables pinned by this warehouse live under one run folder in the
        # shared checkpoint directory (remove it as a whole after the run)
        self.folder = scratch_path(spark, "warehouse-run")
        self.src = Source(spark, sf_dir)
        fit_session(spark, sum(n for path, n, _ in listing(spark, sf_dir) if any(
            f"/{t}.parquet" in path for t in self.src.TABLES)))
        self.buckets = shuffle_partitions(spark)
        self.run_date = run_date
        self.loaded_at = loaded_at
        self.snapshot = snapshot

    TABLES = ["stg_sales", "stg_products", "stg_customers", "stg_inventory", "stg_returns",
              "stg_purchases", "stg_goals", "stg_adjustments", "dim_date", "dim_geography",
              "dim_promotion", "dim_channel", "dim_supplier", "dim_store", "dim_salesperson",
              "dim_customer", "dim_product", "fact_sales", "fact_inventory", "fact_goals",
              "fact_returns", "fact_purchases", "fact_profitability"]

    def register_views(self, names: list[str] | None = None) -> list[str]:
        """Expose warehouse tables as temporary views for ``spark.sql``
        (tables are built lazily, on first use by a query)."""
        names = names or self.TABLES
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
        return names

    # --- reference tables, written once: from the size of its files a plan sees that one
    # is small.  The estimate for the joins that make it is the product of their inputs,
    # and every row of a feed would be dealt out by the few ids of its stores.
    @table
    def ref_stores(self) -> DataFrame:
        return self.src.stores()

    @table
    def ref_suppliers(self) -> DataFrame:
        return self.src.suppliers()

    # --- landed documents: header and lines of one document in one bucket -----------
    @table(bucket="sale_id")
    def landed_sales(self) -> DataFrame:
        return self.src.sales()

    @table(bucket="sale_id")
    def judged_headers(self) -> DataFrame:
        """The header rules run on the way into the buckets: their join on the
        customer costs no further shuffle back to the sale."""
        return validate.judge_sale_headers(self.src.sales(), self.src.customers(), self.run_date)

    @table(bucket="sale_id")
    def landed_sale_lines(self) -> DataFrame:
        return self.src.sale_lines()

    @table(bucket="sale_id")
    def landed_returns(self) -> DataFrame:
        return self.src.returns()

    @table(bucket="purchase_id")
    def landed_purchases(self) -> DataFrame:
        return self.src.purchases()

    @table(bucket="purchase_id")
    def judged_purchases(self) -> DataFrame:
        """The supplier is joined and tested on the way into the buckets."""
        return validate.judge_purchase_headers(self.src.purchases(), self.ref_suppliers)

    @table(bucket="purchase_id")
    def landed_purchase_lines(self) -> DataFrame:
        return self.src.purchase_lines()

    # --- staging (extract + validate) ---------------------------------------------
    @table
    def stg_sales(self) -> DataFrame:
        return validate.validate_sale_lines(self.judged_headers, self.landed_sale_lines, self.src.products(),
                                            self.run_date, self.loaded_at)

    def stg_products_raw(self, snapshot: int = 2) -> DataFrame:
        return extracts.extract_products(self.src.products(snapshot), self.src.categories(),
                                         self.loaded_at)

    def stg_customers_raw(self, snapshot: int = 2) -> DataFrame:
        return extracts.extract_customers(self.src.customers(snapshot), self.loaded_at)

    @table
    def stg_products(self) -> DataFrame:
        return validate.validate_products(self.stg_products_raw(self.snapshot))

    @table
    def stg_products_v1(self) -> DataFrame:
        return validate.validate_products(self.stg_products_raw(1))

    @table
    def stg_customers(self) -> DataFrame:
        return validate.validate_customers(self.stg_customers_raw(self.snapshot))

    @table
    def stg_customers_v1(self) -> DataFrame:
        return validate.validate_customers(self.stg_customers_raw(1))

    @table
    def stg_inventory(self) -> DataFrame:
        return validate.validate_inventory(
            extracts.extract_inventory(self.src.daily_inventory(), self.loaded_at))

    @table(bucket="sale_id")
    def stg_returns(self) -> DataFrame:
        return validate.validate_returns(
            extracts.extract_returns(self.landed_returns, self.judged_headers.withColumn(
                "sale_date", F.col("sale_date").cast("date")), self.loaded_at))

    @table
    def stg_purchases(self) -> DataFrame:
        return validate.validate_purchase_lines(self.judged_purchases, self.landed_purchase_lines, self.loaded_at)

    def stg_goals_from(self, csv_rows: DataFrame) -> DataFrame:
        raw = extracts.extract_goals(csv_rows, self.loaded_at)
        return validate.validate_goals(raw, self.ref_stores, self.src.categories(),
                                       GOAL_CATEGORY_MAP)

    def stg_adjustments_from(self, csv_rows: DataFrame) -> DataFrame:
        raw = extracts.extract_adjustments(csv_rows, self.loaded_at)
        return validate.validate_adjustments(raw, self.ref_stores, self.src.products())

    @table
    def stg_goals(self) -> DataFrame:
        return self.stg_goals_from(self.src.goals_csv_rows())

    @table
    def stg_adjustments(self) -> DataFrame:
        return self.stg_adjustments_from(self.src.adjustments_csv_rows())

    # --- dimensions -------------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.calendar(self.spark, CALENDAR_START, CALENDAR_END)

    @cached_property
    def dim_geography(self) -> DataFrame:
        s = self.src
        return pin(dims.geography(s.customers(), s.stores(), s.suppliers()), folder=self.folder)

    @cached_property
    def dim_promotion(self) -> DataFrame:
        return pin(dims.promotion(self.src.campaigns()), folder=self.folder)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return pin(dims.channel(self.src.channels()), folder=self.folder)

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return pin(dims.supplier(self.src.suppliers(), self.dim_geography), folder=self.folder)

    @cached_property
    def dim_store(self) -> DataFrame:
        return pin(dims.store(self.src.stores(), self.dim_geography), folder=self.folder)

    @cached_property
    def dim_salesperson(self) -> DataFrame:
        return pin(dims.salesperson(self.src.salespeople(), self.dim_store), folder=self.folder)

    @cached_property
    def dim_customer_v1(self) -> DataFrame:
        return dims.customer_scd2(None, self.stg_customers_v1, self.dim_geography,
                                  SCD_BASE_DATE, SCD_BASE_DATE)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.customer_scd2(self.dim_customer_v1, self.stg_customers, self.dim_geography,
                                  SCD_CHANGE_DATE, SCD_BASE_DATE)

    @cached_property
    def dim_product_v1(self) -> DataFrame:
        return dims.product_scd2(None, self.stg_products_v1, SCD_BASE_DATE, SCD_BASE_DATE)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.product_scd2(self.dim_product_v1, self.stg_products, SCD_CHANGE_DATE,
                                 SCD_BASE_DATE)

    # --- facts -----------------------------------------------------------------------
    @table(bucket="sale_id")
    def fact_sales(self) -> DataFrame:
        return facts.sales_fact(self.stg_sales, self.dim_customer, self.dim_product,
                                self.dim_store, self.dim_salesperson, self.dim_channel,
                                self.dim_promotion)

    @table
    def fact_inventory_base(self) -> DataFrame:
        return facts.inventory_base(self.stg_inventory, self.stg_adjustments, self.dim_product,
                                    self.dim_store)

    @table
    def fact_inventory_orphans(self) -> DataFrame:
        return facts.inventory_orphans(self.stg_inventory, self.stg_adjustments, self.dim_product,
                                       self.dim_store)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return self.fact_inventory_base.unionByName(self.fact_inventory_orphans)

    @table
    def fact_goals(self) -> DataFrame:
        return facts.goals_fact(self.stg_goals, self.dim_store, self.dim_date)

    @table
    def fact_returns(self) -> DataFrame:
        return facts.returns_fact(self.stg_returns, self.dim_product, self.fact_sales)

    @table
    def fact_purchases(self) -> DataFrame:
        return facts.purchases_fact(self.stg_purchases, self.dim_product, self.dim_supplier,
                                    self.dim_store)

    @table
    def fact_profitability(self) -> DataFrame:
        return facts.profitability_fact(self.fact_sales, self.dim_date)
