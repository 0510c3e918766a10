"""Dimension builds."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.functions import dates as FD
from tallyhouse.functions.numeric import exact_pct
from tallyhouse.functions.text import clean_trim, concat_blank, folded, same_text
from tallyhouse.operators.aggregate import union_all
from tallyhouse.operators.lookup import insert_new, lookup, with_unknown
from tallyhouse.operators.rules import valid
from tallyhouse.operators.scd2 import IS_CURRENT, VALID_FROM, VALID_TO, scd2_apply

# --- D1 calendar -------------------------------------------------------------------


def calendar(spark: SparkSession, start: str, end: str, existing: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end] with smart key and Spanish names.

    Generated from ``spark.range`` (split across tasks) instead of a day
    loop; with ``existing`` only the missing days are returned (idempotent).
    """
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days
    days = spark.range(0, n_days + 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))
    d = F.col("date")
    out = days.select(
        FD.date_key(d).alias("date_key"), d,
        F.year(d).cast("short").alias("year"),
        F.quarter(d).cast("short").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).cast("short").alias("month"),
        FD.month_name(d).alias("month_name"),
        FD.month_short_name(d).alias("month_short_name"),
        FD.month_key(d).alias("year_month"),
        F.weekofyear(d).cast("short").alias("iso_week"),
        FD.iso_weekday(d).cast("short").alias("weekday"),
        FD.weekday_name(d).alias("weekday_name"),
        (FD.iso_weekday(d) >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"))
    if existing is not None:
        out = out.join(existing.select("date_key"), "date_key", "left_anti")
    return out


# --- D2-D7 insert-only dimensions -----------------------------------------------------

@dataclass(frozen=True)
class Members:
    """An insert-only dimension: surrogate key, business key, columns, and a
    literal unknown member if it has one."""

    sk: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    unknown: Mapping | None = None

    def load(self, existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
        """The dimension after a load: members not seen before are added."""
        dim = insert_new(existing, incoming, list(self.key), self.sk).select(*self.columns)
        return with_unknown(dim, self.unknown) if existing is None and self.unknown else dim


# fixed values: the member for sales without a campaign
PROMOTION_UNKNOWN = {"promotion_key": C.UNKNOWN_KEY, "campaign_id": C.UNKNOWN_KEY,
                     "name": "Sin Promoción", "kind": "N/A", "start_date": None, "end_date": None}

GEOGRAPHY = Members("geography_key", ("city", "region"), ("geography_key", "city", "region", "country"))
PROMOTION = Members("promotion_key", ("campaign_id",), (
    "promotion_key", "campaign_id", "name", "kind", "start_date", "end_date"), PROMOTION_UNKNOWN)
CHANNEL = Members("channel_key", ("channel_id",), ("channel_key", "channel_id", "name", "description"))
SUPPLIER = Members("supplier_key", ("supplier_id",), (
    "supplier_key", "supplier_id", "name", "tax_id", "city", "contact", "phone", "geography_key"))
STORE = Members("store_key", ("store_id",), (
    "store_key", "store_id", "name", "city", "region", "address", "phone", "opened", "geography_key"))
SALESPERSON = Members("salesperson_key", ("salesperson_id",), (
    "salesperson_key", "salesperson_id", "first_name", "last_name", "full_name", "store_key", "hired"))


def geography_rows(customers: DataFrame, stores: DataFrame, suppliers: DataFrame,
                   supplier_region: str = C.SUPPLIER_REGION, country: str = C.COUNTRY) -> DataFrame:
    """Distinct trimmed (city, region) over customers, stores and suppliers
    (suppliers carry no region: a constant is used).  Names that differ in case
    or trailing blanks are one place, spelled as the first of them."""
    parts = [
        customers.select(clean_trim("city").alias("city"), clean_trim("region").alias("region")),
        stores.select(clean_trim("city").alias("city"), clean_trim("region").alias("region")),
        suppliers.select(clean_trim("city").alias("city"), F.lit(supplier_region).alias("region")),
    ]
    places = union_all(parts).groupBy(folded("city").alias("__c"), folded("region").alias("__r")).agg(
        F.min("city").alias("city"), F.min("region").alias("region"))
    return places.select("city", "region", F.lit(country).alias("country"))


def geography(customers: DataFrame, stores: DataFrame, suppliers: DataFrame,
              existing: DataFrame | None = None, supplier_region: str = C.SUPPLIER_REGION,
              country: str = C.COUNTRY) -> DataFrame:
    """D2, insert-only."""
    return GEOGRAPHY.load(existing, geography_rows(customers, stores, suppliers, supplier_region, country))


def promotion(campaigns: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D3: campaigns, insert-only, plus the unknown member (key -1)."""
    return PROMOTION.load(existing, campaigns.select("campaign_id", "name", "kind", "start_date", "end_date"))


def channel(channels: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Sales channels, insert-only."""
    return CHANNEL.load(existing, channels.select("channel_id", "name", "description"))


def supplier_rows(suppliers: DataFrame, geo: DataFrame, supplier_region: str = C.SUPPLIER_REGION) -> DataFrame:
    """Suppliers with the geography of (trimmed city, constant region)."""
    g = geo.select(F.col("city").alias("__gc"), F.col("region").alias("__gr"), "geography_key")
    inc = suppliers.join(g, same_text(clean_trim("city"), g["__gc"]) & same_text(F.lit(supplier_region), g["__gr"]))
    return inc.select("supplier_id", "name", "tax_id", "city", "contact", "phone", "geography_key")


def supplier(suppliers: DataFrame, geo: DataFrame, existing: DataFrame | None = None,
             supplier_region: str = C.SUPPLIER_REGION) -> DataFrame:
    """D5, insert-only."""
    return SUPPLIER.load(existing, supplier_rows(suppliers, geo, supplier_region))


def store_rows(stores: DataFrame, geo: DataFrame) -> DataFrame:
    """Stores with the geography of trimmed (city, region)."""
    g = geo.select(F.col("city").alias("__gc"), F.col("region").alias("__gr"), "geography_key")
    inc = stores.join(g, same_text(clean_trim("city"), g["__gc"]) & same_text(clean_trim("region"), g["__gr"]))
    return inc.select("store_id", "name", "city", "region", "address", "phone", "opened", "geography_key")


def store(stores: DataFrame, geo: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D6, insert-only."""
    return STORE.load(existing, store_rows(stores, geo))


def salesperson_rows(salespeople: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Salespeople with the key of their store and a full name."""
    inc = lookup(salespeople, dim_store, ("store_id", "store_id"), {"store_key": "store_key"})
    return inc.select("salesperson_id", "first_name", "last_name",
                      concat_blank("first_name", "last_name").alias("full_name"), "store_key", "hired")


def salesperson(salespeople: DataFrame, dim_store: DataFrame,
                existing: DataFrame | None = None) -> DataFrame:
    """D7, insert-only."""
    return SALESPERSON.load(existing, salesperson_rows(salespeople, dim_store))


# --- D8, D9 SCD2 dimensions -----------------------------------------------------------

CUSTOMER_ATTRS = ["first_name", "last_name", "full_name", "doc_type", "doc_number", "city",
                  "region", "segment", "geography_key"]
CUSTOMER_TRACKED = ["city", "region", "segment"]
PRODUCT_ATTRS = ["code", "name", "description", "category_id", "category_name", "sale_price",
                 "cost_price", "gross_margin", "margin_pct", "unit", "min_stock"]
PRODUCT_TRACKED = ["sale_price", "cost_price", "category_name"]

def customer_rows(validated: DataFrame, geo: DataFrame) -> DataFrame:
    """Valid customers with the geography of (city, region), NULL without one."""
    inc = valid(validated).select(
        "customer_id", "first_name", "last_name",
        concat_blank("first_name", "last_name").alias("full_name"),
        "doc_type", "doc_number", "city", "region", "segment")
    g = geo.select(F.col("city").alias("__gc"), F.col("region").alias("__gr"), "geography_key")
    return inc.join(g, same_text("city", g["__gc"]) & same_text("region", g["__gr"]), "left").drop("__gc", "__gr")


CUSTOMER = {"sk": "customer_key", "key": "customer_id", "tracked": CUSTOMER_TRACKED, "attrs": CUSTOMER_ATTRS,
            "require": ["geography_key"]}


def customer_scd2(dim: DataFrame | None, validated: DataFrame, geo: DataFrame, run_date: str,
                  base_date: str) -> DataFrame:
    """Customers, history on (city, region, segment).  Incoming rows
    need a geography row for (city, region); without it no version is
    inserted (and a changed current version is left open)."""
    return scd2_apply(dim, customer_rows(validated, geo), run_date=run_date, base_date=base_date, **CUSTOMER)


def product_rows(validated: DataFrame) -> DataFrame:
    """Valid products with gross margin and margin % (15 digits, then 2)."""
    margin = F.col("sale_price") - F.col("cost_price")
    return valid(validated).select(
        "product_id", "code", "name", "description", "category_id", "category_name",
        "sale_price", "cost_price", margin.cast("decimal(12,2)").alias("gross_margin"),
        exact_pct(margin, F.col("sale_price"), 15, "decimal(6,2)").alias("margin_pct"),
        "unit", F.col("min_stock").cast("int").alias("min_stock"))


PRODUCT = {"sk": "product_key", "key": "product_id", "tracked": PRODUCT_TRACKED, "attrs": PRODUCT_ATTRS}


def product_scd2(dim: DataFrame | None, validated: DataFrame, run_date: str,
                 base_date: str) -> DataFrame:
    """Products, history on (sale price, cost price, category name)."""
    return scd2_apply(dim, product_rows(validated), run_date=run_date, base_date=base_date, **PRODUCT)


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(IS_CURRENT))


__all__ = ["calendar", "geography", "promotion", "channel", "supplier", "store", "salesperson",
           "customer_scd2", "product_scd2", "current", "VALID_FROM", "VALID_TO"]
