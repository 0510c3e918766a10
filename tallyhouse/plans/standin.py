"""Operational (source) tables derived from the driver's test tables.

The test data is a TPC-H-like star schema; this module re-reads it as the
retail source system the warehouse build expects (sales headers and lines,
customers, products, stores, suppliers, ...).  Every table is a lazy
DataFrame over the whole input tables; nothing is sampled.  Deterministic
"dirty" rows are injected by arithmetic on the natural keys so that every
quality rule has work to do; the same definitions are written in SQL in
``tallyhouse.plans.oracle``.

Mapping (test table -> retail concept):
  orders / lineitem      -> sale header / sale line (store = l_suppkey % 10 + 1,
                            salesperson = l_suppkey)
  customer + nation      -> customer (city = nation, region = region name)
  part                   -> product (category = p_type, cost = p_retailprice)
  supplier               -> supplier and salesperson
  o_orderpriority        -> sales channel (id = leading digit)
  lineitem, flag 'R'     -> customer/supplier returns
  lineitem               -> purchases (one line each), daily inventory
                            (grouped by day, product, store), CSV
                            adjustments and monthly goals
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.text import map_values
from tallyhouse.sources.tables import read_table

# --- fixed values: scenario parameters ----------------------------------------
RUN_DATE = "2001-06-30"          # "today" of the run; later orders are future-dated
SCD_BASE_DATE = "1995-01-01"     # first version start (covers all history)
SCD_CHANGE_DATE = "1998-07-01"   # date of the second load (SCD2 changes)
CALENDAR_START = "1995-01-01"
CALENDAR_END = "2001-12-31"
RUN_TS = "2001-06-30 23:00:00"

# six product types of the test data -> catalogue categories 1..6
CATEGORY_NAMES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SEGMENT_BY_MKT = {"AUTOMOBILE": "Minorista", "BUILDING": "Mayorista",
                  "FURNITURE": "Corporativo", "HOUSEHOLD": "VIP", "MACHINERY": "Regular"}
# CSV goal files spell the categories differently; map back to the catalogue
GOAL_CSV_CATEGORY = {"ECONOMY": "Economico", "PROMO": "Promocional", "SMALL": "Pequeno",
                     "MEDIUM": "MEDIUM", "STANDARD": "Estandar sin mapa"}
GOAL_CATEGORY_MAP = {"Economico": "ECONOMY", "Grande": "LARGE", "Gran formato": "LARGE",
                     "Promocional": "PROMO", "Pequeno": "SMALL"}
CAMPAIGNS = [
    (1, "Temporada de verano", "1995-03-01", "1995-05-31", "Descuento"),
    (2, "Fin de año", "1996-11-01", "1996-12-31", "Temporada"),
    (3, "Mitad de año", "1997-06-01", "1997-08-15", "Descuento"),
    (4, "Lanzamiento", "1999-01-01", "1999-03-31", "Lanzamiento"),
    (5, "Cierre de siglo", "2000-10-15", "2001-01-15", "Temporada"),
]
ADJUSTMENT_REASONS = [
    "Merma por humedad en estante", "MERMA detectada en conteo",
    "Producto con vencimiento cercano", "Transferencia entre tiendas",
    "Error de sistema en registro", "Exceso de inventario recibido",
    "Devolución de cliente", "Ajuste por conteo físico", "Robo o pérdida",
    "Error en transferencia", "Vencimiento y merma",
    "Reclasificación de producto", "Devolucion a proveedor",
]
RETURN_REASONS = ["Producto defectuoso", "No cumple expectativas", "Error en despacho"]
DOC_TYPES_CYCLE = ["CC", "NIT", "CE", "Pasaporte", "TI"]
UNKNOWN_ID_OFFSET = 1000000000


def _pick(values: list[str], idx0) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx0 + 1).cast("int"))


@dataclass
class Source:
    spark: SparkSession
    sf_dir: str
    TABLES: ClassVar[tuple[str, ...]] = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")
    _scans: dict = field(default_factory=dict)

    def t(self, name: str) -> DataFrame:
        """An input table as it was when this run first asked for it."""
        if name not in self._scans:
            self._scans[name] = read_table(self.spark, self.sf_dir, name)
        return self._scans[name]

    # --- reference data --------------------------------------------------------
    def categories(self) -> DataFrame:
        rows = [(i + 1, n, f"Productos {n.lower()}") for i, n in enumerate(CATEGORY_NAMES)]
        return self.spark.createDataFrame(rows, "category_id int, name string, description string")

    def campaigns(self) -> DataFrame:
        return (self.spark.createDataFrame(
            CAMPAIGNS, "campaign_id int, name string, start_date string, end_date string, kind string")
            .withColumn("start_date", F.to_date("start_date"))
            .withColumn("end_date", F.to_date("end_date")))

    def channels(self) -> DataFrame:
        o = self.t("orders")
        return (o.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("channel_id"),
                         F.col("o_orderpriority").alias("name"))
                .distinct()
                .withColumn("description", F.concat(F.lit("Prioridad "), F.col("name"))))

    def suppliers(self) -> DataFrame:
        s, n = self.t("supplier"), self.t("nation")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
                        F.concat(F.lit("NIT-"), F.col("s_suppkey").cast("string")).alias("tax_id"),
                        F.col("n_name").alias("city"),
                        F.concat(F.lit("Contacto "), F.col("s_suppkey").cast("string")).alias("contact"),
                        F.concat(F.lit("555-"), F.col("s_suppkey").cast("string")).alias("phone")))

    def stores(self) -> DataFrame:
        s, n, r = self.t("supplier"), self.t("nation"), self.t("region")
        ids = s.select((F.col("s_suppkey") % 10 + 1).cast("int").alias("store_id")).distinct()
        return (ids.join(n, ids.store_id == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select("store_id",
                        F.concat(F.lit("Tienda "), F.col("store_id").cast("string")).alias("name"),
                        F.col("n_name").alias("city"), F.col("r_name").alias("region"),
                        F.concat(F.lit("Calle "), F.col("store_id").cast("string")).alias("address"),
                        F.concat(F.lit("601-"), F.col("store_id").cast("string")).alias("phone"),
                        F.to_date(F.lit("1995-01-01")).alias("opened")))

    def salespeople(self) -> DataFrame:
        s = self.t("supplier")
        return s.select(F.col("s_suppkey").alias("salesperson_id"),
                        F.concat(F.lit("Vendedor"), F.col("s_suppkey").cast("string")).alias("first_name"),
                        F.concat(F.lit("Zona"), F.col("s_nationkey").cast("string")).alias("last_name"),
                        (F.col("s_suppkey") % 10 + 1).cast("int").alias("store_id"),
                        F.to_date(F.lit("1995-01-01")).alias("hired"))

    def customers(self, snapshot: int = 2) -> DataFrame:
        """Customer master.  Snapshot 1 is the earlier load: customers with
        key % 10 = 0 did not exist yet; snapshot 2 rotates the segment of
        key % 7 = 0 and moves key % 11 = 0 to the next nation."""
        c, n, r = self.t("customer"), self.t("nation"), self.t("region")
        k = F.col("c_custkey")
        nat = F.col("c_nationkey")
        seg_src = F.col("c_mktsegment")
        if snapshot == 2:
            nat = F.when(k % 11 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
        c = c.withColumn("nat", nat.cast("int"))
        if snapshot == 1:
            c = c.where(k % 10 != 0)
        seg = map_values(seg_src, SEGMENT_BY_MKT)
        if snapshot == 2:
            seg_arr = F.array(*[F.lit(v) for v in SEGMENT_BY_MKT.values()])
            pos = F.array_position(seg_arr, seg)
            rotated = F.when(pos == 0, seg).otherwise(
                F.element_at(seg_arr, (pos % 5 + 1).cast("int")))
            seg = F.when(k % 7 == 0, rotated).otherwise(seg)
        seg = F.when(k % 67 == 0, F.lit("Premium")).otherwise(seg)
        j = c.join(n, c.nat == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return j.select(
            k.alias("customer_id"),
            F.when(k % 59 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("first_name"),
            F.concat(F.lit("Fam"), F.col("c_nationkey").cast("string")).alias("last_name"),
            F.when(k % 53 == 0, F.lit("DNI")).otherwise(_pick(DOC_TYPES_CYCLE, k % 5)).alias("doc_type"),
            F.when(k % 41 == 0, k - 5).otherwise(k).cast("string").alias("doc_number"),
            F.when(k % 3 == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
             .otherwise(F.col("n_name")).alias("city"),
            F.col("r_name").alias("region"),
            seg.alias("segment"),
            F.date_add(F.to_date(F.lit("1995-01-01")), (k % 365).cast("int")).alias("registered"))

    def products(self, snapshot: int = 2) -> DataFrame:
        """Product master.  Snapshot 1 lacks key % 10 = 0; snapshot 2 raises
        the sale price of key % 9 = 0 by 5 and moves key % 13 = 0 to the
        next category."""
        p = self.t("part")
        k = F.col("p_partkey")
        if snapshot == 1:
            p = p.where(k % 10 != 0)
        cat = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_NAMES]), F.col("p_type")).cast("int")
        if snapshot == 2:
            cat = F.when(k % 13 == 0, cat % 6 + 1).otherwise(cat)
        cost = F.when(k % 47 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).cast("decimal(12,2)")
        sale = F.col("p_retailprice").cast("decimal(12,2)") + F.col("p_size").cast("decimal(12,2)")
        sale = F.when(k % 43 == 0, F.col("p_retailprice").cast("decimal(12,2)")).otherwise(sale)
        if snapshot == 2:
            sale = F.when(k % 9 == 0, sale + F.lit(5).cast("decimal(12,2)")).otherwise(sale)
        code_src = F.when(k % 37 == 0, k - 1).otherwise(k)
        return p.select(
            k.alias("product_id"),
            F.when(k % 101 == 0, F.lit(None))
             .otherwise(F.concat(F.lit("SKU-"), code_src.cast("string"))).alias("code"),
            F.col("p_name").alias("name"), F.col("p_brand").alias("description"),
            F.when(cat == 0, F.lit(None)).otherwise(cat).alias("category_id"),
            sale.cast("decimal(12,2)").alias("sale_price"), cost.alias("cost_price"),
            F.lit("UND").alias("unit"), F.col("p_size").alias("min_stock"))

    # --- transactions ----------------------------------------------------------
    def sales(self) -> DataFrame:
        o = self.t("orders")
        k = F.col("o_orderkey")
        st = F.col("o_orderstatus")
        return o.select(
            k.alias("sale_id"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
            F.when(k % 211 == 0, F.lit(None))
             .when(k % 83 == 0, F.col("o_custkey") + UNKNOWN_ID_OFFSET)
             .otherwise(F.col("o_custkey")).alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("channel_id"),
            F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, F.lit(99))
             .otherwise((k % 5 + 1).cast("int")).cast("int").alias("campaign_id"),
            F.when(k % 97 == 0, F.lit("Desconocido")).when(st == "F", F.lit("Completa"))
             .when(st == "O", F.lit("Pendiente")).when(st == "P", F.lit("Cancelada"))
             .otherwise(st).alias("state"))

    def sale_lines(self) -> DataFrame:
        li = self.t("lineitem")
        k = F.col("l_orderkey")
        return li.select(
            (k * 8 + F.col("l_linenumber")).alias("sale_line_id"),
            k.alias("sale_id"),
            F.when(k % 71 == 0, F.col("l_partkey") + UNKNOWN_ID_OFFSET)
             .otherwise(F.col("l_partkey")).alias("product_id"),
            F.when(k % 307 == 0, F.lit(None))
             .when((k % 61 == 0) & (F.col("l_linenumber") == 1), F.lit(0))
             .otherwise(F.col("l_quantity").cast("int")).cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
            (F.col("l_suppkey") % 10 + 1).cast("int").alias("store_id"),
            F.col("l_suppkey").alias("salesperson_id"))

    def purchases(self) -> DataFrame:
        """Purchase headers at order grain (supplier and store from the order)."""
        o = self.t("orders")
        k = F.col("o_orderkey")
        sup = F.col("o_custkey") % 100
        return o.select(
            k.alias("purchase_id"),
            F.col("o_orderdate").cast("date").alias("purchase_date"),
            F.when(k % 79 == 0, sup + UNKNOWN_ID_OFFSET).otherwise(sup).alias("supplier_id"),
            (k % 10 + 1).cast("int").alias("store_id"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Completa")).otherwise(F.lit("Pendiente"))
             .alias("state"))

    def purchase_lines(self) -> DataFrame:
        li = self.t("lineitem")
        k = F.col("l_orderkey")
        return li.select(
            (k * 8 + F.col("l_linenumber")).alias("purchase_line_id"),
            k.alias("purchase_id"),
            F.col("l_partkey").alias("product_id"),
            F.when((k % 61 == 0) & (F.col("l_linenumber") == 2), F.lit(0))
             .otherwise(F.col("l_quantity").cast("int")).cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"))

    def returns(self) -> DataFrame:
        li = self.t("lineitem").where(F.col("l_returnflag") == "R")
        k = F.col("l_orderkey")
        return li.select(
            (k * 8 + F.col("l_linenumber")).alias("return_id"),
            F.col("l_shipdate").cast("date").alias("return_date"),
            k.alias("sale_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _pick(RETURN_REASONS, F.col("l_linenumber") % 3).alias("reason"),
            F.when(k % 53 == 0, F.lit("Garantia"))
             .when(F.col("l_linenumber") % 2 == 0, F.lit("Proveedor"))
             .otherwise(F.lit("Cliente")).alias("return_type"))

    def daily_inventory(self) -> DataFrame:
        """One row per (ship day, product, store); partial aggregation runs
        before the shuffle."""
        li = self.t("lineitem")
        qty = F.col("l_quantity").cast("int")
        g = (li.groupBy(F.col("l_shipdate").cast("date").alias("inv_date"),
                        F.col("l_partkey").alias("product_id"),
                        (F.col("l_suppkey") % 10 + 1).cast("int").alias("store_id"))
             .agg(F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(0)).cast("int").alias("units_in"),
                  F.sum(F.when(F.col("l_returnflag") != "R", qty).otherwise(0)).cast("int").alias("units_out")))
        opening = (F.col("product_id") % 50 + 20).cast("int")
        closing = opening + F.col("units_in") - F.col("units_out")
        closing = F.when(F.col("product_id") % 50 == 0, closing + 1).otherwise(closing)
        return g.select(
            ((F.year("inv_date") * 10000 + F.month("inv_date") * 100 + F.dayofmonth("inv_date"))
             .cast("long") * 100000000 + F.col("product_id") * 100 + F.col("store_id")).alias("inventory_id"),
            "inv_date", "product_id", "store_id", opening.alias("opening"),
            closing.cast("int").alias("closing"), "units_in", "units_out")

    # --- CSV feeds -------------------------------------------------------------
    def adjustments_csv_rows(self) -> DataFrame:
        """Manual inventory adjustments in the CSV layout (all text-ish)."""
        li = self.t("lineitem")
        k = F.col("l_orderkey")
        d = F.col("l_shipdate").cast("date")
        system = (F.col("l_partkey") % 50 + 20).cast("int")
        adj = (F.col("l_linenumber") - 3).cast("int")
        store = (F.col("l_suppkey") % 10 + 1).cast("int")
        return li.select(
            F.year(d).cast("string").alias("year"), F.month(d).cast("string").alias("month"),
            F.when(k % 101 == 0, F.lit(77)).otherwise(store).cast("int").alias("store_id"),
            F.concat(F.lit("Sucursal "), store.cast("string")).alias("store_name"),
            F.when(k % 89 == 0, F.col("l_partkey") + UNKNOWN_ID_OFFSET)
             .otherwise(F.col("l_partkey")).alias("product_id"),
            (system + adj).alias("physical_stock"), system.alias("system_stock"),
            adj.alias("adjustment"),
            _pick(ADJUSTMENT_REASONS, (k + F.col("l_linenumber")) % 13).alias("reason"))

    def goals_csv_rows(self) -> DataFrame:
        """Monthly goals per store and category in the CSV layout."""
        li, p = self.t("lineitem"), self.t("part")
        d = F.col("l_shipdate").cast("date")
        j = li.join(p, li.l_partkey == p.p_partkey)
        g = (j.groupBy(F.year(d).alias("y"), F.month(d).alias("m"),
                       (F.col("l_suppkey") % 10 + 1).cast("int").alias("store"),
                       F.col("p_type"))
             .agg(F.sum(F.col("l_quantity").cast("int")).cast("long").alias("units")))
        cat_id = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_NAMES]), F.col("p_type")).cast("int")
        name = F.col("p_type")
        csv_name = F.when(name == "LARGE", F.when(F.col("m") % 2 == 0, F.lit("Grande"))
                          .otherwise(F.lit("Gran formato")))
        for src, dst in GOAL_CSV_CATEGORY.items():
            csv_name = csv_name.when(name == src, F.lit(dst))
        csv_name = csv_name.otherwise(name)
        base = (F.col("units") * 110).cast("string")
        h = F.col("y") * 12 + F.col("m") + F.col("store")
        value = (F.when(h % 23 == 0, F.lit("n/d"))
                 .when(h % 29 == 0, F.concat(F.lit("-"), base))
                 .when(h % 31 == 0, F.lit("0")).otherwise(base))
        return g.select(
            F.col("y").cast("string").alias("year"), F.col("m").cast("string").alias("month"),
            F.when((F.col("m") * 7 + F.col("store")) % 37 == 0, F.lit(99))
             .otherwise(F.col("store")).cast("int").alias("store_id"),
            F.concat(F.lit("Sucursal "), F.col("store").cast("string")).alias("store_name"),
            cat_id.alias("category_id"), csv_name.alias("category_name"),
            value.alias("goal_value"))
