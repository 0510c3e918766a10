"""A run over a stored warehouse: what each step reads, and dimension loads.

A step reads the source or tables.  A table is the one this run has written, or
else the version of the last committed manifest, so a single step can be run
again on its own: nothing upstream of its inputs is read.  (A table that no run
has ever written is worked out from the source, without being stored.)

Dimensions are state: a load reads the stored version and adds to it.  The
insert-only ones get a further part with the new members; the SCD2 ones keep
closed and current versions apart (``operators.scd2.scd2_load``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import CODEC, assign_keys, pin
from tallyhouse.operators.lookup import new_members, with_unknown
from tallyhouse.operators.rules import valid
from tallyhouse.operators.scd2 import Classified, scd2_load
from tallyhouse.plans import dims, facts
from tallyhouse.plans.standin import CALENDAR_END, CALENDAR_START, SCD_BASE_DATE, SCD_CHANGE_DATE
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.sinks import Store, Version, commit_parts


@dataclass(frozen=True)
class Counts:
    """What the log says of a step."""

    written: int
    read: int
    loaded: int
    rejected: int = 0


class Run(Warehouse):
    """One run into the folder ``base``: the state of the sources (``snapshot``),
    the date of the load, and the committed state it was built on."""

    def __init__(self, spark: SparkSession, sf_dir: str, base: str, snapshot: int = 2,
                 load_date: str = SCD_CHANGE_DATE, **options) -> None:
        super().__init__(spark, sf_dir, snapshot=snapshot, **options)
        self.load_date = load_date
        self.store = Store(spark, base)
        self.built_on = self.store.latest()
        self.changed: dict[str, Version] = {}
        self._frames: dict[str, DataFrame] = {}

    def version(self, name: str) -> Version | None:
        return self.changed.get(name) or self.built_on.tables.get(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            version = self.version(name)
            self._frames[name] = (self.store.read(name, version) if version
                                  else pin(self.plan(name), name, self.folder, CODEC))
        return self._frames[name]

    def plan(self, name: str) -> DataFrame:
        """A table worked out from what this run reads, not yet written."""
        if name in _PLANS:
            return _PLANS[name](self)
        build = getattr(Warehouse, name).func
        return getattr(build, "plan", build)(self)

    def wrote(self, name: str, version: Version) -> None:
        """Make ``version`` the one that later steps read, and the table's own latest."""
        if version != self.version(name):
            commit_parts(self.spark, self.store.path(name), version.all_parts())
        self.changed[name] = version
        self._frames.pop(name, None)

    def commit(self) -> None:
        """Publish everything this run has written as the next state."""
        self.built_on = self.store.commit(self.built_on, self.changed)

    # --- dimension loads --------------------------------------------------------
    def load_members(self, name: str, incoming: DataFrame, kind: dims.Members, read: int | None) -> Counts:
        """Add the members that the stored dimension does not have.  ``read``:
        rows of the source; None: only what is added counts as read."""
        version = self.version(name)
        if version is None:
            new = assign_keys(incoming, kind.sk, list(kind.key))
        else:
            new = new_members(self.table(name), incoming, kind.key, kind.sk, version.max_key + 1)
        return self._add(name, version, new.select(*kind.columns), read, kind.unknown if version is None else None)

    def _add(self, name: str, version: Version | None, new: DataFrame, read: int | None, unknown=None) -> Counts:
        seen = Observation(f"new_{name}_{uuid.uuid4().hex[:8]}")
        new = new.observe(seen, F.count(F.lit(1)).alias("n"))
        part = self.store.write(with_unknown(new, unknown) if unknown else new, name)
        n = int(seen.get["n"])
        if version is None or n:
            have = version or Version({"all": []})
            self.wrote(name, Version({"all": [*have.parts["all"], part]}, have.max_key + n))
        else:
            self.wrote(name, version)
        return Counts(n + (1 if unknown else 0), n if read is None else read, n)

    def load_calendar(self) -> Counts:
        """Add the days that the stored calendar does not have."""
        version = self.version("dim_date")
        days = dims.calendar(self.spark, CALENDAR_START, CALENDAR_END, self.table("dim_date") if version else None)
        return self._add("dim_date", version, days, None)

    def load_scd2(self, name: str, staging: str, incoming: DataFrame, kind: dict) -> Counts:
        version, c = scd2_load(self.store, name, self.version(name), incoming, run_date=self.load_date,
                               base_date=SCD_BASE_DATE, **kind)
        self.wrote(name, version)
        return Counts(c.inserted(), valid(self.table(staging)).count(), _loaded(c))

    def geography_rows(self) -> DataFrame:
        s = self.src
        return dims.geography_rows(s.customers(self.snapshot), s.stores(), s.suppliers())


def _loaded(c: Classified) -> int:
    """New members and closed versions."""
    return c.new + c.changed


for _name in Warehouse.TABLES:
    setattr(Run, _name, property(lambda self, _n=_name: self.table(_n)))

# Plans that differ from those of a warehouse built in one go.
_PLANS = {
    "dim_geography": lambda r: dims.GEOGRAPHY.load(None, r.geography_rows()),
    "dim_customer": lambda r: dims.customer_scd2(None, r.stg_customers, r.dim_geography, r.load_date, SCD_BASE_DATE),
    "dim_product": lambda r: dims.product_scd2(None, r.stg_products, r.load_date, SCD_BASE_DATE),
    "fact_inventory": lambda r: facts.inventory_fact(r.stg_inventory, r.stg_adjustments, r.dim_product, r.dim_store),
}

# How a run loads each dimension.
LOADS = {
    "dim_date": lambda r: r.load_calendar(),
    "dim_geography": lambda r: r.load_members("dim_geography", r.geography_rows(), dims.GEOGRAPHY, None),
    "dim_promotion": lambda r: r.load_members(
        "dim_promotion", r.src.campaigns().select("campaign_id", "name", "kind", "start_date", "end_date"),
        dims.PROMOTION, r.src.campaigns().count()),
    "dim_channel": lambda r: r.load_members(
        "dim_channel", r.src.channels().select("channel_id", "name", "description"), dims.CHANNEL,
        r.src.channels().count()),
    "dim_supplier": lambda r: r.load_members(
        "dim_supplier", dims.supplier_rows(r.src.suppliers(), r.dim_geography), dims.SUPPLIER,
        r.src.suppliers().count()),
    "dim_store": lambda r: r.load_members(
        "dim_store", dims.store_rows(r.src.stores(), r.dim_geography), dims.STORE, r.src.stores().count()),
    "dim_salesperson": lambda r: r.load_members(
        "dim_salesperson", dims.salesperson_rows(r.src.salespeople(), r.dim_store), dims.SALESPERSON,
        r.src.salespeople().count()),
    "dim_customer": lambda r: r.load_scd2(
        "dim_customer", "stg_customers", dims.customer_rows(r.stg_customers, r.dim_geography), dims.CUSTOMER),
    "dim_product": lambda r: r.load_scd2(
        "dim_product", "stg_products", dims.product_rows(r.stg_products), dims.PRODUCT),
}
