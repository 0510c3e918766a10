"""Type-2 slowly changing dimensions and the as-of (validity interval) join.

Parquet has no MERGE, so a load writes what changes: current rows are compared
with the incoming valid rows in one full outer join on the business key, and
new versions are added with fresh surrogate keys.  ``scd2_apply`` gives the
whole next dimension as a DataFrame; ``scd2_load`` keeps a stored one, where
closed versions are never read or written again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from tallyhouse.functions.text import folded
from tallyhouse.operators.keys import CODEC, assign_keys, max_key, pin
from tallyhouse.sources.sinks import Store, Version

NEW, CHANGED, AGAIN, KEPT, HELD = "new", "changed", "again", "kept", "held"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"


@dataclass(frozen=True)
class Classified:
    """The outcome of comparing current versions with incoming rows, written
    once: what is read from it below re-runs neither side."""

    rows: DataFrame          # __k, kind, __old (the current version), __new (the incoming row)
    new: int                 # keys never seen
    changed: int             # current versions to be closed, each with a successor
    again: int               # known keys that had no current version
    kept: int                # current versions that stay as they are

    def inserted(self) -> int:
        return self.new + self.changed + self.again


def classify(current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str],
             attrs: Sequence[str], require: Sequence[str] = (), known: DataFrame | None = None) -> Classified:
    """Compare current versions with incoming rows in one full outer join on the
    business key (one shuffle of each side), with the counts observed while the
    result is written.  ``known``: keys (as ``__k``) that have been seen but may
    have no current version.  Incoming rows without a key are left out."""
    payload = list(dict.fromkeys([*attrs, *require]))
    new = incoming.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"), F.struct(*payload).alias("__new"))
    old = current.select(F.col(key).alias("__k"), F.struct(*current.columns).alias("__old"))
    if known is None:
        new = new.withColumn("__known", F.lit(False))
    else:
        new = new.join(known.select("__k").distinct().withColumn("__known", F.lit(True)), "__k", "left")
    sound = F.lit(True)
    for r in require:
        sound = sound & F.col(f"__new.{r}").isNotNull()
    differs = F.lit(False)
    for t in tracked:
        text = isinstance(current.schema[t].dataType, StringType)  # other case or trailing blanks: no change
        a, b = (folded(f"{x}.{t}") if text else F.col(f"{x}.{t}") for x in ("__old", "__new"))
        differs = differs | F.coalesce(a != b, F.lit(False))
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    kind = (F.when(has_old & has_new & differs & sound, F.lit(CHANGED)).when(has_old, F.lit(KEPT))
            .when(sound & F.coalesce("__known", F.lit(False)), F.lit(AGAIN)).when(sound, F.lit(NEW))
            .otherwise(F.lit(HELD)))
    seen = Observation(f"scd2_{uuid.uuid4().hex[:8]}")
    rows = old.join(new, "__k", "full_outer").withColumn("kind", kind).drop("__known").observe(
        seen, *[F.count_if(F.col("kind") == k).alias(k) for k in (NEW, CHANGED, AGAIN, KEPT)])
    rows, n = pin(rows, "classified", codec=CODEC), seen.get
    return Classified(rows, n[NEW], n[CHANGED], n[AGAIN], n[KEPT])


def closed_versions(c: Classified, columns: Sequence[str], run_date: str) -> DataFrame:
    """The versions that end the day before ``run_date``."""
    return c.rows.where(F.col("kind") == CHANGED).select("__old.*").withColumn(
        VALID_TO, F.date_sub(F.lit(run_date).cast("date"), 1)).withColumn(
        IS_CURRENT, F.lit(False)).select(*columns)


def kept_versions(c: Classified, columns: Sequence[str]) -> DataFrame:
    return c.rows.where(F.col("kind") == KEPT).select("__old.*").select(*columns)


def inserted_versions(c: Classified, columns: Sequence[str], sk: str, key: str, run_date: str,
                      base_date: str, start: int) -> DataFrame:
    """New versions with keys from ``start`` on: new members first, then
    successors, each by business key.  Only these rows are numbered."""
    rows = c.rows.where(F.col("kind").isin(NEW, CHANGED, AGAIN))
    rows = rows.select(
        F.col("__k"), (F.col("kind") != NEW).cast("int").alias("__phase"), "__new.*").withColumns({
            key: F.col("__k"),
            VALID_FROM: F.when(F.col("__phase") == 0, F.lit(base_date)).otherwise(F.lit(run_date)).cast("date"),
            VALID_TO: F.lit(None).cast("date"), IS_CURRENT: F.lit(True)})
    return assign_keys(rows, sk, ["__phase", "__k"], start=start).select(*columns)


def scd2_apply(dim: DataFrame | None, incoming: DataFrame, sk: str, key: str,
               tracked: Sequence[str], attrs: Sequence[str], run_date: str,
               base_date: str, require: Sequence[str] = ()) -> DataFrame:
    """Next version of an SCD2 dimension.

    * key never seen -> insert, valid from ``base_date``, open, current;
    * current version with a tracked attribute ``<>`` the incoming value
      (NULL on either side is no change) -> close it (valid to
      ``run_date - 1``) and insert a version valid from ``run_date``;
    * key known but without a current version -> insert from ``run_date``;
    * unchanged or absent from ``incoming`` -> untouched.

    ``require`` lists incoming columns that must be non-NULL for a version
    to be inserted (e.g. a resolved geography key).  A changed row whose
    successor cannot be inserted is not closed, so a key never loses its
    current version.  ``attrs`` are all payload columns (tracked included);
    untracked attributes are never refreshed on unchanged keys.
    """
    if dim is None:
        dim = empty_dimension(incoming, sk, key, attrs, require)
        c = classify(dim, incoming, key, tracked, attrs, require)
        return pin(inserted_versions(c, dim.columns, sk, key, run_date, base_date, 1), "scd2", codec=CODEC)
    columns, past = dim.columns, dim.where(~F.col(IS_CURRENT))
    c = classify(dim.where(F.col(IS_CURRENT)), incoming, key, tracked, attrs, require,
                 known=past.select(F.col(key).alias("__k")))
    out = past.unionByName(kept_versions(c, columns)).unionByName(closed_versions(c, columns, run_date))
    if c.inserted():
        out = out.unionByName(inserted_versions(c, columns, sk, key, run_date, base_date, max_key(dim, sk) + 1))
    # the next version is a table in its own right: pin it (written to the
    # shared folder), so facts joining it neither re-run the comparison with
    # staging nor carry its lineage
    return pin(out, "scd2", codec=CODEC)


def empty_dimension(incoming: DataFrame, sk: str, key: str, attrs: Sequence[str],
                    require: Sequence[str] = ()) -> DataFrame:
    """A dimension without rows, with the columns of the first load."""
    columns = [key] + [a for a in attrs if a != key] + [r for r in require if r not in attrs]
    return incoming.limit(0).select(
        F.lit(0).cast("long").alias(sk), *columns, F.lit(None).cast("date").alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO), F.lit(True).alias(IS_CURRENT))


def scd2_load(store: Store, table: str, version: Version | None, incoming: DataFrame, sk: str, key: str,
              tracked: Sequence[str], attrs: Sequence[str], run_date: str, base_date: str,
              require: Sequence[str] = ()) -> tuple[Version, Classified]:
    """One load of a stored dimension, whose versions stand in two kinds of
    parts: ``closed`` and ``current``.

    Only the current ones are read and written anew (every known key has one);
    versions that close now become a further closed part, and parts closed by
    earlier loads are neither read nor touched.  A load that changes nothing
    writes nothing and returns the version it was given.
    """
    first = version is None
    current = (empty_dimension(incoming, sk, key, attrs, require) if first
               else store.read(table, version, ["current"]))
    version = version or Version({"closed": [], "current": []})
    c = classify(current, incoming, key, tracked, attrs, require)
    if not first and not c.inserted():
        return version, c
    columns, parts = current.columns, dict(version.parts)
    added = inserted_versions(c, columns, sk, key, run_date, base_date, version.max_key + 1)
    if c.changed:
        parts["closed"] = [*parts["closed"], store.write(closed_versions(c, columns, run_date), table, "closed")]
    parts["current"] = [store.write(kept_versions(c, columns).unionByName(added), table, "current")]
    return Version(parts, version.max_key + c.inserted()), c


def as_of_join(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, at,
               take: Mapping[str, str], how: str = "inner",
               start: str = VALID_FROM, end: str = VALID_TO) -> DataFrame:
    """Join each row to the dimension version valid at ``at``.

    Equality on the business key plus ``start <= at`` and
    ``(end IS NULL OR at <= end)``.  The optimiser plans an equi-join on the
    key with the interval as a residual filter (hash or sort-merge, never a
    nested loop); versions per key are disjoint, so at most one matches.
    The optimiser and AQE broadcast a small dimension (no shuffle of the events);
    a large one is shuffled on the key, and AQE splits a hot key's partition.
    ``take`` maps dimension columns to output names.
    """
    at_col: Column = F.col(at) if isinstance(at, str) else at
    d = dim.select(F.col(right_key).alias("__dk"), F.col(start).alias("__ds"),
                   F.col(end).alias("__de"),
                   *[F.col(c).alias(f"__d_{c}") for c in take])
    cond = ((df[left_key] == d["__dk"]) & (at_col >= d["__ds"]) &
            (d["__de"].isNull() | (at_col <= d["__de"])))
    out = df.join(d, cond, how)
    return out.select(*[F.col(c) for c in df.columns if c not in take.values()],
                      *[F.col(f"__d_{c}").alias(name) for c, name in take.items()])


def as_of_join_by_month(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, at,
                        take: Mapping[str, str], how: str = "inner",
                        start: str = VALID_FROM, end: str = VALID_TO) -> DataFrame:
    """``as_of_join`` for keys with very many versions (a price that changes
    every day), where comparing each row with all versions of its key would grow
    with the square of the key.

    Versions are cut by key and month: a month holds those that begin in it and
    the one carried over from before, if it is still valid.  A row is joined on
    (key, month), so it meets at most one version a day and the carried one, and a
    key's versions spread over tasks by month.  Only one version per month goes
    into the window that carries them on, so its groups are bounded by the
    calendar; versions are carried into months that have rows, no others.

    Versions of a key must be disjoint; an empty one (its end before its start)
    matches nothing.  Rows without a key or a date match nothing, and stay if
    ``how`` is ``left``.
    """
    at_col: Column = F.col(at) if isinstance(at, str) else at
    names = [f"__d_{c}" for c in take]
    versions = (dim.select(F.col(right_key).alias("__dk"), F.trunc(start, "month").alias("__dm"),
                           F.col(start).alias("__ds"), F.col(end).alias("__de"),
                           *[F.col(c).alias(n) for c, n in zip(take, names)])
                .where("__dk IS NOT NULL AND __ds IS NOT NULL AND (__de IS NULL OR __de >= __ds)"))
    held = F.struct("__ds", "__de", *names)
    last = versions.groupBy("__dk", "__dm").agg(F.max_by(held, "__ds").alias("__last"))
    asked = (df.select(F.col(left_key).alias("__dk"), F.trunc(at_col, "month").alias("__dm"))
             .where("__dk IS NOT NULL AND __dm IS NOT NULL").distinct().withColumn("__asked", F.lit(True)))
    before = Window.partitionBy("__dk").orderBy("__dm").rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.join(asked, ["__dk", "__dm"], "full_outer")
               .withColumn("__v", F.last("__last", ignorenulls=True).over(before))
               .where("__asked AND __v IS NOT NULL AND (__v.__de IS NULL OR __v.__de >= __dm)")
               .select("__dk", "__dm", "__v.*"))
    slices = versions.unionByName(carried)
    rows = df.withColumns({"__at": at_col, "__am": F.trunc(at_col, "month")})
    out = rows.join(slices, (rows[left_key] == slices["__dk"]) & (rows["__am"] == slices["__dm"])
                    & (rows["__at"] >= slices["__ds"])
                    & (slices["__de"].isNull() | (rows["__at"] <= slices["__de"])), how)
    return out.select(*[F.col(c) for c in df.columns if c not in take.values()],
                      *[F.col(n).alias(name) for n, name in zip(names, take.values())])


def versions_of(changes: DataFrame, key: str, day: str) -> DataFrame:
    """Dated values (one row per key and day) as versions: each is valid from its
    day to the day before the key's next one, the last without an end."""
    next_day = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    return changes.withColumns({VALID_FROM: F.col(day), VALID_TO: F.date_sub(next_day, 1)}).drop(day)
