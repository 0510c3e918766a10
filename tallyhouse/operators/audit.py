"""Source constraints as audit checks.

Spark does not enforce NOT NULL / CHECK / UNIQUE / FOREIGN KEY on write, so
each constraint becomes a check that returns the violating rows; ``audit``
runs a list of checks and returns one row per check with its violation
count.  Row checks on one table are evaluated in a single pass (one
aggregate of ``count_if``); key checks need one aggregate or anti join each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.aggregate import union_all


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str

    def violated(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Check:
    """CHECK constraint: a row violates it when ``predicate`` is FALSE (NULL passes)."""
    name: str
    predicate: Column

    def violated(self) -> Column:
        return ~F.coalesce(self.predicate, F.lit(True))


@dataclass(frozen=True)
class Domain:
    name: str
    column: str
    values: Sequence

    def violated(self) -> Column:
        return ~F.coalesce(F.col(self.column).isin(list(self.values)), F.lit(True))


@dataclass(frozen=True)
class Unique:
    name: str
    columns: Sequence[str]


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: Sequence[str]
    ref: DataFrame = field(compare=False)
    ref_columns: Sequence[str] = ()


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """DEFAULT constraints: a NULL in a column with a declared default takes
    the default (``coalesce``), as an insert that omitted the column would."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


def violations(df: DataFrame, check) -> DataFrame:
    """Rows (or duplicate keys) violating one check."""
    if isinstance(check, (NotNull, Check, Domain)):
        return df.where(check.violated())
    if isinstance(check, Unique):
        # NULLs do not collide, as in a UNIQUE constraint on nullable columns
        nn = reduce_and([F.col(c).isNotNull() for c in check.columns])
        return (df.where(nn).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1"))
    if isinstance(check, ForeignKey):
        ref_cols = list(check.ref_columns) or list(check.columns)
        ref = check.ref.select(*[F.col(r).alias(c) for r, c in zip(ref_cols, check.columns)]).distinct()
        nn = reduce_and([F.col(c).isNotNull() for c in check.columns])
        return df.where(nn).join(ref, list(check.columns), "left_anti")
    raise TypeError(f"unknown check: {check!r}")


def reduce_and(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def audit(df: DataFrame, checks: Sequence, table: str) -> DataFrame:
    """(table, check, violations) for every check."""
    row_checks = [c for c in checks if isinstance(c, (NotNull, Check, Domain))]
    parts = []
    if row_checks:
        agg = df.agg(*[F.count_if(c.violated()).cast("long").alias(f"c{i}")
                       for i, c in enumerate(row_checks)])
        stack = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(row_checks))
        parts.append(agg.selectExpr(f"stack({len(row_checks)}, {stack}) as (check_name, violations)"))
    for c in checks:
        if isinstance(c, (Unique, ForeignKey)):
            v = violations(df, c)
            if isinstance(c, Unique):
                cnt = v.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
            else:
                cnt = v.agg(F.count(F.lit(1)).cast("long").alias("violations"))
            parts.append(cnt.select(F.lit(c.name).alias("check_name"), "violations"))
    return union_all(parts).select(F.lit(table).alias("table_name"), "check_name", "violations")
