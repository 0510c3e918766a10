"""Ordered row-quality rules: the first failing rule gives the message.

A rule list is evaluated in one pass per table: every predicate becomes a
branch of one ``coalesce`` column, so a rejected row is never tested again.
Only duplicate rules need a shuffle (the first row per duplicate key among
the rows still pending, found by aggregation and joined back);
reference-existence rules use a left join to the distinct reference ids,
never ``NOT IN`` inside a CASE (which would plan a broadcast nested-loop
join).

Rules about a header need not be tested once per line: ``judged`` finds the
first failing rule at each grain, and ``settle`` lets the verdicts meet in the
order of the rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from tallyhouse import constants as C
from tallyhouse.functions.text import folded
from tallyhouse.operators.keys import CODEC, pin

MSG = "stg_message"
STATUS = "stg_status"
_PENDING_MSG = "__msg"


@dataclass(frozen=True)
class Rule:
    """Reject a pending row when ``predicate`` is true (NULL passes)."""
    message: str
    predicate: Column


@dataclass(frozen=True)
class Dedup:
    """Reject every pending row but the first per ``keys`` (by ``order_by``).

    NULL keys group together, and texts that differ in case or trailing blanks
    only.  Rows that ``order_by`` leaves tied are ordered
    by a hash of their content, and equal rows by a row number, so exactly one
    row per key survives.
    """
    message: str
    keys: Sequence[str]
    order_by: Sequence = field(default_factory=list)


@dataclass(frozen=True)
class Derive:
    """Set ``column`` to ``expr`` on rows still pending at this point.

    Rows already rejected keep ``otherwise`` (default: the current value,
    or NULL for a new column).
    """
    column: str
    expr: Column
    keep_existing: bool = True


def _pending() -> Column:
    return F.col(_PENDING_MSG).isNull()


def apply_rules(df: DataFrame, rules: Sequence, status_col: str = STATUS,
                message_col: str = MSG) -> DataFrame:
    """Evaluate ``rules`` in order and add ``status_col`` / ``message_col``."""
    out = df.withColumn(_PENDING_MSG, F.lit(None).cast("string"))
    msg = F.col(_PENDING_MSG)
    for i, r in enumerate(rules):
        if isinstance(r, Rule):
            msg = F.coalesce(msg, F.when(r.predicate, F.lit(r.message)))
        elif isinstance(r, Dedup):
            out = out.withColumn(_PENDING_MSG, msg)
            out = _dedup(out, r, i)
            msg = F.col(_PENDING_MSG)
        elif isinstance(r, Derive):
            out = out.withColumn(_PENDING_MSG, msg)
            msg = F.col(_PENDING_MSG)
            keep = F.col(r.column) if (r.keep_existing and r.column in out.columns) \
                else F.lit(None)
            out = out.withColumn(r.column, F.when(_pending(), r.expr).otherwise(keep))
        else:
            raise TypeError(f"unknown rule type: {r!r}")
    out = out.withColumn(_PENDING_MSG, msg)
    return (out
            .withColumn(status_col, F.when(_pending(), F.lit(C.VALID)).otherwise(F.lit(C.REJECTED)))
            .withColumn(message_col, F.col(_PENDING_MSG))
            .drop(_PENDING_MSG))


def judged(df: DataFrame, rules: Mapping[int, Rule], name: str) -> DataFrame:
    """Add the verdict of the first failing rule as (rank, message), NULL if all
    pass.  ``rules``: rank in the whole list of rules -> rule, so that verdicts
    found at different grains can be compared."""
    fails = [F.when(rules[k].predicate, F.struct(F.lit(k).alias("rank"), F.lit(rules[k].message).alias("message")))
             for k in sorted(rules)]
    return df.withColumn(name, F.coalesce(*fails))


def settle(df: DataFrame, verdicts: Sequence[str], status_col: str = STATUS,
           message_col: str = MSG) -> DataFrame:
    """Status and message from verdicts of several grains: the lowest rank wins."""
    first = F.least(*verdicts) if len(verdicts) > 1 else F.col(verdicts[0])
    return (df.withColumn(message_col, first["message"])
            .withColumn(status_col, F.when(F.col(message_col).isNull(), F.lit(C.VALID)).otherwise(F.lit(C.REJECTED)))
            .select(*[c for c in df.columns if c not in verdicts], status_col, message_col))


def _dedup(out: DataFrame, r: Dedup, i: int) -> DataFrame:
    """Mark every pending row but the first per key as duplicate.

    The first row per key is found with ``min(struct(order))`` - an aggregate,
    combined partially before the shuffle - and joined back on the key with
    NULL-safe equality (NULL keys group together).  Unlike a window, neither
    step puts a hot key (a third of all rows) into one task: the join's big
    side is split by AQE's skew handling.

    The rows are pinned once with a row number, which ends the order: both
    sides read the same numbers, and the rules before run once.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in r.order_by] or \
        [F.col(k) for k in r.keys]
    okey = f"__ord{i}"
    row = f"__row{i}"
    out = pin(out.withColumn(row, F.monotonically_increasing_id()), "staging", codec=CODEC)
    content = F.xxhash64(*[F.col(c) for c in out.columns if c != row])
    out = out.withColumn(okey, F.struct(*order, content, F.col(row)))
    firsts = (out.where(_pending())
              .groupBy(*[_comparable(out, k).alias(f"__dk{i}_{j}") for j, k in enumerate(r.keys)])
              .agg(F.min(okey).alias(f"__first{i}")))
    cond = None
    for j, k in enumerate(r.keys):
        c = _comparable(out, k).eqNullSafe(firsts[f"__dk{i}_{j}"])
        cond = c if cond is None else cond & c
    joined = out.join(firsts, cond & _pending(), "left")
    dup = _pending() & ~F.col(okey).eqNullSafe(F.col(f"__first{i}"))
    cols = [F.when(dup, F.lit(r.message)).otherwise(F.col(_PENDING_MSG)).alias(_PENDING_MSG)
            if c == _PENDING_MSG else F.col(c) for c in out.columns if c not in (okey, row)]
    return joined.select(*cols)


def _comparable(df: DataFrame, name: str) -> Column:
    """A column as it is compared: texts under the warehouse's collation."""
    return folded(df[name]) if isinstance(df.schema[name].dataType, StringType) else df[name]


def ref_flag(df: DataFrame, ref: DataFrame, col: str, ref_col: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: true when ``col`` is NULL or exists in ``ref``.

    Same truth table as ``col NOT IN (SELECT ref_col ...)`` used as a
    rejection test: a NULL id is never rejected.  The reference side is
    reduced to its distinct ids first (partial aggregation before the
    shuffle); the join strategy is left to the optimiser and AQE, which
    broadcast it only when its measured size is below the threshold.
    """
    ids = (ref.select(F.col(ref_col).alias("__ref_id")).where(F.col("__ref_id").isNotNull())
           .distinct().withColumn("__hit", F.lit(True)))
    joined = df.join(ids, df[col] == ids["__ref_id"], "left")
    return (joined.withColumn(flag, F.col(col).isNull() | F.col("__hit").isNotNull())
            .drop("__ref_id", "__hit"))


def missing_ref(flag: str) -> Column:
    """Predicate for a Rule: the id was given and not found."""
    return ~F.col(flag)


def valid(df: DataFrame, status_col: str = STATUS) -> DataFrame:
    return df.where(F.col(status_col) == F.lit(C.VALID))


def status_counts(df: DataFrame, status_col: str = STATUS) -> DataFrame:
    """One row: total, valid, rejected (a single aggregate, no second scan)."""
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("total_rows"),
        F.sum(F.when(F.col(status_col) == C.VALID, 1).otherwise(0)).cast("long").alias("valid_rows"),
        F.sum(F.when(F.col(status_col) == C.REJECTED, 1).otherwise(0)).cast("long").alias("rejected_rows"),
    )
