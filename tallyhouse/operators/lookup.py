"""Dimension lookups, reference resolution and insert-only loads."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.functions.text import folded, same_text
from tallyhouse.operators.keys import assign_keys, max_key


def lookup(df: DataFrame, dim: DataFrame, on: tuple[str, str], take: Mapping[str, str],
           default=None, how: str = "inner") -> DataFrame:
    """Natural id -> surrogate key (and other columns) of a dimension.

    ``how='inner'`` drops misses; ``how='left'`` with ``default`` maps both
    a NULL id and an unknown id to ``default`` (e.g. -1).
    The dimension is reduced to the needed columns; whether it is broadcast
    is left to the optimiser and AQE, which know its measured size.
    """
    left, right = on
    d = dim.select(F.col(right).alias("__lk"), *[F.col(c).alias(f"__l_{c}") for c in take])
    out = df.join(d, df[left] == d["__lk"], how)
    taken = []
    for c, name in take.items():
        col = F.col(f"__l_{c}")
        if default is not None:
            col = F.coalesce(col, F.lit(default))
        taken.append(col.alias(name))
    keep = [F.col(c) for c in df.columns if c not in take.values()]
    return out.select(*keep, *taken)


def resolve(df: DataFrame, ref: DataFrame, on: tuple, ref_value: str, out_col: str) -> DataFrame:
    """UPDATE ... FROM join: left join, ``out_col`` NULL when unresolved.

    ``on`` = (left expression or column, reference column).  The reference
    is reduced to one row per key first (the smallest value), so staging rows
    are never multiplied.  Text keys match whatever their case and trailing blanks.
    """
    left, right = on
    left_col = F.col(left) if isinstance(left, str) else left
    text = isinstance(ref.schema[right].dataType, StringType)
    r = ref.groupBy((folded(right) if text else F.col(right)).alias("__rk")).agg(F.min(ref_value).alias("__rv"))
    return (df.join(r, (folded(left_col) if text else left_col) == r["__rk"], "left")
            .select(*[F.col(c) for c in df.columns if c != out_col], F.col("__rv").alias(out_col)))


def insert_new(dim: DataFrame | None, incoming: DataFrame, key: Sequence[str] | str,
               sk: str, order_by: Sequence[str] | None = None, mode: str = "insert") -> DataFrame:
    """Insert-only load: append incoming business keys not yet in ``dim``.

    Idempotent: rerunning with the same input adds nothing.  New rows get
    keys after the current maximum, numbered by ``order_by`` (default: the
    business key).  ``mode='upsert'`` also overwrites the attributes of
    existing keys with the incoming values (type-1 change), keeping their
    surrogate keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if mode == "upsert" and dim is not None:
        return _upsert(dim, incoming, keys, sk, order_by)
    if mode not in ("insert", "upsert"):
        raise ValueError(f"mode must be 'insert' or 'upsert', not {mode!r}")
    if dim is None:
        return assign_keys(incoming, sk, order_by or keys)
    new = new_members(dim, incoming, keys, sk, max_key(dim, sk) + 1, order_by)
    return dim.unionByName(new.select(*dim.columns))


def new_members(dim: DataFrame, incoming: DataFrame, keys: Sequence[str], sk: str | None, start: int,
                order_by: Sequence[str] | None = None) -> DataFrame:
    """The incoming rows whose business key is not in ``dim``, numbered from
    ``start`` on: what a load adds (without ``sk``: not numbered)."""
    have = dim.select(*[F.col(k).alias(f"__have_{k}") for k in keys])
    same = [same_text(incoming[k], have[f"__have_{k}"]) if isinstance(incoming.schema[k].dataType, StringType)
            else incoming[k] == have[f"__have_{k}"] for k in keys]
    new = incoming.join(have, reduce(and_, same), "left_anti")
    return assign_keys(new, sk, order_by or list(keys), start=start) if sk else new


def _upsert(dim: DataFrame, incoming: DataFrame, keys: list[str], sk: str,
            order_by: Sequence[str] | None) -> DataFrame:
    """Type-1 merge: one shuffle join on the business key; matched rows take
    the incoming attributes, unmatched dimension rows stay, new keys are
    appended with fresh surrogate keys."""
    attrs = [c for c in dim.columns if c != sk and c not in keys]
    inc = incoming.select(*keys, *[F.col(a).alias(f"__in_{a}") for a in attrs],
                          F.lit(True).alias("__in"))
    j = dim.join(inc, keys, "left")
    updated = j.select(sk, *keys, *[F.when(F.col("__in"), F.col(f"__in_{a}")).otherwise(F.col(a)).alias(a)
                                    for a in attrs])
    new = incoming.join(dim.select(*keys), keys, "left_anti")
    new = assign_keys(new, sk, order_by or keys, start=max_key(dim, sk) + 1)
    return updated.select(*dim.columns).unionByName(new.select(*dim.columns))


def with_unknown(dim: DataFrame, row: Mapping) -> DataFrame:
    """Union the literal unknown-member row (e.g. key -1) into a dimension."""
    spark = dim.sparkSession
    lit_row = spark.range(1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    return lit_row.unionByName(dim)


def pre_agg_join(df: DataFrame, other: DataFrame, left_keys: Sequence, right_keys: Sequence[str],
                 aggs: Mapping[str, object], default=0) -> DataFrame:
    """Left join to ``other`` aggregated on ``right_keys``, missing -> ``default``.

    Aggregating first keeps the join 1:1 (no fan-out) and lets the partial
    aggregate run before the shuffle.  One row a key is left, so that side is
    hashed and neither is sorted.
    """
    agg_exprs = [expr.alias(name) for name, expr in aggs.items()]
    pre = other.groupBy(*[F.col(k).alias(f"__pk{i}") for i, k in enumerate(right_keys)]).agg(*agg_exprs)
    cond = None
    for i, lk in enumerate(left_keys):
        lc = F.col(lk) if isinstance(lk, str) else lk
        c = lc == pre[f"__pk{i}"]
        cond = c if cond is None else cond & c
    out = df.join(pre.hint("shuffle_hash"), cond, "left")
    return out.select(*[F.col(c) for c in df.columns],
                      *[F.coalesce(F.col(name), F.lit(default)).alias(name) for name in aggs])
