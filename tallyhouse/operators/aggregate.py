"""Grouping, keep-first, top-N and set helpers."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row per key under a total order.

    ``min(struct(order..., row...))`` per key is an aggregate: each task
    reduces its rows before the shuffle, so a key holding a third of all rows
    never lands whole in one task (a window would)."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c) for c in rest])
    g = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return g.select(*keys, *[F.col(f"__first.__o{i}").alias(c) for i, c in enumerate(order_by)],
                    *[F.col(f"__first.{c}") for c in rest]).select(*df.columns)


def top_n(df: DataFrame, n: int, order_by: Sequence) -> DataFrame:
    """Global top-N: Spark plans TakeOrderedAndProject (per-task top-N then
    merge).  Names sort ascending with NULL last; pass a column for another order."""
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*order).limit(n)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    return union_all(dfs).distinct()
