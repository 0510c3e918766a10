"""Quality report (Q-1..Q-3) and load reconciliation (Q-4).

All staging tables are tagged and unioned once, then grouped once: one scan
of each table instead of one per panel row.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.functions.numeric import exact_pct
from tallyhouse.operators.aggregate import union_all
from tallyhouse.operators.rules import MSG, STATUS


def _tagged(tables: Mapping[str, DataFrame], *cols: str) -> DataFrame:
    return union_all([df.select(F.lit(name).alias("table_name"), *cols)
                      for name, df in tables.items()])


def quality_summary(stg_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Panel 1: per staging table total / valid / rejected / reject %.

    One seed row per table (with a NULL status, which no measure counts)
    keeps an empty table in the panel with total 0, NULL sums and a NULL
    rate, as a per-table aggregate over no rows gives."""
    spark = next(iter(stg_tables.values())).sparkSession
    seeds = spark.createDataFrame([(n, None) for n in stg_tables],
                                  f"table_name string, {STATUS} string")
    t = _tagged(stg_tables, STATUS).unionByName(seeds)
    status = F.col(STATUS)
    g = t.groupBy("table_name").agg(
        F.count(status).cast("long").alias("total_rows"),
        F.sum(F.when(status == C.VALID, 1).when(status.isNotNull(), 0)).cast("long").alias("valid_rows"),
        F.sum(F.when(status == C.REJECTED, 1).when(status.isNotNull(), 0)).cast("long").alias("rejected_rows"))
    return (g.withColumn("reject_pct", exact_pct("rejected_rows", "total_rows", 12, "decimal(5,2)", times_first=True))
            .orderBy(F.desc_nulls_last("reject_pct"), "table_name"))


def quality_reasons(stg_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Panel 2: rejection reasons with counts, per table."""
    t = _tagged(stg_tables, STATUS, MSG).where(F.col(STATUS) == C.REJECTED)
    return (t.groupBy("table_name", F.col(MSG).alias("message"))
            .agg(F.count(F.lit(1)).cast("long").alias("rejected_rows"))
            .orderBy("table_name", F.desc("rejected_rows"), "message"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Panel 3: row count per table (one small aggregate each)."""
    return union_all([df.agg(F.count(F.lit(1)).cast("long").alias("total_rows"))
                      .select(F.lit(name).alias("table_name"), "total_rows")
                      for name, df in tables.items()])


def status_counts(stg_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (table, status) - the final counts of the validation step."""
    t = _tagged(stg_tables, STATUS)
    return t.groupBy("table_name", STATUS).agg(F.count(F.lit(1)).cast("long").alias("rows"))


def load_reconciliation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Q-4: per fact, rows read (valid staging rows), rows loaded (fact rows)
    and rejected = read - loaded.  Read counts include rows a fact filters
    out on purpose (e.g. sales not completed), as in the source system."""
    parts = []
    for name, (read, loaded) in pairs.items():
        parts.append(read.select(F.lit(name).alias("fact_name"), F.lit(1).alias("r"), F.lit(0).alias("l")))
        parts.append(loaded.select(F.lit(name).alias("fact_name"), F.lit(0).alias("r"), F.lit(1).alias("l")))
    g = union_all(parts).groupBy("fact_name").agg(F.sum("r").cast("long").alias("rows_read"),
                                                  F.sum("l").cast("long").alias("rows_loaded"))
    return g.withColumn("rows_rejected", F.col("rows_read") - F.col("rows_loaded"))
