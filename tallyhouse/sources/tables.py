"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan ``{base}/{name}.parquet``; column pruning and filter pushdown are
    left to the optimiser (projections and filters reach the Parquet scan).
    The files are listed anew, so those added since the last call are read."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def stamp(df: DataFrame, source: str, loaded_at: str) -> DataFrame:
    """Audit columns of a staging row: source name and load time (a run
    parameter, never the wall clock, so reruns are reproducible)."""
    return (df.withColumn("stg_source", F.lit(source))
            .withColumn("stg_loaded_at", F.lit(loaded_at).cast("timestamp")))
