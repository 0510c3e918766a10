"""Dense surrogate keys without a single-task global window.

The rows are range-partitioned on the order, sorted inside each partition and
pinned with a reliable checkpoint in the shared ``spark.checkpoint.dir``
(range bounds come from sampling and must not be recomputed).  A key is then
``start + offset(partition) + position``, where the offsets are the running
sum of per-partition counts - one small row per partition.  The same path is
taken whatever the number of rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import ensure_checkpoint_dir

CODEC = "zstd"  # of the warehouse's own tables: a quarter smaller than snappy
_ROW_BITS = 33  # monotonically_increasing_id = partition << 33 | row


def assign_keys(df: DataFrame, key_col: str, order_cols: Sequence, start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... following ``order_cols``.

    ``order_cols`` should be a total order for a reproducible numbering.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    n = num_partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .checkpoint(eager=True))
    with_pos = (ranged.withColumn("__mid", F.monotonically_increasing_id())
                .withColumn("__pid", F.shiftright(F.col("__mid"), _ROW_BITS))
                .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    # one small row per partition: bounded by the partition count
    counts = sorted((int(r["__pid"]), int(r["n"])) for r in
                    with_pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc))
        acc += cnt
    off_df = spark.createDataFrame(offsets, "__pid long, __off long")
    return (with_pos.join(F.broadcast(off_df), "__pid")
            .withColumn(key_col, (F.lit(start) + F.col("__off") + F.col("__pos")).cast("long"))
            .drop("__mid", "__pid", "__pos", "__off"))


def max_key(df: DataFrame, key_col: str, default: int = 0) -> int:
    """Largest existing key (a one-row aggregate)."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else default


def pin(df: DataFrame, name: str = "pinned", folder: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder (or in
    ``folder``) and read it back: the plan runs once, lineage is cut, and
    later plans get real size statistics (so the optimiser can broadcast a
    small table).  ``codec``: how the files are compressed, else as the session says."""
    import uuid

    from tallyhouse.session import scratch_path
    path = (f"{folder}/{name}-{uuid.uuid4().hex[:8]}" if folder
            else scratch_path(df.sparkSession, name))
    df.write.mode("errorifexists").parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


def pin_bucketed(df: DataFrame, key: str, name: str = "bucketed", folder: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Like ``pin``, with the rows in buckets of ``key`` (hashed, a file each): later
    joins on ``key`` read bucket beside bucket and shuffle neither side.  The one
    shuffle is the one of this write.  The rows are not sorted: Spark makes no use
    of an order inside buckets, and sorting took a third of the time to write them."""
    import uuid

    from tallyhouse.session import UNSORTED, scoped, scratch_path, shuffle_partitions
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:8]}"
    n = buckets or shuffle_partitions(spark)
    path = f"{folder}/{table}" if folder else scratch_path(spark, name)
    with scoped(spark, UNSORTED):
        (df.repartition(n, key).write.format("parquet").bucketBy(n, key)
         .option("path", path).option("compression", CODEC).saveAsTable(table))
    return spark.table(table)
