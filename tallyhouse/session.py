"""Session helpers: one place for the configuration the build relies on."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the plans assume.  AQE re-plans joins and coalesces
# partitions at run time; skew-join splitting handles hot keys (a store or a
# product holding a third of all rows) without salting by hand.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_CHECKPOINT_FALLBACK = "/tmp/tallyhouse-checkpoints"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tallyhouse", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system; it is read from the
    session, and a cluster without it is an error: each machine would write
    to its own disk.  Only a local master falls back to a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = _LOCAL_CHECKPOINT_FALLBACK
        os.makedirs(path, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session (a stopped and recreated session differs)."""
    return (id(spark), spark.sparkContext.applicationId)


_MB = 1024 * 1024
# Shuffle blocks are compressed and the rows unpacked from them are many times
# larger in a task that sorts or hashes them, so tasks are sized well under
# Spark's 64 MB.  The size of a Parquet table is likewise far from that of its
# rows in a broadcast: without a factor a table of 10 MB was sent as 134 MB.
SIZED = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 * _MB),
         "spark.sql.files.maxPartitionBytes": str(32 * _MB),
         "spark.sql.sources.fileCompressionFactor": "8.0"}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession) -> int:
    """Into how many partitions a shuffle is dealt before AQE coalesces them."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, n, int(spark.conf.get(_INITIAL, None) or 0))


def fit_session(spark: SparkSession, input_bytes: int) -> None:
    """Fit the session to the input: a shuffle is dealt into a partition per 8 MB
    of Parquet (never fewer than the session says), and what ``SIZED`` names is
    set where the session leaves it open.  So a task's share stays the same
    however large the input is."""
    for key, value in SIZED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if input_bytes // (8 * _MB) > shuffle_partitions(spark):
        spark.conf.set(_INITIAL, str(input_bytes // (8 * _MB)))


# A task that writes one bucket need not sort its rows by bucket; with more buckets
# than this it sorts them after all.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


@contextmanager
def scoped(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` while the block runs, where the session leaves them open."""
    set_here = [key for key in settings if spark.conf.get(key, None) is None]
    try:
        for key in set_here:
            spark.conf.set(key, settings[key])
        yield
    finally:
        for key in set_here:
            spark.conf.unset(key)


def cluster_conf(input_bytes: int, executor_cores: int = 1000 * 4) -> dict:
    """Settings for a large cluster, sized from the bytes the biggest job reads.

    Shuffle partitions start at roughly 200 MB of input each (at least two
    waves of the cluster's cores) and AQE coalesces them at run time to
    ``advisoryPartitionSizeInBytes``, so every task's share fits executor
    memory without spilling; skewed partitions above 5x the median (and
    256 MB) are split.  Scan splits are 512 MB of Parquet.  At 100 TB this
    gives ~500 000 initial shuffle partitions coalesced to ~256 MB each.
    """
    partitions = max(2 * executor_cores, input_bytes // (200 * 1024 * 1024))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
