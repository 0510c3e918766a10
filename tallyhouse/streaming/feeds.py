"""CSV feed folder -> staging table, one micro-batch per run of new files."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ingest_feed(spark: SparkSession, folder: str, schema: StructType,
                transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
                max_files_per_batch: int | None = None) -> int:
    """Process the files that arrived in ``folder`` since the last run.

    ``transform`` is the batch logic (extract + rules).  Each micro-batch is
    written to ``{target}/batch_id=<n>`` with overwrite, so a retried batch
    replaces its own output instead of duplicating it; the stream checkpoint
    (in the shared folder) records which files are done.  Rules that compare
    rows (duplicate detection) see one micro-batch at a time.  Returns the
    number of batches processed in this run (``trigger(availableNow)``).
    """
    reader = (spark.readStream.schema(schema).option("header", True).option("sep", ",")
              .option("encoding", "UTF-8").option("mode", "PERMISSIVE"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    stream = reader.csv(folder)
    done: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        done.append(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(done)
