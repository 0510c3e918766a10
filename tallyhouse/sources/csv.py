"""CSV feeds: header row, comma separated, UTF-8, declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             corrupt_column: str | None = None) -> DataFrame:
    """Read CSV files with a declared schema (nothing inferred).

    Columns that may hold dirty values are declared as strings and parsed
    later by the rules.  ``mode=PERMISSIVE`` keeps malformed rows (NULL in
    the bad fields; raw text in ``corrupt_column`` if given).  Reading is
    split across files and blocks, so the feed scales with the cluster.
    """
    if corrupt_column:
        schema = StructType([*(schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields,
                             StructField(corrupt_column, StringType())])
    reader = (spark.read.schema(schema).option("header", True).option("sep", ",")
              .option("encoding", "UTF-8").option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as header CSV files under ``path`` (one file per task)."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path
