"""Sources (parquet tables, CSV files, literal rows, generated ranges) and sinks."""

from tallyhouse.sources.tables import read_table, stamp  # noqa: F401
from tallyhouse.sources.csv import read_csv, write_csv  # noqa: F401
from tallyhouse.sources.sinks import overwrite, read_current, append_log  # noqa: F401
