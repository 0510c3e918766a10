"""Incremental pick-up of feed files (see ``feeds``).

The source system is a full-refresh batch with no stream processing; the only
arriving data are CSV feed files dropped into a folder.  ``feeds`` reads
that folder with Structured Streaming's file source so each new file is
processed exactly once (progress kept in a checkpoint), with the same
extract and rule functions as the batch path.
"""

from tallyhouse.streaming.feeds import ingest_feed  # noqa: F401
