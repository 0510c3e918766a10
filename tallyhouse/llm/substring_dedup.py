"""Removal of word windows that an earlier document has already.

Rabin-Karp hashes of every window of ``window`` consecutive words are counted
over the corpus in Spark.  A window that also starts in a document with a
smaller id is removed; overlapping windows merge into maximal intervals.

1. Documents are dealt into chunks of a bounded number of bytes by the hash of
   their id.  A chunk sends each distinct window hash once, with the smallest
   id that has it, so a passage that a third of all documents share costs one
   entry per chunk.  Entries travel in sorted, compressed blocks by hash range.
2. One group per hash range (bounded by ``bucket_windows`` entries on average)
   finds the smallest id of every hash, and tells each chunk which of its
   hashes an earlier document outside it has.
3. The chunk meets its documents again and marks the words to remove.

Windows are told apart by 64-bit hashes: among n windows some n^2 / 2^65 pairs
are expected to collide (0.0005 for the 140 million windows of a gigabyte).

Defined cases: a null or empty text has no words; a text shorter than the
window loses nothing; a window that occurs only within one document stays;
rows that repeat an id do not remove each other's windows; a null id counts as
greater than all others; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm import common as c

_NO_ID = np.iinfo(np.int64).max
_BLOCK = "bucket long, chunk long, hashes binary, ids binary"
_EARLIER = "chunk long, hashes binary"
_OUT = "doc_id long, n_words long, n_removed long, kept_text string"
_SLICE = 4 << 20


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _windows(table: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and id of every window of a chunk."""
    data, offsets = c.utf8(table.column("text"))
    ids, hashes, owners = _ids(table), [], []
    for a, b in c.row_slices(offsets, _SLICE):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = c.words_of(part, offsets[a:b + 1] - offsets[a], c.NOT_SPACE)
        h, at = c.window_hashes(c.word_hashes(part, starts, ends), first, window)
        hashes.append(h)
        owners.append(np.repeat(ids[a:b], np.diff(first))[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the smallest id of each."""
    if not len(hashes):
        return hashes, ids
    order = np.argsort(hashes, kind="stable")
    hashes, ids = hashes[order], ids[order]
    at = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    return hashes[at], np.minimum.reduceat(ids, at)


def _blocks(window: int, n_buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        hashes, ids = _smallest(*_windows(table, window))
        bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
        ends = np.append(cuts[1:], len(bucket)) if len(bucket) else []
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a in cuts], pa.int64()),
            "chunk": pa.array([key[0].as_py()] * len(cuts), pa.int64()),
            "hashes": pa.array([c.pack(hashes[a:b], True) for a, b in zip(cuts, ends)], pa.binary()),
            "ids": pa.array([c.pack(ids[a:b]) for a, b in zip(cuts, ends)], pa.binary())})
    return send


def _compare(table: pa.Table) -> pa.Table:
    """For each chunk, its hashes in this range that an earlier document outside it has."""
    hashes = [c.unpack(x.as_py(), True) for x in table.column("hashes")]
    ids = [c.unpack(x.as_py()).view(np.int64) for x in table.column("ids")]
    known, smallest = _smallest(np.concatenate(hashes), np.concatenate(ids))
    chunks, found = [], []
    for chunk, h, own in zip(table.column("chunk").to_pylist(), hashes, ids):
        earlier = h[smallest[np.searchsorted(known, h)] < own]
        if len(earlier):
            chunks.append(chunk)
            found.append(c.pack(earlier, True))
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "hashes": pa.array(found, pa.binary())})


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, n_rows: int) -> pa.Array:
    """The given words of each row, joined by one space, as a string column."""
    size = ends - starts
    gap = np.zeros(len(size), np.int64)
    gap[:-1] = row[1:] == row[:-1]
    to = np.cumsum(size + gap) - size - gap
    out = np.full(int((size + gap).sum()), 0x20, np.uint8)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to, size) + at] = data[np.repeat(starts, size) + at]
    offsets = np.bincount(row + 1, size + gap, n_rows + 1).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        n_rows, pa.py_buffer(np.cumsum(offsets)), pa.py_buffer(out)).cast(pa.string())


def _remove(window: int):
    def remove(docs: pa.Table, earlier: pa.Table) -> pa.Table:
        flagged = [c.unpack(x.as_py(), True) for x in earlier.column("hashes")]
        flagged = np.sort(np.concatenate(flagged)) if flagged else np.zeros(0, np.uint64)
        known, smallest = _smallest(*_windows(docs, window))
        data, offsets = c.utf8(docs.column("text"))
        ids, n_words, n_removed, kept = _ids(docs), [], [], []
        for a, b in c.row_slices(offsets, _SLICE):
            part = data[offsets[a]:offsets[b]]
            starts, ends, first = c.words_of(part, offsets[a:b + 1] - offsets[a], c.NOT_SPACE)
            row = np.repeat(np.arange(b - a), np.diff(first))
            hashes, at = c.window_hashes(c.word_hashes(part, starts, ends), first, window)
            gone = np.zeros(len(starts) + 1, np.int64)
            if len(at):
                hit = at[(smallest[np.searchsorted(known, hashes)] < ids[a:b][row[at]])
                         | c.in_sorted(hashes, flagged)]
                gone[hit] += 1
                gone[hit + window] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            n_words.append(np.diff(first))
            n_removed.append(np.bincount(row[~keep], minlength=b - a))
            kept.append(_joined(part, starts[keep], ends[keep], row[keep], b - a))
        return pa.table({
            "doc_id": docs.column("doc_id"),
            "n_words": np.concatenate(n_words or [np.zeros(0, np.int64)]).astype(np.int64),
            "n_removed": np.concatenate(n_removed or [np.zeros(0, np.int64)]).astype(np.int64),
            "kept_text": pa.chunked_array(kept, pa.string())})
    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   chunk_bytes: int = 8 << 20, bucket_windows: int = 2 << 20) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (the words
    that stay, joined by one space)."""
    rows = c.id_and_text(docs.withColumn(id_col, docs[id_col].cast("long")), id_col, text_col)
    n_bytes = c.text_bytes(rows)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_chunks = max(partitions, -(-n_bytes // chunk_bytes))
    n_buckets = min(max(partitions, n_bytes // (5 * bucket_windows)), 1 << 31)
    chunks = rows.withColumn("chunk", c.chunk_of(n_chunks))
    earlier = (chunks.groupBy("chunk").applyInArrow(_blocks(window, n_buckets), _BLOCK)
               .groupBy("bucket").applyInArrow(_compare, _EARLIER))
    return chunks.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(_remove(window), _OUT)
