"""Shared helpers: columns that do not clash, and vectorised word hashing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row (a bound variable)."""
    return F.transform(F.array(value), lambda bound: body(bound))[0]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; null text is empty.

    Other columns never reach the operators, so their names cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(docs: DataFrame) -> int:
    """Bytes of text in a table (one aggregate row)."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def chunk_count(docs: DataFrame, chunk_bytes: int) -> int:
    """How many chunks of about ``chunk_bytes`` of text the documents fill;
    never fewer than the shuffle partitions, so that all cores have work."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-text_bytes(docs) // chunk_bytes))


def chunk_of(n_chunks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("long")


BATCH_ROWS = 500


def _at_most(key: str, operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator (its first argument is the table) with the rows that ``key``
    sets held to ``BATCH_ROWS`` while it runs; the session's setting is put back."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        conf = docs.sparkSession.conf
        before = conf.get(key)
        rows = int(before)
        conf.set(key, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        try:
            return operator(docs, *args, **kwargs)
        finally:
            conf.set(key, before)
    return run


def small_batches(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator whose Python steps all run before it returns: they get Arrow
    batches of at most ``BATCH_ROWS`` rows.  Spark bounds a batch by rows, not bytes,
    and a task holds one several times over (the vectors, the buffer to be sent, the
    worker's copy), so rows of some kB, as texts and shingle sets are, take hundreds
    of MB at Spark's 10000."""
    return _at_most("spark.sql.execution.arrow.maxRecordsPerBatch", operator)


def small_reads(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator that reads its texts before it returns: Parquet is read in
    batches of at most ``BATCH_ROWS`` rows.  At Spark's 4096 the texts of a batch
    stand in one array of tens of MB, which is copied each time it grows."""
    return _at_most("spark.sql.parquet.columnarReaderBatchSize", operator)


# ---------------------------------------------------------------- byte classes
def byte_class(outside: list[tuple[int, int]]) -> np.ndarray:
    """Table of the bytes that belong to words: all but the given ranges.

    Bytes of multi-byte UTF-8 characters are 0x80 and up, so a class that
    excludes ASCII only can be tested byte by byte."""
    table = np.ones(256, bool)
    for a, b in outside:
        table[a:b + 1] = False
    return table


NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, MASK64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (the base is odd); the table
    kept between calls is bounded, longer ones are made anew."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            have = tuple(np.concatenate(([np.uint64(1)], np.cumprod(
                np.full(size - 1, b, np.uint64), dtype=np.uint64))) for b in (base, inverse))
        if size <= 1 << 23:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on an array of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and each row's start in them (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each (a longer row stands alone)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each row's first word
    (one more at the end).  Words end where their row ends."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[1:][offsets[1:] > 0] - 1
    last[cut] = inside[cut]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums of a polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


_WINDOW_BASE = 0xD6E8FEB86659FD93


def window_hashes(words: np.ndarray, first_word: np.ndarray, size: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all windows of ``size`` words inside one row, and
    the index of each window's first word.  ``first_word``: as from words_of."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = powers(len(words) + 1, _WINDOW_BASE)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:len(words)], out=sums[1:])
        hashes = mix((sums[size:] - sums[:-size]) * down[:n] + np.uint64(size))
    ok = np.ones(n, bool)
    for back in range(1, size):  # windows that would cross into the next row
        cross = first_word[1:-1] - back
        ok[cross[(cross >= 0) & (cross < n)]] = False
    if size > 1:
        # rows shorter than the window: several row starts may fall inside one window
        row_end = np.repeat(first_word[1:], np.diff(first_word))[:n]
        ok &= np.arange(n) + size <= row_end
    at = np.flatnonzero(ok)
    return hashes[at], at


# ------------------------------------------------------- compact binary columns
def pack(values: np.ndarray, differences: bool = False) -> bytes:
    """64-bit integers as compressed bytes: like bytes side by side, so that
    the high ones, which hardly change, take no room.  ``differences`` first
    subtracts each value's predecessor (for sorted values)."""
    values = np.ascontiguousarray(values).view(np.uint64)
    if differences and len(values):
        with np.errstate(over="ignore"):
            values = np.diff(values, prepend=np.uint64(0))
    lanes = values.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(lanes.tobytes())


def unpack(data: bytes, differences: bool = False) -> np.ndarray:
    """The unsigned values that ``pack`` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    values = np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()
    if differences and len(values):
        with np.errstate(over="ignore"):
            values = np.cumsum(values, dtype=np.uint64)
    return values


# ------------------------------------------------------------------ small trees
def read_trees(described: str, names: list[str]) -> list:
    """The trees of a fitted Spark ML tree model, from its description, as
    nested [feature, threshold, left, right] with predictions as leaves."""
    def node(lines: Iterator[str]) -> list | float:
        line = next(lines)
        if line.startswith("Predict"):
            return float(line.split()[-1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = node(lines)
        next(lines)  # the line of the other branch
        return [names[int(feature)], float(threshold), left, node(lines)]

    grown = []
    lines = [x.strip() for x in described.splitlines() if x.strip()]
    starts = [i for i, x in enumerate(lines) if x.startswith(("Tree ", "DecisionTree"))] or [0]
    for a, b in zip(starts, [*starts[1:], len(lines)]):
        grown.append(node(iter(lines[a + 1:b])))
    return grown
