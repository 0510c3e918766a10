"""Best-fit packing of tokenised documents after dominance reduction.

Lengths are at most the capacity, so the whole instance is a histogram of
``capacity`` counters whatever the input holds.  On that histogram

1. the reduction of Martello and Toth runs from the longest length down: if a
   sequence made of this length and the longest that still fits beside it
   dominates every other sequence with this length (they fill it exactly, or
   nothing, or nothing but one more piece, fits beside it), such sequences are
   fixed for good, as many as the counters allow, and the instance shrinks;
2. the rest is packed best-fit, longest first: each piece goes to the fullest
   open sequence that takes it.  Equal sequences are handled together.

The result is a bounded list of placements (length, first rank, count,
sequences), which is sent to the tasks; a piece finds its place from its rank
among the pieces of its length.  Ranks come from a counter per task and a sum
over tasks, so a length that a third of all pieces have is never in one task.

A document longer than the capacity is cut; all its pieces but the first are
full.  Defined cases: a null or empty text is the end token alone; repeated
rows are packed each; other columns are not read; an empty table gives an
empty result.  Token ids come from the vocabulary file whose path is given.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "task int, rank long")
_END = (0).to_bytes(4, "little")
# fixed value: how byte-level BPE cuts a text before merging
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encoders: dict[str, Callable[[str], bytes]] = {}


def encoder(path: str) -> Callable[[str], bytes]:
    """A text to its token ids as little-endian unsigned 32-bit integers, as the
    ``tokenizers`` library gives them: strings of added tokens are those tokens.

    Where the ids follow the order of the merges, they are the ranks that a faster
    library merges by; this is looked up, and any other vocabulary is encoded by
    ``byte_pair``."""
    if path not in _encoders:
        from tiktoken import Encoding

        from tallyhouse.llm.byte_pair import Encoder, Vocabulary
        v = Vocabulary(path)
        if (np.diff(v.product) > 0).all() and (not len(v.product) or v.first.max() < v.product[0]):
            known = [bytes(v.bytes[a:a + n]) for a, n in zip(v.starts, v.lengths)]
            ranks = {w: i for i, w in enumerate(known) if w and i not in v.added.values()}
            encode = Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=v.added).encode
            _encoders[path] = lambda text: np.array(encode(text, allowed_special="all"), "<u4").tobytes()
        else:
            use = Encoder(path)
            _encoders[path] = lambda text: use.encode([text])[0].astype("<u4").tobytes()
    return _encoders[path]


def _pieces(path: str, capacity: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            _, offsets = c.utf8(batch.column("text"))
            for a, b in c.row_slices(offsets, 1 << 20):
                rows = []
                for doc, text in zip(*(batch.column(x).slice(a, b - a).to_pylist() for x in ("doc_id", "text"))):
                    tokens = encode(text) + _END
                    n = len(tokens) // 4
                    at, k = 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        rows.append((doc, k, at, size, zlib.crc32(tokens[4 * at:4 * (at + size)]), task, int(seen[size])))
                        seen[size] += 1
                        at, k = at + size, k + 1
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.record_batch([pa.array(x, t) for x, t in zip(cols, kinds)],
                                      names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])
    return pieces


class Placement(tuple):
    """(length, first rank, count, per sequence, first sequence, offset): the
    ranks from ``first rank`` on fill ``count`` places, ``per sequence`` in a row
    in each of the sequences from ``first sequence`` on, from ``offset`` on."""


def dominating(counts: np.ndarray, length: int, capacity: int) -> int:
    """The longest piece that fits beside ``length``, if the two dominate every
    sequence with ``length``; 0 if nothing fits beside it; -1 otherwise."""
    room = capacity - length
    have = np.flatnonzero(counts[:room + 1])
    have = have[(have != length) | (counts[have] > 1)] if length <= room else have
    if not len(have):
        return 0
    best = int(have[-1])
    if best == room:
        return best
    least, left = int(have[0]), int(counts[have[0]]) - (have[0] == length)
    two = 2 * least if left > 1 else least + int(have[1]) if len(have) > 1 else room + 1
    return best if two > room else -1


def plan(counts: np.ndarray, capacity: int) -> list[Placement]:
    """Placements for a histogram of lengths (index 0 is unused)."""
    counts, used, placed, sequences = counts.astype(np.int64).copy(), np.zeros(capacity + 1, np.int64), [], 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        placed.append(Placement((length, int(used[length]), n, each, sequence, offset)))
        used[length] += n
        counts[length] -= n

    for length in range(capacity, 0, -1):  # dominance reduction
        while counts[length]:
            other = dominating(counts, length, capacity)
            if other < 0:
                break
            n = int(counts[length]) if not other else int(
                counts[length] // 2 if other == length else min(counts[length], counts[other]))
            if other == length:
                put(length, 2 * n, 2, sequences, 0)
            else:
                put(length, n, 1, sequences, 0)
                if other:
                    put(other, n, 1, sequences, length)
            sequences += n
    # best fit, longest first; open sequences by the room they have
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, how many)
    rooms: list[int] = []

    def add(space: int, sequence: int, n: int) -> None:
        if space and n:
            if space not in room or not room[space]:
                bisect.insort(rooms, space)
            room[space].append((sequence, n))

    for length in range(capacity, 0, -1):
        i = bisect.bisect_left(rooms, length)
        while counts[length] and i < len(rooms):
            space = rooms.pop(i)
            each, groups, changed = space // length, room.pop(space), []
            while groups and counts[length]:
                sequence, n = groups.pop()
                full = min(n, int(counts[length]) // each)
                if full:
                    put(length, full * each, each, sequence, capacity - space)
                    changed.append((space - each * length, sequence, full))
                rest = int(counts[length])
                if full < n and rest:
                    put(length, rest, rest, sequence + full, capacity - space)
                    changed.append((space - rest * length, sequence + full, 1))
                    full += 1
                if full < n:
                    groups.append((sequence + full, n - full))
            for sequence, n in groups:
                add(space, sequence, n)
            for x in changed:
                add(*x)
            i = bisect.bisect_left(rooms, max(length, space))
            if counts[length] and i < len(rooms) and rooms[i] == space:
                break
        if counts[length]:
            each = capacity // length
            full = int(counts[length]) // each
            if full:
                put(length, full * each, each, sequences, 0)
                add(capacity - each * length, sequences, full)
                sequences += full
            if counts[length]:
                rest = int(counts[length])
                put(length, rest, rest, sequences, 0)
                add(capacity - rest * length, sequences, 1)
                sequences += 1
    return placed


def _place(placed: list[Placement], capacity: int):
    table = np.array(sorted(placed) or np.zeros((0, 6)), np.int64)
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.zeros(len(length), np.int64)
            for size in np.unique(length):
                own = length == size
                a, b = first[size], first[size + 1]
                row[own] = a + np.searchsorted(table[a:b, 1], rank[own], "right") - 1
            _, start, _, each, sequence, offset = table[row].T
            at = rank - start
            yield pa.record_batch(
                [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence + at // each), pa.array(offset + at % each * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


@c.small_reads
@c.small_batches  # what runs after the return sends rows of seven integers
def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = c.id_and_text(docs.withColumn(id_col, docs[id_col].cast("long")), id_col, text_col)
    pieces = pin(rows.mapInArrow(_pieces(vocabulary, capacity), _PIECES), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    # at most one row per task in each of the windows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    # a sort would take pages of many MB in every task; hashed are at most the few starts of its share
    ranked = pieces.join(starts.hint("shuffle_hash"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_place(plan(counts, capacity), capacity),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, "
                             "sequence_id long, offset long")
