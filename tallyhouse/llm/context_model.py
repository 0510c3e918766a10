"""Language-model score by context-tree weighting over bytes.

Every byte is eight binary decisions; each decision node has a context tree
over the preceding ``depth`` bytes.  A tree node holds a Krichevsky-Trofimov
estimate of its bits, and the weighted probability of a node is the mean of
its own estimate and the product over its children, so all depths take part
with the weights that the training texts give them.  A text is scored with
the trained trees: along the context path the estimates are mixed with the
posterior weights, and the path ends at the deepest context that training
texts have.  A text is its bytes (A-Z in lower case) and an end.

How the work is spread:

1. Documents are dealt into chunks of bounded size by the hash of their id.  A
   chunk sends its distinct (context, byte) entries with their training counts.
2. Entries are grouped by the hash of the last two context bytes: the subtree
   below them is weighted bottom-up in one group, which has the distinct
   entries only.  The levels above (at most 65,793 contexts of 255 nodes,
   whatever the input) meet in one task, which returns the weight that is left
   for each subtree.
3. The same groups then answer each chunk's entries with log probabilities,
   and the chunk scores its documents with them.

Words are counted the same way, for the base score: the unigram model with
add-one smoothing over words and text ends.

Words are told apart by 64-bit hashes.  Defined cases: a null or empty text is
the end alone; without training texts every bit is one half and all words are
unknown; repeated rows are scored (and learned from) each; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

_END = 0xFF  # occurs in no UTF-8 text
_END_WORD = np.uint64(0x5DEECE66D1234567)
_WINDOW = 1 << 20
_SPLIT = 2  # context bytes that choose the group
_LOG_HALF = np.log(0.5)
_BLOCK = "kind int, bucket long, chunk long, keys binary, counts binary"
_ANSWER = "chunk long, kind int, bucket long, keys binary, data binary"
_SCORED = ("doc_id long, train boolean, n_tokens long, n_known long, known_log double, score double, "
           "n_bytes long, own_words long")


# ------------------------------------------------------------ texts of a chunk
class _Texts:
    """The documents of a chunk as one byte sequence: each text, its end, and
    ``depth`` - 1 more end bytes, so that every text starts in the same context."""

    def __init__(self, table: pa.Table, depth: int) -> None:
        data, offsets = c.utf8(table.column("text"))
        sizes = np.diff(offsets)
        self.depth, self.sizes = depth, sizes
        self.train = table.column("train").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        self.starts = depth + np.concatenate(([0], np.cumsum(sizes + depth)[:-1])).astype(np.int64)
        self.buffer = np.full(depth + int((sizes + depth).sum()), _END, np.uint8)
        self.weight = np.zeros(len(self.buffer), np.int8)  # 0: not scored, 1: scored, 2: learned from
        for at, a, n, learn in zip(self.starts, offsets[:-1], sizes, self.train):
            self.buffer[at:at + n] = c.LOWER[data[a:a + n]]
            self.weight[at:at + n + 1] = 2 if learn else 1
        self.data, self.offsets = data, offsets

    def entries(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Scored positions and their entries: the context bytes and the byte itself."""
        for a in range(self.depth, len(self.buffer), _WINDOW):
            b = min(a + _WINDOW, len(self.buffer))
            entry = np.zeros(b - a, np.uint64)
            for back in range(self.depth, -1, -1):
                entry = (entry << np.uint64(8)) | self.buffer[a - back:b - back].astype(np.uint64)
            scored = np.flatnonzero(self.weight[a:b])
            yield scored + a, entry[scored]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every token (text by text, its end last), and each text's row number."""
        hashes, rows = [], []
        for a, b in c.row_slices(self.offsets, _WINDOW):
            part = c.LOWER[self.data[self.offsets[a]:self.offsets[b]]]
            starts, ends, first = c.words_of(part, self.offsets[a:b + 1] - self.offsets[a], c.NOT_SPACE)
            hashes += [c.word_hashes(part, starts, ends), np.full(b - a, _END_WORD)]
            rows += [np.repeat(np.arange(a, b), np.diff(first)), np.arange(a, b)]
        if not rows:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(hashes), np.concatenate(rows)


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64)


def _word_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _entry_bucket(entries: np.ndarray, n: int) -> np.ndarray:
    last = (entries >> np.uint64(8)) & np.uint64((1 << 8 * _SPLIT) - 1)
    return (c.mix(last + np.uint64(1)) % np.uint64(n)).astype(np.int64)


def _count(depth: int, n_buckets: int):
    def count(key: tuple, table: pa.Table) -> pa.Table:
        texts = _Texts(table, depth)
        found, learned = [], []
        for at, entries in texts.entries():
            codes, distinct = pd.factorize(entries)
            found.append(distinct)
            learned.append(np.bincount(codes, texts.weight[at] == 2, len(distinct)))
        entries, counts = _sums(np.concatenate(found or [np.zeros(0, np.uint64)]),
                                np.concatenate(learned or [np.zeros(0)]))
        hashes, rows = texts.words()
        words, word_counts = _sums(hashes, texts.train[rows])
        out = []
        for kind, keys, n, bucket in ((0, words, word_counts, _word_bucket(words, n_buckets)),
                                      (1, entries, counts, _entry_bucket(entries, n_buckets))):
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            out += [(kind, b, c.pack(keys[order[x:y]], True), c.pack(n[order[x:y]]))
                    for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        kinds, buckets, keys, n = zip(*out) if out else ((), (), (), ())
        return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(buckets, pa.int64()),
                         "chunk": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "keys": pa.array(keys, pa.binary()), "counts": pa.array(n, pa.binary())})
    return count


# ------------------------------------------------------------------ word counts
def _sum_words(table: pa.Table) -> pa.Table:
    """Each chunk's words with their counts over all chunks, one added and the
    sign turned for the one chunk that is to count the word as its own."""
    keys = [c.unpack(x.as_py(), True) for x in table.column("keys")]
    counts = [c.unpack(x.as_py()).view(np.int64) for x in table.column("counts")]
    known, total = _sums(np.concatenate(keys), np.concatenate(counts))
    taken, data = np.zeros(len(known), bool), []
    for k in keys:
        at = np.searchsorted(known, k)
        own = ~taken[at] & (total[at] > 0)
        taken[at] |= own
        data.append(c.pack(np.where(own, -1, 1) * (total[at] + 1)))
    return pa.table({"chunk": table.column("chunk"), "kind": table.column("kind"), "bucket": table.column("bucket"),
                     "keys": pa.array([b""] * len(keys), pa.binary()), "data": pa.array(data, pa.binary())})


# ---------------------------------------------------------------- context trees
def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series at x + 8."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a bit sequence."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class _Level:
    """Tree nodes of one depth: key (context, then decision node), bit counts,
    log estimate and log weighted probability."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.seen = zeros + ones > 0
        self.own = log_kt(zeros, ones)
        self.weighted = self.own

    def mix(self, below: np.ndarray) -> None:
        self.weighted = np.logaddexp(self.own, below) + _LOG_HALF


def _shorter(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the nodes with the context cut to its last ``depth`` bytes."""
    return keys & np.uint64((1 << 8 * (depth + 1)) - 1)


def weigh(deepest: _Level, depth: int, top: int) -> dict[int, _Level]:
    """Levels ``top`` to ``depth`` above the deepest one, weighted bottom-up."""
    levels = {depth: deepest}
    for d in range(depth - 1, top - 1, -1):
        below = levels[d + 1]
        keys, at = np.unique(_shorter(below.keys, d), return_inverse=True)
        levels[d] = _Level(keys, *(np.bincount(at, x, len(keys)) for x in (below.zeros, below.ones)))
        levels[d].mix(np.bincount(at, below.weighted, len(keys)))
    return levels


def spread(levels: dict[int, _Level], depth: int, top: int, last: int, start: tuple[np.ndarray, ...]
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From ``top`` down to ``depth``: for each node there the probability of a
    one gathered above it, the weight left to it, and the probability of a one
    if the path ends above it.  ``start``: the same for the nodes at ``top``;
    at depth ``last`` a node keeps all weight."""
    gathered, left, ending = start
    for d in range(top, depth):
        level = levels[d]
        p = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
        share = np.exp(_LOG_HALF + level.own - level.weighted) if d < last else np.ones(len(p))
        ending = np.where(level.seen, gathered + left * p, ending)
        gathered = np.where(level.seen, gathered + left * share * p, gathered)
        left = np.where(level.seen, left * (1 - share), left)
        at = np.searchsorted(level.keys, _shorter(levels[d + 1].keys, d))
        gathered, left, ending = gathered[at], left[at], ending[at]
    return gathered, left, ending


def _expand(entries: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The eight decisions of every entry: node key, bit, count (entry by entry)."""
    symbol = entries & np.uint64(0xFF)
    keys, bits = np.empty((len(entries), 8), np.uint64), np.empty((len(entries), 8), np.int8)
    for k in range(8):
        node = (np.uint64(1) << np.uint64(k)) | (symbol >> np.uint64(8 - k))
        keys[:, k] = (entries & ~np.uint64(0xFF)) | node
        bits[:, k] = (symbol >> np.uint64(7 - k)) & np.uint64(1)
    return keys.ravel(), bits.ravel(), np.repeat(counts, 8)


def _subtrees(table: pa.Table, depth: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, dict[int, _Level]]:
    keys = [c.unpack(x.as_py(), True) for x in table.column("keys")]
    counts = [c.unpack(x.as_py()).view(np.int64) for x in table.column("counts")]
    entries, total = _sums(np.concatenate(keys), np.concatenate(counts))
    nodes, bits, n = _expand(entries, total)
    distinct, at = np.unique(nodes, return_inverse=True)
    ones = np.bincount(at, n * bits, len(distinct))
    deepest = _Level(distinct, np.bincount(at, n, len(distinct)) - ones, ones)
    return keys, entries, at, bits, weigh(deepest, depth, _SPLIT)


def _numbers(*columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x, np.float64).tobytes() for x in columns)


def _roots(depth: int):
    def roots(key: tuple, table: pa.Table) -> pa.Table:
        top = _subtrees(table, depth)[-1][_SPLIT]
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()),
                         "keys": pa.array([c.pack(top.keys, True)], pa.binary()),
                         "data": pa.array([_numbers(top.zeros, top.ones, top.weighted)], pa.binary())})
    return roots


def _join_roots(depth: int):
    """The levels above the groups; for each group's roots what is left to them."""
    def join(table: pa.Table) -> pa.Table:
        keys = [c.unpack(x.as_py(), True) for x in table.column("keys")]
        data = [np.frombuffer(x.as_py(), np.float64).reshape(3, -1) for x in table.column("data")]
        every = np.concatenate(keys)
        order = np.argsort(every)
        zeros, ones, weighted = np.concatenate(data, axis=1)[:, order]
        level = _Level(every[order], zeros, ones)
        level.weighted = weighted
        levels = weigh(level, _SPLIT, 0)
        n = len(levels[0].keys)
        found = spread(levels, _SPLIT, 0, depth, (np.zeros(n), np.ones(n), np.full(n, 0.5)))
        out = [_numbers(*(x[np.searchsorted(level.keys, k)] for x in found)) for k in keys]
        return pa.table({"bucket": table.column("bucket"), "start": pa.array(out, pa.binary())})
    return join


def _answer(depth: int):
    """Log10 probabilities of every chunk's entries."""
    def answer(table: pa.Table, start: pa.Table) -> pa.Table:
        keys, entries, at, bits, levels = _subtrees(table, depth)
        begin = np.frombuffer(start.column("start")[0].as_py(), np.float64).reshape(3, -1)
        gathered, left, ending = spread(levels, depth, _SPLIT, depth, tuple(begin))
        deepest = levels[depth]
        p = (deepest.ones + 0.5) / (deepest.zeros + deepest.ones + 1.0)
        one = np.where(deepest.seen, gathered + left * p, ending)[at]
        logs = np.log10(np.where(bits == 1, one, 1 - one)).reshape(-1, 8).sum(1)
        out = [logs[np.searchsorted(entries, k)].astype(np.float32).tobytes() for k in keys]
        return pa.table({"chunk": table.column("chunk"), "kind": table.column("kind"),
                         "bucket": table.column("bucket"), "keys": table.column("keys"),
                         "data": pa.array(out, pa.binary())})
    return answer


# --------------------------------------------------------------------- scoring
def _score(depth: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts, n = _Texts(docs, depth), len(docs)
        kinds = answers.column("kind").to_numpy()
        order = np.lexsort((answers.column("bucket").to_numpy(), kinds))
        rows = [(int(kinds[i]), answers.column("keys")[int(i)].as_py(), answers.column("data")[int(i)].as_py())
                for i in order]
        keys = np.concatenate([c.unpack(k, True) for kind, k, _ in rows if kind == 1])
        logs = np.concatenate([np.frombuffer(d, np.float32) for kind, _, d in rows if kind == 1]).astype(np.float64)
        order = np.argsort(keys)
        keys, logs, total = keys[order], logs[order], np.zeros(n)
        for at, entries in texts.entries():
            codes, distinct = pd.factorize(entries)
            found = logs[np.searchsorted(keys, distinct)][codes]
            owner = np.searchsorted(texts.starts, at, "right") - 1
            total += np.bincount(owner, found, n)

        hashes, row = texts.words()
        _, at = np.unique(hashes, return_inverse=True)
        counts = np.concatenate([c.unpack(d).view(np.int64) for kind, _, d in rows if kind == 0])
        plus_one = np.abs(counts)[at].astype(np.float64)
        own = np.zeros(n, np.int64)
        own[0] = int((counts < 0).sum())  # counted once per chunk
        return pa.table({
            "doc_id": docs.column("doc_id"), "train": docs.column("train"),
            "n_tokens": np.bincount(row, minlength=n).astype(np.int64),
            "n_known": np.bincount(row, plus_one > 1, n).astype(np.int64),
            "known_log": np.bincount(row, np.log10(plus_one), n), "score": total,
            "n_bytes": texts.sizes.astype(np.int64), "own_words": own})
    return score


def score_texts(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                depth: int = 5, chunk_bytes: int = 16 << 20) -> DataFrame:
    """One row per document row: doc_id, train, n_tokens, n_known,
    train_tokens, base_score, score (both log10), bits_per_byte.

    ``train``: which rows the model learns from (default: all)."""
    if not _SPLIT < depth <= 6:
        raise ValueError("depth must be from 3 to 6: an entry is one 64-bit key with eight decision nodes")
    learn = F.coalesce(train if train is not None else F.lit(True), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), learn.alias("train"))
    n_chunks = c.chunk_count(rows, chunk_bytes)
    chunks = rows.withColumn("chunk", c.chunk_of(n_chunks))
    # one plan, so that the shuffled texts and entries serve both of their uses
    blocks = chunks.groupBy("chunk").applyInArrow(_count(depth, n_chunks), _BLOCK)
    words = blocks.filter("kind = 0").groupBy("bucket").applyInArrow(_sum_words, _ANSWER)
    entries = blocks.filter("kind = 1")
    start = (entries.groupBy("bucket").applyInArrow(_roots(depth), "bucket long, keys binary, data binary")
             .withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_join_roots(depth), "bucket long, start binary"))
    logs = entries.groupBy("bucket").cogroup(start.groupBy("bucket")).applyInArrow(_answer(depth), _ANSWER)
    scored = pin(chunks.groupBy("chunk").cogroup(words.unionAll(logs).groupBy("chunk")).applyInArrow(
        _score(depth), _SCORED), "scored")
    totals = scored.agg(F.sum(F.when(F.col("train"), F.col("n_tokens"))).alias("n"),
                        F.sum("own_words").alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"] or 0)
    base = F.col("known_log") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return scored.select("doc_id", "train", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         base.alias("base_score"), "score",
                         (-F.col("score") * np.log2(10.0).item() / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
