"""Quality classifier: naive Bayes features in a linear hinge-loss model (NBSVM).

A text becomes indicators of its n-grams: words, word pairs, and runs of up to
three word shapes (letters, capitals, digits and punctuation, repeats merged),
with one indicator each for the share of repeated word pairs and the length.
Indicators are hashed into a fixed number of slots.

1. One pass over the documents counts each indicator by class over all
   labelled training rows; the counts of a task travel as a few packed blocks
   and are summed by block.  Their ratio of logs scales the indicators.
2. The hinge-loss model is fitted by dual coordinate descent on at most
   ``sample_rows`` labelled rows, those with the smallest hash of their id,
   and its weights are interpolated with their mean size.  Scores of left-out
   thirds of the sample set the logistic curve that makes probabilities.
3. Another pass scores every document.

Up to ``max_known`` labels (9 bytes each) are sent to the tasks, which then
find their labelled rows themselves; beyond that a join marks them.

Defined cases: null and empty texts have the length indicator only; a null or
conflicting label is not learned from (of repeated labels that agree one
counts); without labels of both classes every score is the share of class 1,
or 0.5; repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

WORD_SLOTS, SHAPE_SLOTS = 1 << 18, 1 << 14
SLOTS = WORD_SLOTS + SHAPE_SLOTS
_BLOCK = 1 << 14
_SLICE = 1 << 20
# letters in lower case and of other alphabets, capitals and digits are one class each
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B], _SHAPE[0x80:], _SHAPE[0x41:0x5B], _SHAPE[0x30:0x3A] = 0x61, 0x61, 0x41, 0x30


def indicators(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of rows a..b: the distinct slots in row order, and the index
    of each row's first one (one more at the end)."""
    data, offsets = c.utf8(column)
    for a, b in c.row_slices(offsets, _SLICE):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = c.words_of(part, offsets[a:b + 1] - offsets[a], c.NOT_SPACE)
        own, count = np.repeat(np.arange(b - a), np.diff(first)), np.diff(first)
        words = c.word_hashes(c.LOWER[part], starts, ends)
        pairs, at = c.window_hashes(words, first, 2)
        found = [(own, words % np.uint64(WORD_SLOTS)), (own[at], pairs % np.uint64(WORD_SLOTS))]

        kinds = _SHAPE[part]
        keep = np.ones(len(part), bool)
        keep[1:] = kinds[1:] != kinds[:-1]
        keep[starts] = True
        place = np.concatenate(([0], np.cumsum(keep)))
        shapes = c.word_hashes(kinds[keep], place[starts], place[ends])
        for n in (1, 2, 3):
            runs, spot = c.window_hashes(shapes, first, n)
            found.append((own[spot], c.mix(runs + np.uint64(n)) % np.uint64(SHAPE_SLOTS - 64) + np.uint64(WORD_SLOTS)))

        order = np.lexsort((pairs, own[at]))
        same = (pairs[order][1:] == pairs[order][:-1]) & (own[at][order][1:] == own[at][order][:-1])
        repeats = np.bincount(own[at][order][1:][same], minlength=b - a)
        share = (10 * repeats) // np.maximum(count - 1, 1)
        rows = np.arange(b - a)
        found.append((rows, (SLOTS - 64 + np.minimum(share, 10)).astype(np.uint64)))
        found.append((rows, (SLOTS - 40 + np.minimum(np.log2(count + 1).astype(np.int64), 30)).astype(np.uint64)))
        keys = np.unique(np.concatenate([(r.astype(np.uint64) << np.uint64(20)) | s for r, s in found]))
        slots = (keys & np.uint64((1 << 20) - 1)).astype(np.int32)
        yield a, b, slots, np.searchsorted(keys >> np.uint64(20), np.arange(b - a + 1).astype(np.uint64))


def _collect(known: tuple[np.ndarray, np.ndarray] | None, sample: np.ndarray):
    """Per task: class counts of every slot in packed blocks, and the slots of
    the sampled rows."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SLOTS + 1), np.int64)  # at the end the rows
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            if known is None:
                labels = batch.column("label").to_numpy(zero_copy_only=False)
            else:
                at = np.minimum(np.searchsorted(known[0], ids), len(known[0]) - 1)
                labels = np.where(known[0][at] == ids, known[1][at], -1)
            wanted = np.flatnonzero(labels >= 0)
            if not len(wanted):
                continue
            ids, labels = ids[wanted], labels[wanted]
            chosen, kept, kept_labels, kept_ids = np.isin(ids, sample), [], [], []
            for a, b, slots, first in indicators(batch.column("text").take(pa.array(wanted))):
                own = np.repeat(labels[a:b], np.diff(first))
                for k in (0, 1):
                    counts[k, :SLOTS] += np.bincount(slots[own == k], minlength=SLOTS)
                    counts[k, SLOTS] += int((labels[a:b] == k).sum())
                for i in np.flatnonzero(chosen[a:b]):
                    kept.append(slots[first[i]:first[i + 1]].tobytes())
                    kept_labels.append(int(labels[a + i]))
                    kept_ids.append(int(ids[a + i]))
            yield pa.record_batch({"block": pa.array([-1] * len(kept), pa.int64()),
                                   "id": pa.array(kept_ids, pa.int64()),
                                   "label": pa.array(kept_labels, pa.int32()), "data": pa.array(kept, pa.binary())})
        if counts.any():
            starts = range(0, SLOTS + 1, _BLOCK)
            yield pa.record_batch({
                "block": pa.array([s // _BLOCK for s in starts for _ in (0, 1)], pa.int64()),
                "id": pa.array([None for _ in starts for _ in (0, 1)], pa.int64()),
                "label": pa.array([k for _ in starts for k in (0, 1)], pa.int32()),
                "data": pa.array([c.pack(counts[k, s:s + _BLOCK]) for s in starts for k in (0, 1)], pa.binary())})
    return collect


def _sum_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | int = 0
    for batch in batches:
        for x in batch.column("data"):
            total = total + c.unpack(x.as_py()).view(np.int64)
    yield pa.record_batch({"block": [key[0].as_py()], "label": pa.array([key[1].as_py()], pa.int32()),
                           "data": pa.array([c.pack(total)], pa.binary())})


def descend(rows: list[np.ndarray], sign: np.ndarray, scale: np.ndarray, cost: np.ndarray,
            rounds: int = 12, seed: int = 3) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss (Hsieh and others): weights
    per slot and a bias.  A row's values are its slots' scales at unit length."""
    weights, bias, rng = np.zeros(len(scale)), 0.0, np.random.default_rng(seed)
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    values = [v / max(np.sqrt(v @ v + 1e-12), 1e-6) for v in values]
    square = np.array([v @ v + 1.0 for v in values])
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            slots, v = rows[i], values[i]
            gradient = sign[i] * (weights[slots] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                largest = max(largest, abs(step))
                alpha[i] = new
                weights[slots] += step * v
                bias += step
        if largest < 1e-3:
            break
    return weights, bias


def decide(rows: list[np.ndarray], scale: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(rows))
    for i, r in enumerate(rows):
        v = scale[r]
        out[i] = weights[r] @ v / max(np.sqrt(v @ v + 1e-12), 1e-6) + bias
    return out


def logistic(scores: np.ndarray, labels: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of Platt's curve by Newton steps on softened targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        w, g = p * (1 - p) + 1e-9, p - target
        hess = np.array([[w @ scores ** 2 + 1e-6, w @ scores], [w @ scores, w.sum() + 1e-6]])
        step = np.linalg.solve(hess, np.array([g @ scores, g.sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def _fit(scale: np.ndarray, penalty: float, blend: float):
    """The model from the sampled rows, which are at most ``sample_rows``."""
    def model(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float]:
        sign = np.where(labels == 1, 1.0, -1.0)
        weights, bias = descend(rows, sign, scale, np.full(len(rows), penalty))
        mean = np.abs(weights).mean()
        return (1 - blend) * mean * np.sign(weights) + blend * weights if blend < 1 else weights, bias

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted((i.as_py(), y.as_py(), d.as_py()) for batch in batches for i, y, d in zip(
            batch.column("id"), batch.column("label"), batch.column("data")))
        rows = [np.frombuffer(d, np.int32) for _, _, d in sample]
        labels = np.array([y for _, y, _ in sample], np.int64)
        fold, left_out = np.arange(len(rows)) % 3, np.zeros(len(rows))
        for k in range(3):
            train = np.flatnonzero(fold != k)
            if len(set(labels[train])) == 2:
                part = model([rows[i] for i in train], labels[train])
                test = np.flatnonzero(fold == k)
                left_out[test] = decide([rows[i] for i in test], scale, *part)
        weights, bias = model(rows, labels)
        a, b = logistic(left_out, labels)
        yield pa.record_batch({"weights": pa.array([weights.tobytes()], pa.binary()),
                               "bias": [bias], "slope": [a], "shift": [b]})
    return fit


def _score(scale: np.ndarray, weights: np.ndarray, bias: float, slope: float, shift: float):
    product, squares = (scale * weights).astype(np.float64), scale * scale

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, slots, first in indicators(batch.column("text")):
                own = np.repeat(np.arange(b - a), np.diff(first))
                dot = np.bincount(own, product[slots], b - a)
                size = np.sqrt(np.bincount(own, squares[slots], b - a) + 1e-12)
                margin = slope * (dot / np.maximum(size, 1e-6) + bias) + shift
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(a, b - a),
                                       "score": 1 / (1 + np.exp(-np.clip(margin, -30, 30)))})
    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", learn: Column | None = None, sample_rows: int = 9000,
                  min_count: int = 5, smooth: float = 1.0, penalty: float = 1.0, blend: float = 1.0,
                  max_known: int = 1 << 20) -> DataFrame:
    """One row per document row: doc_id, score (probability of label 1).

    ``learn``: which rows of ``labels`` may be learned from (default: all)."""
    spark = docs.sparkSession
    marked = labels.filter(learn if learn is not None else F.lit(True)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = pin(marked.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other").select("doc_id", "label"), "labels")
    sizes = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = c.id_and_text(docs.withColumn(id_col, docs[id_col].cast("long")), id_col, text_col)
    if len(sizes) < 2:
        only = sizes and next(iter(sizes))
        return rows.select("doc_id", F.lit(float(only) if sizes else 0.5).alias("score"))
    sample = np.array([r["doc_id"] for r in marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(
        sample_rows).collect()], np.int64)
    known, source = None, rows
    if sum(sizes.values()) <= max_known:
        pairs = sorted((r["doc_id"], r["label"]) for r in marked.collect())
        known = tuple(np.array(x, np.int64) for x in zip(*pairs))
        source = rows.filter(F.col("doc_id").isNotNull())
    else:
        source = rows.join(marked, "doc_id")
    seen = pin(source.mapInArrow(_collect(known, sample), "block long, id long, label int, data binary"), "counts")
    counts = np.zeros((2, SLOTS + 1), np.int64)
    for r in (seen.filter("block >= 0").groupBy("block", "label").applyInArrow(
            _sum_blocks, "block long, label int, data binary").collect()):  # a fixed number of blocks
        part = c.unpack(bytes(r["data"])).view(np.int64)
        counts[r["label"], r["block"] * _BLOCK:r["block"] * _BLOCK + len(part)] = part
    hits = counts[:, :SLOTS].astype(np.float64)
    ratio = np.log((hits[1] + smooth) / (hits[1] + smooth).sum()) - np.log((hits[0] + smooth) / (hits[0] + smooth).sum())
    ratio[hits.sum(0) < min_count] = 0.0
    fitted = (seen.filter("block < 0").dropDuplicates(["id"]).select("id", "label", "data").coalesce(1)
              .mapInArrow(_fit(ratio, penalty, blend), "weights binary, bias double, slope double, shift double").first())
    weights = np.frombuffer(bytes(fitted["weights"]), np.float64)
    return rows.mapInArrow(_score(ratio, weights, fitted["bias"], fitted["slope"], fitted["shift"]),
                           "doc_id long, score double")
