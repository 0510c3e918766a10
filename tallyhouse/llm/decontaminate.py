"""Benchmark decontamination by winnowing.

Test items and documents keep the smallest hash of every run of
``span - k + 1`` consecutive k-grams, so any shared passage of ``span`` words
has a fingerprint in common.  Fingerprints are joined, and each matching pair
of document and item text is then extended to all shared windows of ``span``
words.  An item of fewer words is one window; for each such length all windows
of that length are fingerprints.

Equal item texts are compared once.  If the benchmark has at most
``max_known`` fingerprints (8 bytes each), the scan of the documents already
drops the others; beyond that all document fingerprints go into the join.  The
result is the same.

Defined cases: null or empty texts have no words, hit nothing and are hit by
nothing; repeated rows are judged each on their own; an item id is listed once
however often it is repeated, and a null item id is not listed; other columns
are not read; empty tables give an empty result or no hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SLICE = 1 << 20
_SCANNED = "n_words long, prints array<long>, text string"
_SPANS = "row long, item long, spans array<struct<a:int,b:int>>"


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def winnow(words: np.ndarray, first: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest k-gram hash of every window of ``span`` words inside a row,
    and the index of each window's first word."""
    hashes, at = c.window_hashes(words, first, k)
    wide = span - k
    if len(hashes) <= wide:
        return hashes[:0], at[:0]
    n = len(hashes) - wide
    least = hashes[:n].copy()
    for j in range(1, wide + 1):
        np.minimum(least, hashes[j:j + n], out=least)
    whole = at[wide:] == at[:n] + wide
    return least[whole], at[:n][whole]


def _prints(words: np.ndarray, first: np.ndarray, span: int, k: int, short: list[int]
            ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield winnow(words, first, span, k)
    for n in short:
        yield winnow(words, first, n, n)


def _hashed(column: pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = c.utf8(column)
    for a, b in c.row_slices(offsets, _SLICE):
        part = c.LOWER[data[offsets[a]:offsets[b]]]
        starts, ends, first = c.words_of(part, offsets[a:b + 1] - offsets[a], c.ALNUM)
        yield a, b, c.word_hashes(part, starts, ends), first


def _item_prints(span: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, owner = batch.column("item").to_numpy(), [], []
            for a, b, words, first in _hashed(batch.column("normal")):
                for row in range(a, b):
                    own = words[first[row - a]:first[row - a + 1]]
                    n = min(span, len(own))
                    got, _ = winnow(own, np.array([0, len(own)]), n, k if n == span else n)
                    out.append(np.unique(got))
                    owner.append(np.repeat(ids[row], len(out[-1])))
            if out:
                yield pa.record_batch({"print": np.concatenate(out).view(np.int64),
                                       "item": np.concatenate(owner).astype(np.int64)})
    return prints


def _scan(span: int, k: int, short: list[int], known: np.ndarray | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b, words, first in _hashed(texts):
                own, found = np.repeat(np.arange(b - a), np.diff(first)), []
                for got, at in _prints(words, first, span, k, short):
                    keep = np.ones(len(got), bool)
                    keep[1:] = (got[1:] != got[:-1]) | (own[at[1:]] != own[at[:-1]])
                    if known is not None and len(got):
                        spot = np.minimum(np.searchsorted(known, got), max(len(known) - 1, 0))
                        keep &= known[spot] == got if len(known) else False
                    found.append(np.rec.fromarrays([own[at[keep]], got[keep]], names="row,print"))
                found = np.unique(np.concatenate(found))
                counts = np.bincount(found["row"], minlength=b - a)
                ends = np.concatenate(([0], np.cumsum(counts)))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_words": np.diff(first).astype(np.int64),
                    "prints": pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(found["print"].view(np.int64), pa.int64())),
                    "text": pa.array([texts[a + i].as_py() if counts[i] else None for i in range(b - a)],
                                     pa.string())})
    return scan


def _extend(span: int):
    """All windows of the item that occur in the document, as merged word intervals."""
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, spans = [], [], []
            for row, item, text, normal in zip(*(batch.column(x) for x in ("row", "item", "text", "normal"))):
                (_, _, words, first), = _hashed(pa.array([text.as_py()], pa.string()))
                (_, _, target, item_first), = _hashed(pa.array([normal.as_py()], pa.string()))
                size = min(span, len(target))
                wanted, _ = c.window_hashes(target, item_first, size)
                got, at = c.window_hashes(words, first, size)
                at = at[np.isin(got, wanted)]
                if len(at):
                    new = np.concatenate(([True], at[1:] > at[:-1] + size))
                    begin = at[new]
                    end = np.append(at[np.flatnonzero(new)[1:] - 1], at[-1]) + size
                    rows.append(row.as_py())
                    items.append(item.as_py())
                    spans.append([{"a": int(x), "b": int(y)} for x, y in zip(begin, end)])
            yield pa.record_batch({
                "row": pa.array(rows, pa.int64()), "item": pa.array(items, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct({"a": pa.int32(), "b": pa.int32()})))})
    return extend


def _merged(spans: Column) -> Column:
    """Sorted, disjoint intervals covering the same words."""
    start = F.struct(F.array().cast("array<struct<a:int,b:int>>").alias("done"), spans[0].alias("open"))

    def add(acc: Column, s: Column) -> Column:
        apart = s["a"] > acc["open"]["b"]
        return F.struct(
            F.when(apart, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(apart, s).otherwise(F.struct(
                acc["open"]["a"].alias("a"), F.greatest(acc["open"]["b"], s["b"]).alias("b"))).alias("open"))

    return F.aggregate(spans, start, add, lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", span: int = 10, k: int = 5,
                  max_known: int = 1 << 20) -> DataFrame:
    """One row per document row: doc_id (numbers as long, others as they are),
    n_words, n_hit, n_items, items (ids as sorted strings), spans (hit word
    intervals, end exclusive), contaminated."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"),
        F.array_join(normal_words(F.coalesce(F.col(item_text_col), F.lit(""))), " ").alias("normal")
    ).filter("normal != ''")
    texts = pin(items.select("normal").distinct().select(
        F.monotonically_increasing_id().alias("item"), "normal",
        F.size(F.split("normal", " ")).alias("n")), "items")
    prints = pin(texts.select("item", "normal").mapInArrow(
        _item_prints(span, k), "print long, item long"), "prints")
    short = [r["n"] for r in texts.filter(F.col("n") < span).select("n").distinct().collect()]
    known = None
    distinct = prints.select("print").distinct()
    if distinct.count() <= max_known:
        known = np.sort(np.array([r["print"] for r in distinct.collect()], np.int64).view(np.uint64))
    rows = c.id_and_text(docs, id_col, text_col)
    if isinstance(rows.schema["doc_id"].dataType, NumericType):
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scanned = pin(rows.mapInArrow(_scan(span, k, sorted(short), known), f"doc_id {id_type}, {_SCANNED}")
                  .withColumn("row", F.monotonically_increasing_id()), "scanned")
    pairs = (scanned.select("row", F.explode("prints").alias("print"))
             .join(prints, "print").select("row", "item").distinct())
    found = pin(pairs.join(scanned.select("row", "text"), "row")
                .join(texts.select("item", "normal"), "item")
                .select("row", "item", "text", "normal").mapInArrow(_extend(span), _SPANS), "hits")
    ids = texts.join(items, "normal").select("item", "item_id").distinct()
    listed = (found.select("row", "item").join(ids, "item").select("row", "item_id").distinct()
              .groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    merged = (found.select("row", F.explode("spans").alias("s")).distinct().groupBy("row")
              .agg(F.sort_array(F.collect_list("s")).alias("spans"))
              .select("row", _merged(F.col("spans")).alias("spans")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return (scanned.select("row", "doc_id", "n_words")
            .join(merged, "row", "left").join(listed, "row", "left")
            .withColumns({"items": F.coalesce("items", F.array().cast("array<string>")),
                          "spans": F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>"))})
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    "items", "spans", (F.size("spans") > 0).alias("contaminated")))
