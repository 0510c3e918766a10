"""Ranked lexical search over posting lists blocked by document similarity.

Queries are taken in blocks of bounded size, each against all documents:

1. every document is reduced to the terms of the block's queries (a sparse row
   of term counts), and Spark sums the corpus figures (documents, terms, how
   many documents hold each term);
2. the documents that hold a query's rarest term of their shard are scored
   exactly, which gives each query a first threshold: a score that ten
   documents reach.  With the largest value of each term, a query then needs
   only those lists without which a document could still reach it;
3. a shard is a bounded number of documents.  In each, the posting list of
   every needed term is clustered by the similarity of its documents (to
   members of the list, in a random projection) and cut into blocks, each with
   a summary: for every term, the largest value in the block's documents.
   Shards with their lists are stored as one table, the index;
4. the search walks the needed lists of each query, best block first.  The sum
   of a summary over the query's terms bounds every score in the block, so a
   block is left out only if that bound is below the tenth score so far.

All values are integers below 2^53, so sums in doubles are exact, and equal
scores are never cut off by a bound.  Every document with a score above 0 can
be found; nothing is pruned by sampling or rank.  A hot term's list is spread
over all shards; what is shuffled is ten rows per query and task.

Defined cases: null and empty texts hold no terms; rows of documents are ranked
each, also with a repeated id (equal scores by id, null ids last); rows of one
query id are one query with the terms of all, and rows without a query id are
one query; a query without terms that occur gives no rows; other columns are
not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

_SLICE = 1 << 21         # bytes of text taken at once
_EXACT = 1 << 53
_ROW = "doc_id long, n_terms long, terms binary, counts binary"
_FOUND = "query int, doc_id long, score long"


@dataclass
class Queries:
    """A bounded block of queries: their ids, the vocabulary (sorted hashes of
    the distinct terms) and each query's terms as places in it."""

    ids: list
    hashes: np.ndarray
    terms: list[np.ndarray]

    @classmethod
    def read(cls, rows: list) -> "Queries":
        of: dict = {}
        for r in rows:
            of.setdefault(r["query_id"], []).append(r["text"])
        terms = [_term_hashes(pa.array([" ".join(texts)]))[0] for texts in of.values()]
        hashes = np.unique(np.concatenate([*terms, np.zeros(0, np.uint64)]))
        return cls(list(of), hashes, [np.searchsorted(hashes, np.unique(t)) for t in terms])


@dataclass
class Corpus:
    """Corpus figures that the weights need."""

    documents: int
    total: int                     # terms of all documents
    weights: np.ndarray            # by place in the vocabulary
    cells: int                     # documents x terms in a shard

    def values(self, place: np.ndarray, count: np.ndarray, n_terms: np.ndarray) -> np.ndarray:
        """What a term that stands ``count`` times in a document of ``n_terms`` adds to a score."""
        m = 100 - 90 + (90 * n_terms * self.documents) // self.total
        return self.weights[place] * ((1000000000 * count) // (1000 * count + 8 * m))


def _term_hashes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and the index of each row's first one (one more at the end)."""
    data, offsets = c.utf8(column)
    data = c.LOWER[data]
    starts, ends, first = c.words_of(data, offsets, c.ALNUM)
    return c.word_hashes(data, starts, ends), first


# -------------------------------------------------------------- documents as rows
def _rows(hashes: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = c.utf8(batch.column("text"))
            for a, b in c.row_slices(offsets, _SLICE):
                found, first = _term_hashes(batch.column("text").slice(a, b - a))
                n = np.diff(first)
                at = np.flatnonzero(c.in_sorted(found, hashes))
                cells = np.repeat(np.arange(b - a), n)[at] * np.int64(len(hashes) or 1) + np.searchsorted(
                    hashes, found[at])
                cells, counts = np.unique(cells, return_counts=True)
                own, place = np.divmod(cells, len(hashes) or 1)
                cut = np.searchsorted(own, np.arange(b - a + 1))
                place, counts = place.astype(np.uint32), counts.astype(np.uint32)
                cols = {"doc_id": batch.column("doc_id").slice(a, b - a), "n_terms": n.astype(np.int64)}
                for name, values in (("terms", place), ("counts", counts)):
                    cols[name] = pa.array([values[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary())
                yield pa.record_batch(cols).filter(pa.array(n > 0))
    return rows


def _sparse(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows, and each row's start in them (one more at the end)."""
    raw = column.to_pylist()
    return (np.frombuffer(b"".join(raw), np.uint32).astype(np.int64),
            np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw], dtype=np.int64))))


def _frequencies(size: int):
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_sparse(batch.column("terms"))[0], minlength=size)
        at = np.flatnonzero(df)
        yield pa.record_batch({"place": pa.array(at, pa.int64()), "df": df[at]})
    return frequencies


class Shard:
    """A bounded number of documents as a matrix of term values."""

    def __init__(self, ids: pa.Array, place: np.ndarray, first: np.ndarray, values: np.ndarray, size: int) -> None:
        self.ids, self.place, self.first, self.values = ids, place, first, values
        self.matrix = np.zeros((len(ids), size))
        self.matrix[np.repeat(np.arange(len(ids)), np.diff(first)), place] = values
        order = np.argsort(place, kind="stable")
        self.by_term = np.repeat(np.arange(len(ids)), np.diff(first))[order]
        self.at = np.searchsorted(place[order], np.arange(size + 1))

    def members(self, place: int) -> np.ndarray:
        return self.by_term[self.at[place]:self.at[place + 1]]

    def scores(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return self.matrix[np.ix_(docs, terms)].sum(1).astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch], corpus: Corpus, size: int) -> Iterator[Shard]:
    most = max(1, corpus.cells // max(1, size))
    waiting, rows = [], 0
    for batch in batches:
        for a in range(0, len(batch), most):
            part = batch.slice(a, most)
            if rows + len(part) > most:
                yield _shard(waiting, corpus, size)
                waiting, rows = [], 0
            waiting.append(part)
            rows += len(part)
    if rows:
        yield _shard(waiting, corpus, size)


def _shard(parts: list[pa.RecordBatch], corpus: Corpus, size: int) -> Shard:
    table = pa.Table.from_batches(parts).combine_chunks()
    place, first = _sparse(table.column("terms"))
    counts, _ = _sparse(table.column("counts"))
    n = np.repeat(table.column("n_terms").to_numpy(), np.diff(first))
    return Shard(table.column("doc_id").combine_chunks(), place, first, corpus.values(place, counts, n), size)


class Best:
    """The ``k`` best documents of each query so far.  A query's threshold is
    its k-th score, or one known from before."""

    def __init__(self, n_queries: int, k: int, known: np.ndarray | None = None) -> None:
        self.k, self.floor = k, np.ones(n_queries, np.int64) if known is None else known.copy()
        self.scores = [np.zeros(0, np.int64)] * n_queries
        self.ids = [np.zeros(0, object)] * n_queries

    def add(self, query: int, scores: np.ndarray, docs: np.ndarray, ids: pa.Array) -> None:
        use = np.flatnonzero(scores >= self.floor[query])
        if not len(use):
            return
        scores = np.concatenate((self.scores[query], scores[use]))
        names = np.concatenate((self.ids[query], np.array(ids.take(pa.array(docs[use])).to_pylist(), object)))
        if len(scores) > self.k:
            order = sorted(range(len(scores)), key=lambda i: (-scores[i], names[i] is None, names[i] or 0))[:self.k]
            scores, names = scores[order], names[order]
        self.scores[query], self.ids[query] = scores, names
        if len(scores) == self.k:
            self.floor[query] = max(self.floor[query], scores.min())

    def batch(self) -> pa.RecordBatch:
        query = np.repeat(np.arange(len(self.scores)), [len(x) for x in self.scores])
        return pa.record_batch({"query": pa.array(query, pa.int32()),
                                "doc_id": pa.array([i for x in self.ids for i in x], pa.int64()),
                                "score": np.concatenate([*self.scores, np.zeros(0, np.int64)])})


# --------------------------------------------------------------------- thresholds
def _probe(queries: Queries, corpus: Corpus, k: int):
    """Scores of the documents that hold a query's rarest term of a shard, and
    (as query -1 - place) the largest value of each term."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, best = len(queries.hashes), Best(len(queries.ids), k)
        largest = np.zeros(size, np.int64)
        for shard in _shards(batches, corpus, size):
            np.maximum.at(largest, shard.place, shard.values)
            for q, terms in enumerate(queries.terms):
                held = terms[shard.at[terms + 1] > shard.at[terms]]
                if len(held):
                    docs = shard.members(int(held[np.argmax(corpus.weights[held])]))
                    best.add(q, shard.scores(docs, terms), docs, shard.ids)
        at = np.flatnonzero(largest)
        yield best.batch()
        yield pa.record_batch({"query": pa.array(-1 - at, pa.int32()), "doc_id": pa.nulls(len(at), pa.int64()),
                               "score": largest[at]})
    return probe


def needed_lists(queries: Queries, largest: np.ndarray, floor: np.ndarray) -> list[np.ndarray]:
    """Per query the terms whose lists hold all documents that can reach the
    threshold, largest value first: the others add up to less than it."""
    needed = []
    for terms, least in zip(queries.terms, floor):
        terms = terms[largest[terms] > 0]
        terms = terms[np.argsort(largest[terms], kind="stable")]
        needed.append(terms[np.cumsum(largest[terms]) >= least][::-1])
    return needed


# -------------------------------------------------------------------------- index
def blocked(shard: Shard, place: int, sketch: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """A posting list in blocks of at most ``block`` similar documents: the
    documents in order, and each block's first one."""
    docs = shard.members(place)
    if len(docs) <= block:
        return docs, np.zeros(1, np.int64)
    own = sketch[docs]
    centres = own[np.linspace(0, len(docs) - 1, -(-len(docs) // block)).astype(np.int64)]
    nearest = np.argmax(own @ centres.T, 1)
    order = np.argsort(nearest, kind="stable")
    inside = np.arange(len(docs)) - np.searchsorted(nearest[order], nearest[order])
    return docs[order], np.flatnonzero(inside % block == 0)


def _index(corpus: Corpus, size: int, coordinates: dict[int, np.ndarray], block: int):
    """One row per shard: its documents and the blocked lists of the needed
    terms with their summaries (over the terms that meet them in a query)."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(41).choice([-1.0, 1.0], (size, 64))
        for shard in _shards(batches, corpus, size):
            norm = np.sqrt((shard.matrix ** 2).sum(1, keepdims=True))
            sketch = (shard.matrix / np.maximum(norm, 1)) @ random
            sketch /= np.maximum(np.sqrt((sketch ** 2).sum(1, keepdims=True)), 1e-30)
            lists, docs, starts, summary = [], [], [], []
            for place in np.flatnonzero(np.diff(shard.at)).tolist():
                if place not in coordinates:
                    continue
                order, first = blocked(shard, place, sketch, block)
                most = np.maximum.reduceat(shard.matrix[np.ix_(order, coordinates[place])], first, axis=0)
                lists.append((place, len(order), len(first)))
                docs.append(order)
                starts.append(first)
                summary.append(most.astype(np.int64).ravel())
            flat = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (docs, starts, summary)]
            columns = [np.array(lists, np.int64).ravel(), *flat, shard.place, shard.first, shard.values]
            yield pa.record_batch({"ids": pa.ListArray.from_arrays(pa.array([0, len(shard.ids)], pa.int32()), shard.ids),
                                   **{name: pa.array([c.pack(x)], pa.binary())
                                      for name, x in zip(_BLOBS, columns)}})
    return index


_BLOBS = ["lists", "docs", "starts", "summary", "place", "first", "value"]
_INDEX = "ids array<long>, " + ", ".join(f"{x} binary" for x in _BLOBS)


# ------------------------------------------------------------------------- search
def _search(queries: Queries, needed: list[np.ndarray], coordinates: dict[int, np.ndarray],
            floor: np.ndarray, k: int):
    size = len(queries.hashes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries.ids), k, floor)
        for batch in batches:
            for i in range(len(batch)):
                row = {x: c.unpack(batch.column(x)[i].as_py()).view(np.int64) for x in _BLOBS}
                ids = batch.column("ids").slice(i, 1).flatten()
                shard = Shard(ids, row["place"], row["first"], row["value"], size)
                _search_shard(shard, row, queries, needed, coordinates, best)
        yield best.batch()
    return search


def _search_shard(shard: Shard, row: dict, queries: Queries, needed: list[np.ndarray],
                  coordinates: dict[int, np.ndarray], best: Best) -> None:
    lists, at = {}, [0, 0, 0]
    for place, n_docs, n_blocks in row["lists"].reshape(-1, 3).tolist():
        width = len(coordinates[place])
        sizes = (n_docs, n_blocks, n_blocks * width)
        docs, first, summary = (row[x][a:a + n] for x, a, n in zip(("docs", "starts", "summary"), at, sizes))
        lists[place] = (docs, np.append(first, n_docs), summary.reshape(n_blocks, width))
        at = [a + n for a, n in zip(at, sizes)]
    for q, (terms, own) in enumerate(zip(queries.terms, needed)):
        seen = np.zeros(len(shard.ids), bool)
        for place in own.tolist():
            if place not in lists:
                continue
            docs, first, summary = lists[place]
            bound = summary[:, c.in_sorted(coordinates[place], terms)].sum(1)
            order = np.argsort(-bound, kind="stable")
            taken, step = 0, 1
            while taken < len(order):  # one block, two, four ..., while bounds reach the threshold
                now = order[taken:taken + step]
                now = now[bound[now] >= best.floor[q]]
                if not len(now):
                    break
                found = np.concatenate([docs[first[x]:first[x + 1]] for x in now.tolist()])
                found = found[~seen[found]]
                seen[found] = True
                best.add(q, shard.scores(found, terms), found, shard.ids)
                taken, step = taken + step, 2 * step


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query: at most k rows per task come in."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.filter("query >= 0 and score > 0").withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k)


def _search_block(rows: DataFrame, queries: Queries, k: int, block: int, cells: int
                  ) -> DataFrame | None:
    size = len(queries.hashes)
    docs = pin(rows.mapInArrow(_rows(queries.hashes), _ROW), "term-rows")
    figures = docs.agg(F.count("*").alias("n"), F.sum("n_terms").alias("total")).first()
    if not figures["n"] or not size:
        return None
    df = np.zeros(size, np.int64)
    for r in docs.mapInArrow(_frequencies(size), "place long, df long").groupBy("place").agg(
            F.sum("df").alias("df")).collect():  # at most one row per term of the queries
        df[r["place"]] = r["df"]
    weights = [math.floor(1000 * math.log((2 * figures["n"] + 2) / (2 * d + 1))) for d in df.tolist()]
    corpus = Corpus(int(figures["n"]), int(figures["total"]), np.array(weights, np.int64), cells)
    if max(weights) * 1000000 * max(map(len, queries.terms)) >= _EXACT:
        raise ValueError("a query has too many terms for exact sums in doubles")
    probe = pin(docs.mapInArrow(_probe(queries, corpus, k), _FOUND), "probe")
    largest, floor = np.zeros(size, np.int64), np.ones(len(queries.ids), np.int64)
    for r in probe.filter("query < 0").groupBy("query").agg(F.max("score").alias("most")).collect():
        largest[-1 - r["query"]] = r["most"]
    for r in _top(probe, k).filter(F.col("rank") == k).collect():  # at most one row per query
        floor[r["query"]] = r["score"]
    needed = needed_lists(queries, largest, floor)
    meet: dict[int, list[np.ndarray]] = {}
    for terms, own in zip(queries.terms, needed):
        for place in own.tolist():
            meet.setdefault(place, []).append(terms)
    coordinates = {place: np.unique(np.concatenate(x)) for place, x in meet.items()}
    index = pin(docs.mapInArrow(_index(corpus, size, coordinates, block), _INDEX), "index")
    found = index.mapInArrow(_search(queries, needed, coordinates, floor, k), _FOUND)
    names = docs.sparkSession.createDataFrame(pa.table({
        "query": pa.array(range(len(queries.ids)), pa.int32()),
        "query_id": pa.array(queries.ids, pa.int64())}))  # the ids of this block
    return _top(found, k).join(names, "query").select("query_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10, block: int = 32, query_rows: int = 512,
                   query_bytes: int = 1 << 20, shard_cells: int = 1 << 22, id_col: str = "doc_id", text_col: str = "text",
                   query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each query: query_id, rank, doc_id, score.

    ``query_rows``, ``query_bytes``: about how many queries, and how much of
    their text, are searched at once.  ``shard_cells``: documents times terms of
    a shard; ``block``: documents of a block."""
    spark = docs.sparkSession
    rows = c.id_and_text(docs.withColumn(id_col, docs[id_col].cast("long")), id_col, text_col)
    asked = queries.select(F.col(query_id_col).cast("long").alias("query_id"),
                           F.coalesce(F.col(query_text_col), F.lit("")).alias("text"))
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(-(-size["n"] // query_rows), -(-(size["bytes"] or 0) // query_bytes), 1)
    done = spark.createDataFrame([], "query_id long, rank int, doc_id long, score long")
    for p in range(parts):
        here = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == p).orderBy("query_id", "text").collect()
        found = _search_block(rows, Queries.read(here), k, block, shard_cells) if here else None
        if found is not None:
            done = done.unionByName(found if parts == 1 else pin(found, "found"))
    return done
