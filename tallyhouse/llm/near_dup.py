"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash
signatures, confirmed on the full shingle sets.

A signature has ``chunks * width`` positions of 16 bits.  It is cut into
chunks, and each chunk is entered once per position with that position left
out, so two signatures meet if some chunk differs in at most one position.  By
the pigeonhole principle all pairs that differ in fewer than ``2 * chunks``
positions (20 of 50) meet.  A pair at similarity 0.8 fails to meet in all ten
chunks with a chance of 1.6e-6, and pairs that differ in more than
``max_distance`` positions (less likely still) are not compared.

Documents with the same set are one representative (with a number of its own)
before anything is joined, so copies cost nothing.  Links between representatives are then found without
listing all pairs of a crowded key:

1. in a key of at most ``small_key`` members all pairs are tried; in a larger
   one every member is tried against the key's smallest id;
2. confirmed links are joined into components; large keys whose members now
   belong to one component are finished;
3. in an unfinished key the members outside its largest component are compared
   with all others, in blocks of bounded rows and bytes that any task can take.
   A pair that has met inside the block (through links found before) is not
   tried, nor is one that an earlier key of both brings together; blocks give
   links between components, never pairs to be tried.

Every pair that meets is thus either tried or already in one component, so the
components are those of all links.  Shingles are compared by 64-bit hashes.

Defined cases: null and empty texts have an empty set and stand alone; a text
with fewer words than the shingle is one shingle; every row is judged by its
own text, so rows that repeat an id get the same result only if their texts are
linked; rows without an id stand alone and are kept; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import common as c
from tallyhouse.operators.keys import pin

_SLICE = 1 << 20
_PROFILE = "doc_id long, text_hash long, n_shingles long, digest_a long, digest_b long, signature binary"


def shingle_sets(column: pa.ChunkedArray | pa.Array, size: int
                 ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of rows a..b: the distinct shingle hashes in row order, and
    the index of each row's first one (one more at the end)."""
    data, offsets = c.utf8(column)
    for a, b in c.row_slices(offsets, _SLICE):
        part = c.LOWER[data[offsets[a]:offsets[b]]]
        starts, ends, first = c.words_of(part, offsets[a:b + 1] - offsets[a], c.NOT_SPACE)
        words, count = c.word_hashes(part, starts, ends), np.diff(first)
        own = np.repeat(np.arange(b - a), count)
        hashes, at = c.window_hashes(words, first, size)
        found, rows = [hashes], [own[at]]
        for n in range(1, size):  # texts shorter than a shingle
            if (count == n).any():
                h, at = c.window_hashes(words, first, n)
                whole = count[own[at]] == n
                found.append(h[whole])
                rows.append(own[at][whole])
        hashes, own = np.concatenate(found), np.concatenate(rows)
        order = np.lexsort((hashes, own))
        hashes, own = hashes[order], own[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])
        hashes, own = hashes[new], own[new]
        yield a, b, hashes, np.searchsorted(own, np.arange(b - a + 1))


def _profiles(size: int, flips: np.ndarray, factors: np.ndarray):
    """Set size, an order-free 128-bit digest of the set, and its signature."""
    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, first in shingle_sets(batch.column("text"), size):
                count = np.diff(first)
                full, at = np.flatnonzero(count), first[:-1][count > 0]
                digests = np.zeros((2, b - a), np.uint64)
                signature = np.zeros((b - a, len(flips)), np.uint16)
                if len(full):
                    with np.errstate(over="ignore"):
                        digests[0, full] = np.add.reduceat(c.mix(hashes), at)
                        digests[1, full] = np.add.reduceat(c.mix(~hashes), at)
                        for j, (flip, factor) in enumerate(zip(flips, factors)):
                            least = np.minimum.reduceat(((hashes ^ flip) * factor) >> np.uint64(32), at)
                            signature[full, j] = c.mix(least).astype(np.uint16)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "text_hash": batch.column("text_hash").slice(a, b - a), "n_shingles": count.astype(np.int64),
                    "digest_a": digests[0].view(np.int64), "digest_b": digests[1].view(np.int64),
                    "signature": pa.array([row.tobytes() for row in signature], pa.binary())})
    return profiles


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _key_columns(signatures: np.ndarray, chunks: int, width: int) -> Iterator[np.ndarray]:
    """One key for each chunk and each position left out of it."""
    signatures = signatures.astype(np.uint64)
    for k in range(chunks):
        for out in range(width):
            key = np.full(len(signatures), k * width + out, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(width):
                    if j != out:
                        key = c.mix(key * np.uint64(65599) + signatures[:, k * width + j] + np.uint64(1))
            yield key.view(np.int64)


def _keys(chunks: int, width: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                for key in _key_columns(_signatures(batch.column("signature")), chunks, width):
                    yield pa.record_batch({"key": key, "rep": batch.column("rep"), "n": batch.column("n")})
    return keys


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many positions each row of ``left`` differs from each of ``right``."""
    out = np.zeros((len(left), len(right)), np.uint8 if left.shape[1] < 256 else np.uint16)
    for a, b in zip(left.T, right.T):
        out += a[:, None] != b[None, :]
    return out


def _compare_blocks(chunks: int, width: int, percent: int, max_distance: int):
    """Links between a block of a key's outside members and a block of all its
    members.  Components that meet here are one from then on, so what is left to
    confirm shrinks with every link; a pair that meets in several keys is
    confirmed in the first."""
    def compare(key: tuple, outside: pa.Table, members: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if len(outside) and len(members):
            left, right = (_signatures(t.column("signature").combine_chunks()) for t in (outside, members))
            n, m = outside.column("n").to_numpy(), members.column("n").to_numpy()
            ids, others = outside.column("rep").to_numpy(), members.column("rep").to_numpy()
            label, other = (t.column("component").to_numpy().copy() for t in (outside, members))
            close = _distances(left, right) <= max_distance
            keys = [np.stack(list(_key_columns(x, chunks, width)), 1) for x in (left, right)]
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in members.column("hashes")]
            for i, own in enumerate(outside.column("hashes")):
                near = np.flatnonzero(close[i] & (other != label[i])
                                      & (100 * np.minimum(m, n[i]) >= percent * np.maximum(m, n[i])))
                if len(near):
                    shared = keys[0][i] == keys[1][near]
                    near = near[keys[0][i][shared.argmax(1)] == key[0].as_py()]
                own = np.frombuffer(own.as_buffer(), np.uint64)
                while len(near):
                    now, near = near[:32], near[32:]
                    both = c.in_sorted(np.concatenate([sets[k] for k in now]), own)
                    both = np.add.reduceat(both.astype(np.int64), np.concatenate(([0], np.cumsum(m[now])[:-1])))
                    for k in now[100 * both >= percent * (m[now] + n[i] - both)].tolist():
                        if other[k] != label[i]:
                            found.append((ids[i], others[k]))
                            old = other[k]
                            other[other == old] = label[i]
                            label[label == old] = label[i]
                    near = near[other[near] != label[i]]
        a, b = (np.array([p[k] for p in found], np.int64) for k in (0, 1))
        return pa.table({"a": a, "b": b})
    return compare


def _close(max_distance: int):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                far = (_signatures(batch.column("sa")) != _signatures(batch.column("sb"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(far <= max_distance))
    return close


_BITMAP = 1 << 23


def _set_rows(size: int, bitmap: np.ndarray):
    """Shingle sets of the rows whose place is set in the bitmap."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy().astype(np.uint64)
            batch = batch.filter(pa.array((bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)) > 0))
            for a, b, hashes, first in shingle_sets(batch.column("text"), size):
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "text_hash": batch.column("text_hash").slice(a, b - a),
                    "hashes": pa.array([hashes[x:y].tobytes() for x, y in zip(first, first[1:])], pa.binary())})
    return rows


def _confirmed(percent: int):
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return confirmed


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges as a forest: every node that is not the smallest of its component,
    and that smallest node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as a forest, in bounded memory: a forest that has grown
    beyond ``_NODES`` is handed on and a new one begun."""
    a, b, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def grown() -> tuple[np.ndarray, np.ndarray]:
        new = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in waiting]
        waiting.clear()
        return forest(np.concatenate([a, *(x for x, _ in new)]), np.concatenate([b, *(y for _, y in new)]))

    def rows() -> pa.RecordBatch:
        return pa.record_batch({"a": a, "b": b})

    for batch in batches:
        waiting.append(batch)
        held += len(batch)
        if held >= max(_NODES // 4, len(a)):
            (a, b), held = grown(), 0
            if len(a) > _NODES:
                yield rows()
                a, b = a[:0], b[:0]
    a, b = grown()
    yield rows()


_NODES = 1 << 21


def linked(edges: DataFrame, task_edges: int = 1 << 20, patience: float = 0.5) -> DataFrame:
    """(id, component) for every node of the edges (a, b) that is not the smallest
    of its component.

    A task turns the edges it reads into a forest, and the next pass reads several
    tasks' forests in one, about ``task_edges`` edges a task, without a shuffle,
    until one task has read the last.  Where a pass leaves more than ``patience``
    of the tasks, a round of hooking follows: every label goes to its smallest
    neighbour, that one's and so on for eight steps, which shrinks the edges by
    joins."""
    def pass_over(rows: DataFrame) -> tuple[DataFrame, int]:
        done = pin(rows.select("a", "b").mapInArrow(_forest, "a long, b long"), "forest")
        return done, max(1, -(-done.count() // task_edges))

    edges, tasks = pass_over(edges)
    hooks = []
    while True:
        edges, left = pass_over(edges.coalesce(tasks))
        if tasks == 1:
            break
        if left > patience * tasks:
            up, edges = _hook(edges)
            hooks.append(up)
            edges, left = pass_over(edges)
        tasks = left
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    for up in reversed(hooks):  # a node's component is that of its label
        of_label = found.select(F.col("id").alias("p"), F.col("component").alias("q"))
        found = pin(up.join(of_label, "p", "left").select(F.col("a").alias("id"), F.coalesce("q", "p").alias(
            "component")).filter("id != component"), "found")
    return found


def _hook(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node's new label (a, p), and the edges between different labels."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    up = pin(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parents")
    for _ in range(3):
        up = up.join(up.select(F.col("a").alias("p"), F.col("p").alias("q")), "p").select("a", F.col("q").alias("p"))
    up = pin(up, "parents")
    left = (edges.join(up.withColumnRenamed("p", "x"), "a")
            .join(up.select(F.col("a").alias("b"), F.col("p").alias("y")), "b")
            .filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    return up, left


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) for nodes (id) and edges (a, b): each node's smallest reachable id."""
    return nodes.select("id").join(linked(edges), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))


class _Search:
    """Tries pairs of representatives and keeps the components found."""

    def __init__(self, rows: DataFrame, reps: DataFrame, size: int, percent: int, max_distance: int) -> None:
        self.rows, self.reps, self.size, self.percent = rows, reps, size, percent
        self.max_distance = max_distance
        self.links: DataFrame | None = None  # node, smallest node of its component

    def labelled(self, members: DataFrame) -> DataFrame:
        """Members (rep) with the component that the links so far give them."""
        if self.links is None:
            return members.withColumn("component", F.col("rep"))
        found = self.links.withColumnRenamed("id", "rep")
        return members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def _sets(self, ids: DataFrame) -> DataFrame:
        """The shingle sets of the representatives asked for (id), made from the
        row that each of them stands for.  The scan is told of them by a bitmap of
        fixed size over hashed rows; the few others that pass it leave in the join,
        which moves sets, never texts."""
        wanted = self.reps.join(ids.withColumnRenamed("id", "rep"), "rep", "left_semi").select(
            F.col("rep").alias("id"), F.col("least.doc_id").alias("doc_id"), F.col("least.text_hash").alias("text_hash"))
        place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(_BITMAP)).alias("place")
        wanted = pin(wanted.select("*", place), "wanted")
        bitmap = np.zeros(_BITMAP >> 6, np.uint64)
        for r in wanted.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr(
                "shiftleft(1L, cast(place & 63 as int))")).alias("bits")).collect():  # at most _BITMAP / 64 rows
            bitmap[r["word"]] = r["bits"] & c.MASK64
        rows = self.rows.select("doc_id", "text_hash", "text", place).mapInArrow(
            _set_rows(self.size, bitmap), "doc_id long, text_hash long, hashes binary")
        return pin(rows.join(wanted.drop("place"), ["doc_id", "text_hash"]).select("id", "hashes").dropDuplicates(["id"]),
                   "sets")

    def try_pairs(self, pairs: DataFrame) -> None:
        """``pairs`` (a, b, na, nb): a and b meet in some key."""
        fits = (100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")) & (F.col("a") != F.col("b"))
        pairs = pairs.filter(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        signed = (pairs.join(self.reps.select(F.col("rep").alias("a"), F.col("signature").alias("sa")), "a")
                  .join(self.reps.select(F.col("rep").alias("b"), F.col("signature").alias("sb")), "b"))
        near = pin(signed.select("a", "b", "sa", "sb").mapInArrow(_close(self.max_distance), "a long, b long"), "pairs")
        sets = self._sets(near.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        self._link(near.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a")
                   .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")
                   .mapInArrow(_confirmed(self.percent), "a long, b long"))

    def try_blocks(self, left: DataFrame, chunks: int, width: int, block: int, block_bytes: int) -> None:
        """Every outside member of an unfinished key against all its members,
        block by block; only links come out."""
        sets = self._sets(left.select(F.col("rep").alias("id")).distinct()).withColumnRenamed("id", "rep")
        outside = F.col("component") != F.col("main")
        held = lambda rows, where: F.ceil(F.greatest(
            F.count_if(where) / rows, 8 * F.sum(F.when(where, F.col("n")).otherwise(0)) / block_bytes))
        blocks = left.groupBy("key").agg(held(block, outside).alias("la"), held(4 * block, F.lit(True)).alias("lb"))
        placed = pin(left.join(blocks, "key").withColumns(
            {"x": F.pmod(F.xxhash64("rep"), "la"), "y": F.pmod(F.xxhash64("rep"), "lb")}), "placed")
        columns = ["key", "rep", "n", "component"]
        a = placed.filter(outside).select(*columns, "x", F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("y"))
        b = placed.select(*columns, F.explode(F.sequence(F.lit(0), F.col("la") - 1)).alias("x"), "y")
        # the sets join last and are not kept: they are the bulk of a block
        data = self.reps.select("rep", "signature").join(sets, "rep")
        a, b = a.join(data, "rep"), b.join(data, "rep")
        b = b.select(*[F.col(x).alias(x) for x in b.columns])  # tells the two apart
        self._link(a.groupBy("key", "x", "y").cogroup(b.groupBy("key", "x", "y")).applyInArrow(
            _compare_blocks(chunks, width, self.percent, self.max_distance), "a long, b long"))

    def _link(self, links: DataFrame) -> None:
        """Take new links in: with the forest of those before, they give the next.
        They are written first: a task that went on from a confirmed link to the
        forest would hold two workers of Python at once."""
        links = pin(links, "links")
        if self.links is not None:
            links = links.select("a", "b").unionAll(self.links.select("id", "component"))
        self.links = linked(links)

    def unfinished(self, members: DataFrame) -> DataFrame:
        """Members of the keys that hold several components: key, rep, n,
        component and the key's largest component."""
        labelled = self.labelled(members)
        sums = (labelled.groupBy("key", "component").agg(F.count("*").alias("k")).groupBy("key").agg(
            F.count("*").alias("parts"), F.max_by("component", F.struct("k", "component")).alias("main"))
            .filter("parts > 1"))
        return pin(labelled.join(sums.drop("parts"), "key"), "unfinished")


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.select("key", F.col("rep").alias("a"), F.col("n").alias("na"))
    return a.join(right.select("key", F.col("rep").alias("b"), F.col("n").alias("nb")), "key").select(
        "a", "b", "na", "nb")


@c.small_batches
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, chunks: int = 10, width: int = 5, max_distance: int = 25,
                    small_key: int = 16, block: int = 1024, block_bytes: int = 1 << 25) -> DataFrame:
    """One row per document row: doc_id, text_hash (``xxhash64`` of the text),
    n_shingles, component_id (the smallest id reachable), kept (the id is that
    one), and keeper: the row has the smallest (id, text_hash) of its component,
    which only repeated rows share."""
    rows = c.id_and_text(docs.withColumn(id_col, docs[id_col].cast("long")), id_col, text_col).withColumn(
        "text_hash", F.xxhash64("text"))
    flips = np.random.default_rng(77041).integers(0, c.MASK64, chunks * width, dtype=np.uint64)
    factors = np.random.default_rng(90001).integers(0, c.MASK64, chunks * width, dtype=np.uint64) | np.uint64(1)
    scanned = pin(rows.mapInArrow(_profiles(shingle, flips, factors), _PROFILE), "profiles")
    digest, least = ["n_shingles", "digest_a", "digest_b"], F.min(F.struct("doc_id", "text_hash")).alias("least")
    reps = pin(scanned.filter("n_shingles > 0 and doc_id is not null").groupBy(*digest).agg(
        least, F.max("signature").alias("signature")).withColumnRenamed("n_shingles", "n").withColumn(
        "rep", F.monotonically_increasing_id()), "reps")
    keys = reps.select("rep", "n", "signature").mapInArrow(_keys(chunks, width), "key long, rep long, n long")
    hubs = keys.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("size"))
    members = pin(keys.join(hubs.filter("size > 1"), "key").select("key", "rep", "n", "hub", "size"), "members")
    small, large = members.filter(F.col("size") <= small_key), members.filter(F.col("size") > small_key)
    search = _Search(rows, reps, shingle, percent, max_distance)
    search.try_pairs(large.filter("rep != hub.rep").select(
        F.col("rep").alias("a"), F.col("hub.rep").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb")
    ).unionAll(_pairs(small, small).filter("a < b")))
    left = search.unfinished(large.select("key", "rep", "n"))
    if not left.isEmpty():
        search.try_blocks(left, chunks, width, block, block_bytes)
    named = search.labelled(reps.select("rep", F.col("n").alias("n_shingles"), "digest_a", "digest_b", "least"))
    firsts = named.groupBy("component").agg(F.min("least").alias("first"))
    groups = named.join(firsts, "component").select(*digest, "first")
    own = scanned.drop("signature").join(groups, digest, "left")
    alone = F.col("doc_id").isNull() | F.col("first").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return own.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        (alone | (F.struct("doc_id", "text_hash") == F.col("first"))).alias("keeper"))
