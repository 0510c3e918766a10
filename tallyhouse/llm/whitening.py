"""Embedding whitening from an exact covariance by bit-sliced scatter.

Entries become integers, x = floor(64 * c) + 1000000.  Per dimension the
smallest x is subtracted and each bit of what remains is packed across rows
into 64-bit words (a bit plane).  The cross-product of two dimensions is then
the sum over their planes of 2^(a+b) times the count of set bits in the AND of
plane a and plane b: exact, whatever the order of the rows.  Tasks add up one
value per pair of dimensions as Python integers, Spark sums those as decimals,
and n * sum(xy) - sum(x) * sum(y) is taken in integers before anything is
rounded.  ``eigh`` of that matrix gives the components.

What reaches the driver depends on the number of dimensions only.  No row is
shuffled: three small sums, then a pass that projects the rows.

Defined cases: rows whose vector is null or has a null, NaN or infinite entry
(or one of 2^34 and more in size, which no exact long could hold) are left out,
as are empty vectors and those of another length than the most frequent one
(the longest, if several are equally frequent).  A component without variance
(below 1e-10 of the largest) cannot be scaled and is left out, so equal rows
give an empty result, as an empty table does.  Repeated rows and rows without
an id each count and are each returned; a deviation that does not fit a long
is null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLICE = 1 << 13   # rows in a set of bit planes
_LARGEST = 2.0 ** 34
_LEAST_SHARE = 1e-10
_EXACT = pa.decimal128(38, 0)


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _whole(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a vector of ``size`` sound entries, and their integers."""
    fits = pc.equal(pc.list_value_length(column), size).fill_null(False)
    values = column.filter(fits).flatten().fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
    with np.errstate(invalid="ignore"):
        sound = (np.abs(values) < _LARGEST).all(1)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))[sound]
    return at, np.floor(64 * values[sound]).astype(np.int64) + 1000000


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _EXACT)


# --------------------------------------------------------------- count and sums
def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and dimension: rows, exact sum, least and largest integer."""
    seen: dict[int, list] = {}
    for batch in batches:
        column = batch.column("vector")
        for size in pc.unique(pc.list_value_length(column).drop_null()).to_pylist():
            _, x = _whole(column, size) if size else (None, np.zeros((0, 0), np.int64))
            if not len(x):
                continue
            n, total, low, high = seen.get(size, (0, [0] * size, x[0], x[0]))
            parts = [x[a:a + _SLICE].sum(0).tolist() for a in range(0, len(x), _SLICE)]
            total = [t + sum(p) for t, *p in zip(total, *parts)]
            seen[size] = [n + len(x), total, np.minimum(low, x.min(0)), np.maximum(high, x.max(0))]
    for size, (n, total, low, high) in seen.items():
        yield pa.record_batch({"size": pa.array([size] * size, pa.int32()), "dim": pa.array(range(size), pa.int32()),
                               "n": pa.array([n] * size, pa.int64()), "total": _decimals(total),
                               "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})


# -------------------------------------------------------------------- scatter
def bit_planes(y: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative integers (rows x dimensions): one row of
    64-bit words per plane that has a set bit, with its dimension and its bit."""
    planes, dims, at = [], [], []
    short = -len(y) % 64
    for b in range(int(bits.max(initial=0))):
        have = np.flatnonzero(bits > b)
        one = np.pad((y[:, have] >> b & 1).astype(np.uint8), ((0, short), (0, 0)))
        words = np.ascontiguousarray(np.packbits(one, axis=0).T).view(np.uint64)
        some = words.any(1)
        planes.append(words[some])
        dims.append(have[some])
        at.append(np.full(np.count_nonzero(some), b))
    if not planes:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    dims, at = np.concatenate(dims), np.concatenate(at)
    order = np.lexsort((at, dims))
    return np.concatenate(planes)[order], dims[order], at[order]


def scatter(y: np.ndarray, bits: np.ndarray, into: np.ndarray) -> None:
    """Add the cross-products of the columns of ``y`` to ``into`` (Python
    integers, upper triangle)."""
    planes, dims, at = bit_planes(y, bits)
    if not len(planes):
        return
    kind = np.int64 if 2 * int(bits.max()) + len(y).bit_length() < 61 else object
    part = np.zeros(into.shape, kind)
    power = np.array([1 << k for k in range(2 * int(bits.max()))], kind)
    for p, (d, b) in enumerate(zip(dims.tolist(), at.tolist())):
        common = np.bitwise_count(planes[p] & planes[p:]).sum(1, dtype=np.int64).astype(kind)
        weighted = common * power[at[p:] + b]
        own = dims[p:] == d
        weighted[1:][own[1:]] *= 2  # planes a, b and b, a of one dimension
        first = np.flatnonzero(np.diff(dims[p:], prepend=-1))
        part[d, dims[p:][first]] += np.add.reduceat(weighted, first)
    into += part.astype(object)


def _scatter(low: np.ndarray, bits: np.ndarray):
    size = len(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros((size, size), object)
        kept: list[np.ndarray] = []

        def flush() -> None:
            rows = np.concatenate(kept)
            for a in range(0, len(rows), _SLICE):
                scatter(rows[a:a + _SLICE], bits, into)
            kept.clear()

        for batch in batches:
            kept.append(_whole(batch.column("vector"), size)[1] - low)
            if sum(map(len, kept)) >= _SLICE:
                flush()
        if kept:
            flush()
        i, j = np.triu_indices(size)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                               "product": _decimals(into[i, j].tolist())})
    return run


# ------------------------------------------------------------------ projection
@dataclass
class Whitening:
    """A fitted whitening: exact sums, and what projects a row."""

    n: int
    low: np.ndarray           # per dimension, the least integer
    shifted: list[int]        # per dimension, the sum of x - low
    values: np.ndarray        # eigenvalues by falling size
    weights: np.ndarray       # dimensions x components, scaled by 1 / sqrt(eigenvalue)
    explained: np.ndarray     # eigenvalue / trace
    largest: int              # largest x - low
    identity_error: float = math.nan

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.low) - np.array([t / self.n for t in self.shifted])) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum of (n * x - sum)^2 over the dimensions, exact."""
        y = x - self.low
        if (self.n * self.largest) ** 2 * len(self.low) < 1 << 62:
            return ((self.n * y - np.array(self.shifted, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - np.array(self.shifted, object)) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]


def _moments(fit: Whitening, size: int):
    """Per task: sums of the whitened rows and of their products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = fit.weights.shape[1]
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = fit.project(_whole(batch.column("vector"), size)[1])
            first += w.sum(0)
            second += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.record_batch({"i": pa.array(np.concatenate((np.full(k, -1), i)), pa.int32()),
                               "j": pa.array(np.concatenate((np.arange(k), j)), pa.int32()),
                               "moment": np.concatenate((first, second[i, j]))})
    return run


def _project(fit: Whitening, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = fit.weights.shape[1]
        for batch in batches:
            at, x = _whole(batch.column("vector"), size)
            w = fit.project(x)
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(pa.array(at)),
                "deviation": pa.array(fit.deviations(x), pa.int64()),
                "whitened": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), w.ravel())})
    return run


def fit_whitening(rows: DataFrame, components: int = 32, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all sound vectors; None if there are none."""
    vectors = _vectors(rows, id_col, vector_col).select("vector")
    ranges = vectors.mapInArrow(_ranges, "size int, dim int, n long, total decimal(38,0), low long, high long")
    sums = ranges.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                                             F.min("low").alias("low"), F.max("high").alias("high"))
    most = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("size")).select("size").first()
    if most is None:
        return None
    size = most["size"]
    per_dim = sums.filter(F.col("size") == size).orderBy("dim").collect()  # one row per dimension
    n, total = int(per_dim[0]["n"]), [int(r["total"]) for r in per_dim]
    low, high = (np.array([r[x] for r in per_dim], np.int64) for x in ("low", "high"))
    bits = np.array([int(h - m).bit_length() for m, h in zip(low.tolist(), high.tolist())])
    products = vectors.mapInArrow(_scatter(low, bits), "i int, j int, product decimal(38,0)").groupBy("i", "j").agg(
        F.sum("product").alias("product")).collect()  # one row per pair of dimensions
    shifted = [t - n * m for t, m in zip(total, low.tolist())]
    centred = np.zeros((size, size))
    trace = 0
    for r in products:
        exact = n * int(r["product"]) - shifted[r["i"]] * shifted[r["j"]]
        centred[r["i"], r["j"]] = centred[r["j"], r["i"]] = exact / (n * n)
        trace += exact if r["i"] == r["j"] else 0
    values, vectors_ = np.linalg.eigh(centred)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    use = np.flatnonzero((values > 0) & (values > _LEAST_SHARE * max(values[0], 0.0)))[:components]
    return Whitening(n, low, shifted, values[use], vectors_[:, use] / np.sqrt(values[use]),
                     values[use] / (trace / (n * n)) if trace else np.zeros(0), int((high - low).max()))


def _identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity, measured."""
    k = fit.weights.shape[1]
    if not k:
        return 0.0
    sums = vectors.mapInArrow(_moments(fit, len(fit.low)), "i int, j int, moment double").groupBy("i", "j").agg(
        F.sum("moment").alias("moment")).collect()  # components^2 rows
    mean = np.zeros(k)
    for r in sums:
        if r["i"] < 0:
            mean[r["j"]] = r["moment"] / fit.n
    return max(abs(r["moment"] / fit.n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"]))
               for r in sums if r["i"] >= 0)


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per sound vector: vec_id, n, deviation, whitened (array), with
    explained (array) and identity_error, the same in all rows."""
    vectors = _vectors(rows, id_col, vector_col)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, whitened array<double>"
    fit = fit_whitening(rows, components, id_col, vector_col)
    if fit is None:
        done = vectors.limit(0).select("vec_id", F.lit(0).cast("long").alias("deviation"), "vector")
        return done.select("vec_id", F.lit(0).cast("long").alias("n"), "deviation", F.col("vector").alias("whitened"),
                           F.col("vector").alias("explained"), F.lit(0.0).alias("identity_error"))
    fit.identity_error = _identity_error(vectors, fit)
    done = vectors.mapInArrow(_project(fit, len(fit.low)), schema)
    explained = F.array(*[F.lit(float(v)) for v in fit.explained]).cast("array<double>")
    return done.select("vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                       explained.alias("explained"), F.lit(float(fit.identity_error)).alias("identity_error"))
