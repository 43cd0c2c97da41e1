"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors become integers, ``floor(scale * c) + offset``.  One pass sums them, a
second sums the products of their deviations from the rounded mean; both sums
are exact integers (products of blocks run in double precision where that is
exact), so neither the order of the tasks nor a repeated task changes a bit.
What reaches the driver is a number a pair of dimensions, whatever the rows.

There the covariance is factored, ``V[p, p] = L L'``, always taking the largest
remaining variance as the next pivot, which also finds the rank.  One-sided
Jacobi turns the columns of the triangular factor itself against each other
until all are orthogonal: their squared norms are the eigenvalues of ``V``, and
the columns, normalised and put back in the order of the dimensions, its unit
eigenvectors.  ``V`` is never squared or rotated, so small eigenvalues keep
their digits.

Edge cases: rows whose vector is null, or holds a null or non-finite entry (or
one of 2^42 or more after scaling, whose sums would pass 38 digits), are
dropped; so are vectors shorter than the longest, whose missing entries count
as null.  Null
and repeated ids are rows like others.  There are no more components than the
covariance has rank, so equal rows, a single row and an empty table give no
row.  Equal eigenvalues leave their components' directions open.  Vectors of
more than ``MAX_DIM`` entries are refused.  A ``deviation`` beyond 38 digits is
null.  A caller's column named like an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise, record, table, unpack

COMPONENTS, SCALE, OFFSET = 8, 1024, 100_000
#: The driver holds a few matrices of this many rows and columns at most.
MAX_DIM = 4096
#: Rows of a block of vectors, at 64 dimensions.
BLOCK = 1 << 14
#: Integers below this are exact in double precision.
EXACT = 1 << 53
#: Scaled entries are below this, so that sums of products stay within 38 digits.
LARGEST = 1 << 42
_WIDE = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``components[i]`` is the unit eigenvector of ``values[i]``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def centre(self) -> np.ndarray:
        """The mean, rounded: deviations from it are exact integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """``sums - n * centre``, at most n / 2 in size."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]


# -- vectors -------------------------------------------------------------------
def _integers(column: pa.ListArray, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of the usable rows, a length at a time."""
    size = np.asarray(column.value_lengths().fill_null(-1))
    usable = size >= 0
    edge = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale
    for d in np.unique(size[usable]).tolist():
        rows = np.flatnonzero(size == d)
        step = max(1, BLOCK * 64 // max(d, 64))
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            x = flat[edge[part][:, None] + np.arange(d)]
            with np.errstate(invalid="ignore"):
                good = (np.abs(x) < LARGEST).all(1)  # false for nulls, too
            yield part[good], np.floor(x[good]).astype(np.int64) + offset


def _column(batch: pa.RecordBatch, name: str) -> pa.ListArray:
    c = batch.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _total(x: np.ndarray) -> list[int]:
    """Exact column sums."""
    if len(x) and int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62:
        x = x.astype(object)
    return [int(v) for v in x.sum(0)]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` as Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top >= EXACT:
        y = y.astype(object)
        return y.T.dot(y)
    step = max(1, (EXACT - 1) // max(top * top, 1))
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for k in range(0, len(y), step):
        part = y[k:k + step].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


# -- fit -----------------------------------------------------------------------
def _sums(slim: DataFrame, scale: int, offset: int) -> tuple[int, list[int]]:
    """Rows and column sums of the longest vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _integers(_column(batch, "v"), scale, offset):
                if x.shape[1] > MAX_DIM:
                    raise ValueError(f"a vector has {x.shape[1]} entries, more than {MAX_DIM}")
                if len(rows):
                    n, s = held.get(x.shape[1], (0, [0] * x.shape[1]))
                    held[x.shape[1]] = [n + len(rows), [a + b for a, b in zip(s, _total(x))]]
        for d, (n, s) in held.items():  # position -1 holds the count
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                 pa.array([Decimal(v) for v in [n] + s], _WIDE)], names=["dim", "i", "v"])

    part = slim.mapInArrow(run, "dim int, i int, v decimal(38,0)").groupBy("dim", "i").agg(F.sum("v").alias("v"))
    # Lengths are few, and at most MAX_DIM: a row a length, then one length's sums.
    part = materialise(part, "whitening-sums")
    dim = part.agg(F.max("dim")).first()[0]
    if dim is None:
        return 0, []
    got = {r.i: int(r.v) for r in part.where(F.col("dim") == dim).collect()}
    return got[-1], [got[i] for i in range(dim)]


def _scatter(slim: DataFrame, centre: np.ndarray, scale: int, offset: int) -> list[list[int]]:
    """Exact sums of products of deviations from ``centre``."""
    dim = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((dim, dim), object)
        for batch in batches:
            for rows, x in _integers(_column(batch, "v"), scale, offset):
                if x.shape[1] == dim and len(rows):
                    held = held + _products(x - centre)
        for i in range(dim):
            if any(held[i]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * (dim - i), pa.int32()), pa.array(range(i, dim), pa.int32()),
                     pa.array([Decimal(int(v)) for v in held[i, i:]], _WIDE)], names=["i", "j", "v"])

    out = [[0] * dim for _ in range(dim)]
    for r in slim.mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i][r.j] = out[r.j][r.i] = int(r.v)
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order ``p`` and lower triangular ``L`` of the rank's width with ``V[p, p] = L L'``."""
    d = len(v)
    order, left = np.arange(d), v.diagonal().copy()
    out = np.zeros((d, d))
    least = left.max(initial=0) * d * np.finfo(float).eps
    for k in range(d):
        best = k + int(np.argmax(left[k:]))
        if not left[best] > least:
            return order, out[:, :k]
        for a in (order, left):
            a[[k, best]] = a[[best, k]]
        out[[k, best]] = out[[best, k]]
        out[k, k] = np.sqrt(left[k])
        out[k + 1:, k] = (v[order[k + 1:], order[k]] - out[k + 1:, :k] @ out[k, :k]) / out[k, k]
        left[k + 1:] -= out[k + 1:, k] ** 2
    return order, out


def one_sided_jacobi(x: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Turn pairs of columns until all are orthogonal to double precision.  A
    round turns disjoint pairs together; the rounds of a sweep meet every pair."""
    x = x.copy()
    r = x.shape[1]
    seats = list(range(r)) + [-1] * (r % 2)
    small = np.finfo(float).eps * max(1, r) ** 0.5
    for _ in range(sweeps):
        turned = False
        for _ in range(max(1, len(seats) - 1)):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a >= 0 and b >= 0]
            seats = seats[:1] + seats[-1:] + seats[1:-1]
            if not pairs:
                continue
            p, q = np.array(pairs).T
            u, w = x[:, p], x[:, q]
            a, b, c = (u * u).sum(0), (w * w).sum(0), (u * w).sum(0)
            off = np.abs(c) > small * np.sqrt(a * b)
            if not off.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                z = (b - a) / (2 * c)
                t = np.where(off, np.copysign(1, z) / (np.abs(z) + np.sqrt(1 + z * z)), 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            x[:, p], x[:, q] = cos * u - cos * t * w, cos * t * u + cos * w
        if not turned:
            break
    return x


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a covariance, falling, and their unit eigenvectors as rows."""
    order, low = pivoted_cholesky(v)
    if not low.shape[1]:
        return np.zeros(0), np.zeros((0, len(v)))
    turned = np.empty_like(low)
    turned[order] = one_sided_jacobi(low)
    norm = np.sqrt((turned * turned).sum(0))
    by = np.argsort(-norm, kind="stable")
    unit = (turned[:, by] / norm[by]).T
    # Either sign would do: the largest entry is positive.
    big = unit[np.arange(len(unit)), np.abs(unit).argmax(1)]
    return norm[by] ** 2, unit * np.sign(big)[:, None]


def _slim(vectors: DataFrame, vector: str, rec=None) -> DataFrame:
    v = F.col(vector).cast("array<double>").alias("v")
    return vectors.select(v) if rec is None else vectors.select(rec, v)


def fit(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """Mean, eigenvalues and components of all usable rows; the rank's components."""
    slim = _slim(vectors, vector)
    n, sums = _sums(slim, scale, offset)
    model = Whitening(n, tuple(sums), np.zeros(0), np.zeros((0, len(sums))), 0.0, scale, offset)
    if not n or not sums:
        return model
    products, rest = _scatter(slim, model.centre, scale, offset), model.rest
    # n * products - rest rest' is n^2 times the covariance, exactly.
    v = np.array([[(n * g - a * b) / (n * n) for g, b in zip(row, rest)] for row, a in zip(products, rest)])
    trace = sum(n * products[i][i] - rest[i] ** 2 for i in range(len(rest))) / (n * n)
    values, components = eigen(v)
    return Whitening(n, tuple(sums), values, components, trace, scale, offset)


# -- apply ---------------------------------------------------------------------
def project(model: Whitening, vectors: DataFrame, vector: str = "embedding", k: int = COMPONENTS,
            keep: list[str] | None = None) -> DataFrame:
    """A row per usable vector: ``rec`` (its columns ``keep``), ``deviation``
    (decimal) and ``whitened`` (array of the first ``k`` components, at most the rank)."""
    kept = vectors.columns if keep is None else keep
    rec = record(vectors, keep=kept) if kept else F.struct(F.lit(None).cast("int").alias("k")).alias("rec")
    rows = _slim(vectors, vector, rec)
    values, base = model.values[:k], model.components[:k]
    schema = T.StructType([T.StructField("rec", rows.schema["rec"].dataType), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    centre, rest, n = model.centre, model.rest, model.n
    weights = base.T / np.sqrt(values)
    scale, offset = model.scale, model.offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _integers(_column(batch, "v"), scale, offset):
                if x.shape[1] != len(centre) or not len(rows):
                    continue
                y = x - centre
                w = (y - np.array(rest) / n) @ weights
                top = (n * int(np.abs(y).max(initial=0)) + n) ** 2 * len(centre)
                z = y if top < 1 << 62 else y.astype(object)
                z = z * n - np.array(rest, z.dtype)
                square = (z * z).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rec").take(pa.array(rows)),
                     pa.array([Decimal(int(s)) if s < 10 ** 38 else None for s in square], _WIDE),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))],
                    names=["rec", "deviation", "whitened"])

    return rows.mapInArrow(run, schema)


def identity_error(projected: DataFrame) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    def partial(mean: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, held = 0, None
            for batch in batches:
                if batch.num_rows:
                    w = _column(batch, "whitened").flatten().to_numpy().reshape(batch.num_rows, -1)
                    got = w.sum(0)[None] if mean is None else (w - mean).T @ (w - mean)
                    n, held = n + len(w), got if held is None else held + got
            if n:
                for i, row in enumerate(held):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(row), pa.int32()), pa.array(range(len(row)), pa.int32()),
                         pa.array(row), pa.array([n] * len(row), pa.int64())], names=["i", "j", "v", "n"])
        return run

    def average(mean: np.ndarray | None) -> np.ndarray:
        got = (projected.select("whitened").mapInArrow(partial(mean), "i int, j int, v double, n bigint")
               .groupBy("i", "j").agg((F.sum("v") / F.sum("n")).alias("v")).collect())
        out = np.zeros((max(r.i for r in got) + 1, max(r.j for r in got) + 1))
        for r in got:
            out[r.i, r.j] = r.v
        return out

    covariance = average(average(None)[0])
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(vectors: DataFrame, vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE,
           offset: int = OFFSET, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of each usable row (all by default), once per component,
    with ``component n deviation whitened explained identity_error``."""
    kept = vectors.columns if keep is None else keep
    model = fit(vectors, vector, scale, offset)
    rows = project(model, vectors, vector, k, keep)
    error, share = 0.0, [0.0]
    if len(model.values):
        rows = materialise(rows, "whitened")
        error, share = identity_error(rows), (model.values[:k] / model.trace).tolist()
    each = rows.select("rec", "deviation", F.posexplode("whitened").alias("i", "w"))
    return each.select(*unpack(kept, {
        "component": (F.col("i") + 1).cast("int"), "n": F.lit(model.n).cast("bigint"), "deviation": F.col("deviation"),
        "whitened": F.col("w"), "explained": F.array(*map(F.lit, share))[F.col("i")], "identity_error": F.lit(error)}))


def op13_cholesky_jacobi(spark, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))
