"""Whitening of vectors by shifted CholeskyQR.

The centred rows X are never gathered. Each pass adds up the small Gram matrix
of X times the inverses of the triangular factors found so far; its Cholesky
factor is the next one. The first is shifted, so that it exists however badly
conditioned X is. Once the rows are nearly orthonormal the composed factor R
has X = Q R, and its singular values and vectors are those of X.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

#: Rows whose Gram matrix is one product.
BLOCK = 2048
#: Gram passes at most; three are enough unless columns depend on each other.
PASSES = 6
#: Components with a smaller share of the largest standard deviation are rounding, not variance.
RANK = 1e-9
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Grid:
    """Entries c become the integers floor(scale * c) + offset, so that sums and centring are exact."""

    scale: float
    offset: int

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.floor(self.scale * rows.astype(np.float64)) + self.offset
        if x.size and np.abs(x).max() > 1 << 52:
            raise ValueError("an entry is too large for this grid")
        return x.astype(np.int64)


@dataclass
class Whitening:
    """What is fitted for vectors of one length: ``n``, the sums, and per component its unit eigenvector, variance and share."""

    n: int
    total: np.ndarray
    vectors: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        if x.dtype == np.int64:  # exact before the one division
            return (self.n * x - self.total) / self.n
        return x - self.total / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.variance)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - total)^2 of integer rows, exact."""
        d = self.n * x - self.total
        if d.size and float(np.abs(d).max()) ** 2 * d.shape[1] < 2**62:
            return (d * d).sum(1).tolist()
        return (d.astype(object) ** 2).sum(1).tolist()


def _by_length(col: pa.Array, grid: Grid | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch, and their rows, for each length of vectors in it."""
    at, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    size = np.diff(at)
    for dim in np.unique(size[size > 0]).tolist():
        own = np.flatnonzero(size == dim)
        rows = flat[at[own][:, None] + np.arange(dim)]
        yield own, grid(rows) if grid else rows.astype(np.float64)


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor in turn, a column at a time."""
    for r in factors:
        out = np.empty(rows.shape, order="F")
        for j in range(r.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], grid: Grid | None) -> dict[int, np.ndarray]:
    """The sum of ``part`` (a matrix) over blocks of vectors, for each length of vectors.

    Tasks add up their own blocks, then the rows of their matrices are dealt
    by length and row and added as they come, so no task holds more than some
    matrices; the driver gets one for each length.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in _by_length(b.column(0), grid):
                for k in range(0, len(x), BLOCK):
                    one = part(x[k : k + BLOCK])
                    total[x.shape[1]] = total[x.shape[1]] + one if x.shape[1] in total else one
        for dim, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array([r.tobytes() for r in m], pa.binary()), pa.array([m.dtype.str] * len(m))], ["dim", "row", "m", "kind"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            for dim, row, m, kind in zip(*(c.to_pylist() for c in b.columns), strict=True):
                one = np.frombuffer(m, kind)
                total[dim, row, kind] = total[dim, row, kind] + one if (dim, row, kind) in total else one
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.string())], ["dim", "row", "m", "kind"])

    kind = "dim int, row int, m binary, kind string"
    found: dict[int, dict[int, np.ndarray]] = {}
    for r in rows.mapInArrow(blocks, kind).repartition("dim", "row").mapInArrow(add, kind).collect():
        found.setdefault(r.dim, {})[r.row] = np.frombuffer(bytes(r.m), r.kind)
    return {dim: np.array([m[k] for k in range(len(m))]) for dim, m in found.items()}


def usable(vec_col: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite."""
    return F.coalesce((F.size(vec_col) > 0) & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def _plain(vectors: DataFrame, vec_col: str) -> Column:
    """The vector in its own width if that is float, else in doubles."""
    kind = vectors.schema[vec_col].dataType
    own = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    return F.col(vec_col).cast(f"array<{own}>")


def _with_ones(x: np.ndarray) -> np.ndarray:
    """Row 0 of a matrix: the sums, with the number of rows at the end."""
    return np.concatenate([x.sum(0), np.array([len(x)], x.dtype)])[None]


def fit_whitening(vectors: DataFrame, vec_col: str = "embedding", components: int = 32, grid: Grid | None = None) -> dict[int, Whitening]:
    """A ``Whitening`` for each length of vectors, fitted on all usable rows.

    ``vectors`` is read once for the sums, two or three times for Gram
    matrices and once for the covariance of the result, so it should be a
    table, not a long computation. Components without variance are left out.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.where(usable(vec_col)).select(_plain(vectors, vec_col).alias("v"))
    start = _summed(rows, _with_ones, grid)
    none = np.empty(0)
    models = {dim: Whitening(int(m[0, -1]), m[0, :-1], none, none, none) for dim, m in start.items()}
    factors: dict[int, list[np.ndarray]] = {dim: [] for dim in models}
    done: dict[int, np.ndarray] = {}
    for _ in range(PASSES):
        live = {dim: (models[dim], f) for dim, f in factors.items() if dim not in done}
        if not live:
            break

        def gram(x: np.ndarray, live=live) -> np.ndarray:
            model, found = live.get(x.shape[1], (None, None))
            if model is None:
                return np.zeros((0, x.shape[1]))
            q = _solved(model.centred(x), found)
            return q.T @ q

        for dim, g in _summed(rows, gram, grid).items():
            _next_factor(dim, g, factors[dim], done)
    for dim, found in factors.items():
        model = models[dim]
        r = done.get(dim, np.eye(dim))
        for f in reversed(found):
            r = r @ f
        _, sigma, v = np.linalg.svd(r)
        k = min(components, int((sigma > RANK * sigma[0]).sum()) if sigma[0] > 0 else 0)
        v = v[:k] * np.sign(v[np.arange(k), np.abs(v[:k]).argmax(1)])[:, None]
        model.vectors, model.variance = v.T.copy(), sigma[:k] ** 2 / model.n
        model.explained = sigma[:k] ** 2 / max((sigma**2).sum(), np.finfo(float).tiny)

    def moments(x: np.ndarray) -> np.ndarray:
        w = models[x.shape[1]].whitened(x)
        w = np.hstack([w, np.ones((len(w), 1))])
        return w.T @ w

    for dim, m in _summed(rows, moments, grid).items():
        mean = m[-1, :-1] / m[-1, -1]
        cov = m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean)
        models[dim].identity_error = float(np.abs(cov - np.eye(len(cov))).max(initial=0))
    return models


def _next_factor(dim: int, g: np.ndarray, factors: list[np.ndarray], done: dict[int, np.ndarray]) -> None:
    """The Cholesky factor of one Gram matrix: shifted at first, and wherever it would not exist; in ``done`` if it is the last."""
    g = (g + g.T) / 2
    if not np.trace(g):
        done[dim] = np.zeros((dim, dim))
        return
    # Sums of blocks round as a block's rows do.
    shift = 11 * (BLOCK * dim + dim * (dim + 1)) * _EPS * np.trace(g)
    if not factors:
        factors.append(np.linalg.cholesky(g + shift * np.eye(dim)).T)
        return
    level, axes = np.linalg.eigh(g)
    # Dependent columns leave directions of no length; in all others the rows are orthonormal but for a small rest.
    if ((np.abs(level - 1) < 0.5) | (level < RANK)).all():
        done[dim] = np.linalg.cholesky(g).T if level[0] > RANK else np.sqrt(np.maximum(level, 0))[:, None] * axes.T
        return
    factors.append(np.linalg.cholesky(g if level[0] > shift else g + shift * np.eye(dim)).T)


def whiten(vectors: DataFrame, models: dict[int, Whitening], id_col: str = "vec_id", vec_col: str = "embedding", grid: Grid | None = None) -> DataFrame:
    """``id_col, n, deviation, whitened, explained, identity_error`` of each usable row.

    ``whitened`` and ``explained`` have an entry for each component; ``n`` counts
    the rows of this length that the fit has seen. ``deviation`` is null without a grid; one that a LONG cannot hold is an
    error. Vectors that are null, empty or hold null or non-finite entries have
    no row; repeated rows and rows without an id are rows like any other; vectors
    of different lengths are whitened apart; an empty table gives an empty
    result; other columns are ignored. The models are small: some matrices of
    components by entries.
    """
    bounded_batches(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _by_length(b.column(1), grid):
                m = shared.value[x.shape[1]]
                w, n = m.whitened(x), len(x)
                k = w.shape[1]
                lists = lambda flat, n=n, k=k: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(flat.ravel()))
                exact = pa.array(m.deviation(x), pa.int64()) if grid else pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array([m.n] * n, pa.int64()), exact, lists(w), lists(np.tile(m.explained, n)), pa.array([m.identity_error] * n)],
                    [id_col, "n", "deviation", "whitened", "explained", "identity_error"],
                )

    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.where(usable(vec_col)).select(F.col(id_col), _plain(vectors, vec_col).alias("_v"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32, grid: Grid | None = None) -> DataFrame:
    """``whiten`` by a fit on the same rows, with a row for each vector and component, numbered from 1."""
    rows = whiten(vectors, fit_whitening(vectors, vec_col, components, grid), id_col, vec_col, grid)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("_k", "_x")
    return rows.select(id_col, "n", "deviation", "identity_error", each).select(
        id_col, (F.col("_k") + 1).alias("component"), "n", "deviation", F.col("_x.whitened").alias("whitened"), F.col("_x.explained").alias("explained"), "identity_error"
    )
