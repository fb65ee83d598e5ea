"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

1. Vectors become integers ``x = floor(1024 * c) + 100000``; one scan gives
   their number ``n`` and the exact sums ``S`` of every dimension.
2. A second scan centres every row (``x - S / n``), multiplies, and adds up the
   scatter: a task emits the upper triangle of its own part, the cells are
   summed by Spark.
3. The driver holds one dimension x dimension matrix, whatever the number of
   rows (32 MB at 2048 dimensions).  ``pivoted_cholesky`` factors it, stopping
   at the rank; ``jacobi`` turns the columns of the triangular factor against
   each other until they are orthogonal.  With ``A = L L'`` the rotated columns'
   squared norms are A's eigenvalues and the normalised columns its
   eigenvectors, so no product of the factor is ever formed.
4. A third scan projects the rows and adds up the covariance of the result, which
   is compared with the identity; the last one returns the projections.

Defined cases: a null vector, and one with a null, non-finite or (as an integer
beyond 2^52) unrepresentable entry takes no part; nor does one whose length is
not the commonest of the rest (ties: the longer), which covers empty vectors.
Null and repeated ids are rows like others, and so are repeated vectors.  Directions
without variance give no component: equal vectors, a single vector and an empty
table give no row.  Equal eigenvalues leave the choice of their basis open; a
component's largest entry is positive.  Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import prepare

SCALE, SHIFT = 1024, 100_000
#: Rows that a task centres and multiplies at a time.
CHUNK = 8_192


def integers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, int64 matrix) of the usable vectors of an Arrow list array, one matrix for each length."""
    length = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()
    good = flat.is_valid().to_numpy(zero_copy_only=False)
    value = np.floor(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    good &= np.isfinite(value) & (np.abs(value) < 2.0 ** 52)
    start = np.cumsum(length) - length
    for size in np.unique(length[length > 0]):
        at = np.flatnonzero(length == size)
        cells = start[at, None] + np.arange(size)
        whole = good[cells].all(axis=1)
        yield at[whole], value[cells[whole]].astype(np.int64) + SHIFT


def _of_size(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at, x in integers(batch.column("_v")):
        if x.shape[1] == dim:
            for k in range(0, len(at), CHUNK):
                yield at[k:k + CHUNK], x[k:k + CHUNK]


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors of the commonest length and their exact sums by dimension."""
    def work(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in integers(batch.column("_v")):
                n, s = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = (n + len(x), s + x.sum(axis=0))
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int64()), pa.array([n], pa.int64()), pa.array([s], pa.list_(pa.int64()))], ["dim", "n", "s"])

    part = rows.select("_v").mapInArrow(work, "dim long, n long, s array<long>")
    cells = part.select("dim", "n", F.posexplode("s").alias("i", "s")).groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    best = (cells.groupBy("dim").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("c"))
            .orderBy(F.desc("n"), F.desc("dim")).limit(1).collect())
    if not best or not best[0]["n"]:
        return 0, np.zeros(0, dtype=object)
    return best[0]["n"], np.array([int(c["s"]) for c in best[0]["c"]], dtype=object)


def _scatter(rows: DataFrame, dim: int, centre: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """Sum of z z' over the centred (and projected) vectors; every task emits the upper triangle of its own part."""
    size = dim if turn is None else turn.shape[1]

    def work(batches):
        total = None
        for batch in batches:
            for _, x in _of_size(batch, dim):
                z = x - centre if turn is None else (x - centre) @ turn
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([total[i, i:] for i in range(size)], pa.list_(pa.float64()))], ["i", "v"])

    parts = rows.select("_v").mapInArrow(work, "i int, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("k", "v")).groupBy("i", "k").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((size, size))
    i, j = cells["i"].to_numpy(), (cells["i"] + cells["k"]).to_numpy()
    out[i, j] = out[j, i] = cells["v"].to_numpy()
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` with ``a = L L'`` up to rounding; its columns go by the largest remaining diagonal entry, as many as the rank."""
    left = np.diag(a).astype(float)
    limit = left.max(initial=0.0) * len(a) * np.finfo(float).eps
    out = np.zeros((len(a), len(a)))
    open_ = np.ones(len(a), dtype=bool)
    for k in range(len(a)):
        p = int(np.where(open_, left, -np.inf).argmax())
        if not left[p] > limit:
            return out[:, :k]
        col = (a[:, p] - out[:, :k] @ out[p, :k]) / np.sqrt(left[p])
        out[:, k] = np.where(open_, col, 0.0)  # rows of earlier pivots lie above the triangle
        left = left - out[:, k] ** 2
        open_[p] = False
    return out


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, unit columns), falling, of the factor's columns turned until they are orthogonal.

    A sweep meets every pair of columns once, in rounds of disjoint pairs.
    """
    f = factor.copy()
    m = f.shape[1]
    seats = list(range(m)) + ([None] if m % 2 else [])
    eps = np.finfo(float).eps * max(1.0, np.sqrt(len(f)))
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = [(a, b) for a, b in zip(seats[:len(seats) // 2], reversed(seats[len(seats) // 2:])) if a is not None and b is not None]
            p, q = (np.array(side, dtype=int) for side in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
            x, y = f[:, p], f[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) > eps * np.sqrt(xx * yy)
            if off.any():
                turned = True
                zeta = (yy[off] - xx[off]) / (2.0 * xy[off])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                s = c * t
                f[:, p[off]], f[:, q[off]] = c * x[:, off] - s * y[:, off], s * x[:, off] + c * y[:, off]
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if not turned:
            break
    value = (f * f).sum(0)
    order = np.argsort(-value, kind="stable")
    value, unit = value[order], f[:, order]
    unit = unit / np.sqrt(value)
    sign = np.sign(unit[np.abs(unit).argmax(axis=0), np.arange(m)]) if m else np.ones(0)
    return value, unit * sign


@dataclass
class Whitening:
    """``dim`` dimensions of ``n`` vectors: exact sums, eigenvalues of the covariance, unit components (columns)."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        # the rounded quotient of two integers of any length
        return np.array([s / self.n for s in self.sums], dtype=float)

    def turn(self, k: int) -> np.ndarray:
        return self.components[:, :k] / np.sqrt(self.values[:k])


def fit(df: DataFrame, vec_col: str = "embedding") -> Whitening:
    """Eigenvalues and components of the covariance of all usable vectors."""
    prepare(df.sparkSession)
    rows = df.select(F.col(vec_col).alias("_v"))
    n, total = sums(rows)
    if not n:
        return Whitening(0, total, np.zeros(0), np.zeros((0, 0)), 0.0)
    centre = np.array([s / n for s in total], dtype=float)
    scatter = _scatter(rows, len(total), centre)
    value, unit = jacobi(pivoted_cholesky(scatter))
    return Whitening(n, total, value / n, unit, float(np.trace(scatter)) / n)


def identity_error(df: DataFrame, model: Whitening, k: int, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    rows = df.select(F.col(vec_col).alias("_v"))
    k = min(k, len(model.values))
    if not k:
        return 0.0
    scatter = _scatter(rows, len(model.sums), model.centre, model.turn(k))
    return float(np.abs(scatter / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int]:
    """Sum over dimensions of ``(n x - S)^2`` for every row, exact."""
    mid = np.array([int(s) // n for s in total], dtype=np.int64)
    rest = np.array([int(s) - n * int(m) for s, m in zip(total, mid)], dtype=object)
    near = x - mid
    reach = (int(np.abs(near).max(initial=0)) + 1) * n
    if reach * reach * len(total) < 1 << 62:
        d = n * near - rest.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * near.astype(object) - rest
    return (d * d).sum(axis=1).tolist()


def whiten(df: DataFrame, model: Whitening, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, deviation, whitened, explained): the usable vectors on the first ``k`` components."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("_v"))
    schema = f"id {dict(rows.dtypes)['id']}, component int, deviation decimal(38,0), whitened double, explained double"
    k = min(k, len(model.values))
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    n, total, centre, turn, dim = model.n, model.sums, model.centre, model.turn(k), len(model.sums)
    explained = model.values[:k] / model.trace

    def work(batches):
        for batch in batches:
            for at, x in _of_size(batch, dim):
                if not len(at):
                    continue
                away = pa.array([Decimal(d) for d in deviations(x, n, total)], pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    away.take(each), pa.array(((x - centre) @ turn).ravel()), pa.array(np.tile(explained, len(at)))],
                    ["id", "component", "deviation", "whitened", "explained"])

    return rows.mapInArrow(work, schema)
