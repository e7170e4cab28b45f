"""Embedding whitening by FEAST: contour integration finds the leading eigenpairs of a covariance, inertia counts prove them complete.

The table is read in Spark tasks that add up whole-number sums, centred
products and whitened values.  Only the covariance, whose size is that of a
vector squared, comes to the driver.  There a complex contour around an
interval of eigenvalues is integrated by quadrature: each node solves a shifted
system, their sum projects onto the interval's eigenspace, and Rayleigh-Ritz
takes the components out of it.  The signs of the pivots of an elimination
(the inertia) count the eigenvalues of an interval, so that none is missed.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Longest vectors: their covariance must fit in the driver and in a task.
MAX_DIM = 2048
#: Entries from this magnitude on have no exact scaled sums; rows that hold one are dropped like those with infinite ones.
LARGEST = float(1 << 40)
#: Eigenvalues up to this share of the trace are rounding, not variance.
NOISE = 1e-12
#: Eigenvalues that an interval should hold, quadrature nodes on the upper half of its circle, and refinements at most.
PER_INTERVAL, NODES, ROUNDS = 4, 8, 40
_TINY = 2.0 ** -52


# ---- rows --------------------------------------------------------------------------

def vectors(batch: pa.RecordBatch, dim: int | None = None):
    """(length, ids, whole-number rows) of a batch's usable vectors, for each length or for ``dim`` only."""
    vec, ids = batch.column("embedding"), batch.column("vec_id")
    size = np.asarray(pc.fill_null(pc.list_value_length(vec), 0).to_numpy(zero_copy_only=False), np.int64)
    for d in ([dim] if dim is not None else np.unique(size[size > 0]).tolist()):
        rows = np.flatnonzero(size == d)
        if not len(rows):
            continue
        flat = pc.fill_null(vec.take(pa.array(rows)).flatten(), np.nan).to_numpy(zero_copy_only=False)
        c = np.asarray(flat, np.float64).reshape(len(rows), d)
        with np.errstate(invalid="ignore"):
            good = (np.abs(c) < LARGEST).all(1)  # false for NaN
        if good.any():
            yield d, ids.take(pa.array(rows[good])), np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if int(np.abs(x).max()) * len(x) < 1 << 62:
        return x.sum(0).tolist()
    return x.astype(object).sum(0).tolist()


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - S as whole numbers: longs, or Python integers where these would not fit."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max((abs(int(s)) for s in total), default=0))
    if largest < 1 << 62:
        return x * np.int64(n) - total.astype(np.int64)
    return x.astype(object) * n - total


def deviation(y: np.ndarray) -> pa.Array:
    """Sum of squares of each row as longs; null where a long cannot hold it."""
    if y.dtype != object and (y.astype(np.float64) ** 2).sum(1).max(initial=0) < 2.0 ** 62:
        return pa.array((y * y).sum(1))
    y = y.astype(object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (y * y).sum(1)], pa.int64())


# ---- passes over the table ---------------------------------------------------------

def sums(rows: DataFrame) -> tuple[int, int, np.ndarray] | None:
    """(length, n, S) of the usable vectors of the commonest length (of equally common ones the longest), None without any."""
    def run(batches):
        held = {}
        for b in batches:
            for d, _, x in vectors(b):
                n, s = held.get(d, (0, [0] * d))
                held[d] = n + len(x), [p + q for p, q in zip(s, exact_sum(x))]
        for d, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], names=["d", "i", "n", "s"])

    each = written(rows.mapInArrow(run, "d int, i int, n long, s decimal(38,0)")
                   .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")), "vector-sums")
    top = each.where("i = 0").orderBy(F.col("n").desc(), F.col("d").desc()).limit(1).collect()
    if not top:
        return None
    d, n = top[0]["d"], top[0]["n"]
    if d > MAX_DIM:
        raise ValueError(f"vectors of {d} entries: whitening takes up to {MAX_DIM}")
    total = np.array([int(r["s"]) for r in each.where(F.col("d") == d).orderBy("i").collect()], dtype=object)
    return d, n, total


def products(rows: DataFrame, size: int, values) -> np.ndarray:
    """Sum of v v' over all rows, where ``values(batch)`` gives a batch's rows v (of length ``size``): one matrix a task, added up by Spark."""
    i, j = np.triu_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for b in batches:
            v = values(b)
            if len(v):
                total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "v"])

    out = np.zeros((size, size))
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]  # size squared values
    return out


# ---- eigenpairs --------------------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and next diagonal of a tridiagonal matrix similar to symmetric ``v`` (reflections)."""
    a = v.copy()
    for k in range(len(a) - 2):
        u = a[k + 1:, k].copy()
        size = np.linalg.norm(u)
        if size == 0:
            continue
        u[0] += size if u[0] >= 0 else -size
        u /= np.linalg.norm(u)
        part = a[k + 1:, k + 1:]
        w = part @ u
        w -= (u @ w) * u
        part -= 2 * (np.outer(u, w) + np.outer(w, u))
        a[k + 1, k] = -size if u[0] >= 0 else size
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy()


def above(tri: tuple[np.ndarray, np.ndarray], t: float) -> int:
    """Eigenvalues beyond ``t``: the inertia of the matrix less t, which the signs of the pivots of its elimination tell."""
    count, pivot = 0, 1.0
    for x, y in zip((tri[0] - t).tolist(), [0.0, *(tri[1] ** 2).tolist()]):
        pivot = x - y / pivot
        if pivot == 0:
            pivot = -1e-300
        count += pivot > 0
    return count


def last_with(tri, n: int, low: float, high: float) -> float:
    """About the largest point beyond which at least ``n`` eigenvalues lie: the ``n``-th largest one."""
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if above(tri, mid) >= n else (low, mid)
    return low


def intervals(v: np.ndarray, k: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals (low, high, count) that hold the ``k`` largest eigenvalues, and with the k-th one those close to it.

    The lowest end lies in the middle of a gap, the ends between intervals
    where no eigenvalue is near; intervals hold a few eigenvalues each unless
    there is no such place.
    """
    tri = tridiagonal(v)
    high = float(np.abs(v).sum(1).max()) * (1 + 1e-9)  # no eigenvalue is beyond the largest row sum
    found = above(tri, NOISE)
    if not found:
        return []
    least = last_with(tri, min(k, found), NOISE, high)
    while True:
        wanted = above(tri, max(least - 1e-6 * high, NOISE))  # with those close to the last one, up to a gap
        below = last_with(tri, wanted + 1, NOISE, high) if wanted < found else NOISE
        if wanted == found or least - below > 1e-6 * high:
            break
        least = below
    low, found = (below + least) / 2, wanted
    out, todo = [], [(low, high, found)]
    while todo:
        a, b, n = todo.pop()
        free = [m for m in (a + (b - a) * f for f in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8))
                if above(tri, m - 0.01 * (b - a)) == above(tri, m + 0.01 * (b - a))]
        if n <= per or not free or b - a <= 1e-6 * high:
            if n:
                out.append((a, b, n))
            continue
        c = above(tri, free[0]) - above(tri, b)
        todo += [(a, free[0], n - c), (free[0], b, c)]
    return out


def feast(v: np.ndarray, a: float, b: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs of ``v`` in (a, b], by contour integration over a circle through a and b.

    The resolvent of a real symmetric matrix takes conjugate values at
    conjugate points, so that nodes on the upper half are enough.  Each round
    filters the last round's vectors; it ends when ``n`` of the Ritz values lie
    in the interval with residuals of rounding size.
    """
    d = len(v)
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 + x))
    middle, radius = (a + b) / 2, (b - a) / 2
    shifted = (middle + radius * turn)[:, None, None] * np.eye(d) - v
    least = 64 * _TINY * d ** 0.5 * float(np.abs(v).sum(1).max())
    best, size = np.inf, min(d, 2 * n + 4)
    y = np.random.default_rng(7).standard_normal((d, size))
    for _ in range(ROUNDS):
        solved = np.linalg.solve(shifted, np.broadcast_to(y, (NODES, *y.shape)).astype(complex))
        q = (0.5 * radius * (w * turn)[:, None, None] * solved).sum(0).real
        q, _ = np.linalg.qr(q)
        e, u = np.linalg.eigh(q.T @ v @ q)
        y = q @ u
        inside = (e > a) & (e <= b)
        if inside.sum() == n:
            residual = np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max()
            if residual <= least and residual >= 0.5 * best:  # no round makes it better any more
                return e[inside], y[:, inside]
            best = min(best, residual)
    if best <= 1e3 * least:
        return e[inside], y[:, inside]
    raise ArithmeticError(f"{n} eigenvalues in ({a}, {b}], but the projection does not settle on as many")


def leading(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` largest eigenvalues (falling) and unit eigenvectors of a covariance; those of rounding size are none.

    A vector's largest entry is positive.
    """
    trace = float(np.trace(cov))
    if not trace > 0:
        return np.empty(0), np.empty((len(cov), 0))
    v = cov / trace
    parts = [feast(v, *each) for each in intervals(v, k)]
    if not parts:
        return np.empty(0), np.empty((len(cov), 0))
    q, _ = np.linalg.qr(np.hstack([y for _, y in parts]))  # vectors of different intervals, orthogonal to the last bit
    e, u = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-e, kind="stable")[:k]
    e, y = e[order] * trace, (q @ u)[:, order]
    return e, y * np.sign(y[np.abs(y).argmax(0), np.arange(len(e))])


# ---- the operator ------------------------------------------------------------------

@dataclass
class Whitening:
    dim: int
    n: int
    total: np.ndarray        # S, Python integers
    values: np.ndarray       # eigenvalues, falling
    components: np.ndarray   # columns
    explained: np.ndarray
    identity_error: float

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S, whitened values) of whole-number rows."""
        y = centred(x, self.n, self.total)
        return y, (y.astype(np.float64) / self.n) @ (self.components / np.sqrt(self.values))


def _rows(table: DataFrame) -> DataFrame:
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def fit(table: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors of ``table``; None if there are none."""
    rows = _rows(table)
    found = sums(rows)
    if found is None:
        return None
    d, n, total = found

    def values(batch):
        for _, _, x in vectors(batch, d):
            return centred(x, n, total).astype(np.float64) / n
        return np.empty((0, d))

    cov = products(rows, d, values) / n
    e, y = leading(cov, k)
    trace = float(np.trace(cov))
    out = Whitening(d, n, total, e, y, e / trace if trace > 0 else e, 0.0)
    if len(e):
        def whitened(batch):
            for _, _, x in vectors(batch, d):
                return out(x)[1]
            return np.empty((0, len(e)))

        # n * x - S adds up to zero, so that whitened values are centred as they are
        out.identity_error = float(np.abs(products(rows, len(e), whitened) / n - np.eye(len(e))).max())
    return out


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, model: Whitening | None) -> DataFrame:
    """A row per usable vector of ``table(vec_id, embedding)`` and component.

    Vectors that are null, empty or hold null or non-finite entries (or such of
    2^40 and more, whose sums are not exact) have no rows, nor have vectors of
    another length than the commonest.  Repeated rows and null ids are rows
    like any other.  Where all vectors are equal there is no component and no
    row; components of no variance are left out.  A ``deviation`` that a long
    cannot hold is null.  Other columns are not read.
    """
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], SCHEMA)
    k = len(model.values)

    def run(batches):
        for b in batches:
            for _, ids, x in vectors(b, model.dim):
                y, w = model(x)
                each = np.repeat(np.arange(len(x)), k)
                many = len(each)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(many, model.n, np.int64)), deviation(y).take(pa.array(each)), pa.array(w.ravel()),
                     pa.array(np.tile(model.explained, len(x))), pa.array(np.full(many, model.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return _rows(table).mapInArrow(run, SCHEMA)
