"""Operator 12: embedding whitening with components from FEAST contour integration.

Spark passes over the vectors give, in turn: sums per dimension (exact integers), the
covariance of the centred integers, the covariance of the whitened values, and the rows.
Only sums and ``dims x dims`` matrices reach the driver, whatever the number of rows;
tasks add up their own rows first, and partial matrices are added in Spark.

The components are eigenvectors of that small matrix, found without a dense eigensolver:

* inertia: the matrix is brought to tridiagonal form once; the signs of the pivots of ``T - s I`` count the
  eigenvalues above ``s`` (Sylvester's law), so bisection finds intervals that hold the largest
  eigenvalues, at most ``PER_INTERVAL`` in each, or one group of equal ones;
* FEAST: the sum of complex shifted solves ``(z I - V)^-1 Y`` over a circle around an interval projects
  a block ``Y`` on its eigenvectors, Rayleigh-Ritz on the projected block gives values and vectors, and both repeat until
  the residuals are at rounding level;
* the inertia count of each interval must equal the number of Ritz values inside, else the block
  is widened and the interval done again: none is missed, none found twice.

Edge cases: a vector that is null or empty or holds null or non-finite entries is dropped, as is one of
another than the most frequent length (of equally frequent ones the longer stays); null and repeated ids stay, each row for itself;
fewer dimensions than components give fewer components; a component without variance (one vector, equal vectors, dependent dimensions)
can't be whitened: its ``whitened`` is null and it is left out of ``identity_error``, which is null if
none is left; entries beyond 2**52 / scale are taken as that bound; a ``deviation`` beyond the range of a long is
null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import matrices

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Eigenvalues that one contour encloses at most (more if they are equal to rounding).
PER_INTERVAL = 8
#: Quadrature nodes on the upper half circle.
NODES = 8
MOST_ROUNDS = 60
SEED = 12
LIMIT = 1 << 52


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * c) + 100000."""
    return np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype(np.int64) + SHIFT


# ------------------------------------------------------------------ eigenvalues of a small matrix

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = v.copy()
    d = len(a)
    for i in range(d - 2):
        x = a[i + 1:, i].copy()
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        rest = a[i + 1:, i + 1:]
        p = rest @ x
        w = p - (x @ p) * x
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[i + 1:, i] -= 2 * x * (x @ a[i + 1:, i])
        a[i, i + 1:] = a[i + 1:, i]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], s: float) -> int:
    """Inertia: how many eigenvalues are above ``s``."""
    diagonal, off = form
    tiny = np.finfo(float).tiny ** 0.5 + np.finfo(float).eps ** 2 * (np.abs(diagonal).max() + np.abs(off).max(initial=0))
    n, pivot = 0, 1.0
    for i, a in enumerate(diagonal.tolist()):
        pivot = a - s - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        n += pivot > 0
    return n


def intervals(form, least: float, most: float, k: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top down, until ``k`` eigenvalues are covered.

    Each interval holds at most ``per``, unless more lie too close together to be told apart; no eigenvalue
    is within rounding of a boundary, where counts and Ritz values could disagree."""
    margin = 256 * np.finfo(float).eps * max(abs(most), abs(least))
    out, high, above = [], most, 0
    while above < k and high > least:
        cut, want = least, above + per
        if count_above(form, least) > want:
            low, top = least, high  # more than wanted above low, not more above top
            while top - low > margin and not min(k, want) <= count_above(form, top) > above:
                mid = (low + top) / 2
                low, top = (mid, top) if count_above(form, mid) > want else (low, mid)
            cut = top if count_above(form, top) > above else low
            while count_above(form, cut + margin) != count_above(form, cut - margin):
                cut -= margin
        n = count_above(form, cut)
        out.append((cut, high, n - above))
        high, above = cut, n
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in [low, high], by contour integration and Rayleigh-Ritz."""
    d, scale = len(v), max(abs(low), abs(high))
    centre, radius = (low + high) / 2, max((high - low) / 2, 64 * np.finfo(float).eps * scale)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (nodes + 1)
    size = min(d, max(2 * count, count + 4))
    while True:
        y = rng.normal(size=(d, size))
        for _ in range(MOST_ROUNDS):
            q = np.zeros((d, y.shape[1]))
            for t, w in zip(angle, weights):
                turn = np.exp(1j * t)
                # the lower half circle adds the conjugate: twice the real part
                q += w / 2 * np.real(radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(d) - v, y))
            basis, _ = np.linalg.qr(q)
            small = basis.T @ v @ basis
            e, u = _ritz((small + small.T) / 2)
            y = basis @ u
            inside = (e >= centre - radius) & (e <= centre + radius)
            worst = np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max(initial=0)
            if inside.sum() == count and worst <= 32 * np.finfo(float).eps * d ** 0.5 * np.abs(v).max():
                return e[inside], y[:, inside]
        if inside.sum() == count and worst <= 1e-10 * scale:
            return e[inside], y[:, inside]
        if size == d:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues found in [{low}, {high}], residual {worst}")
        size = min(d, 2 * size)


def _ritz(small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of the projected block (a handful of rows)."""
    return np.linalg.eigh(small)


def components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and their unit eigenvectors (columns)."""
    k = min(k, len(v))
    v = (v + v.T) / 2
    size = np.abs(v).max(initial=0)
    if size == 0:
        return np.zeros(k), np.eye(len(v))[:, :k]
    form, bound = tridiagonal(v), np.abs(v).sum(axis=1).max()
    rng, found = np.random.default_rng(SEED), []
    for low, high, count in intervals(form, -1.001 * bound, 1.001 * bound, k):
        found.append(feast(v, low, high, count, rng))
    e = np.concatenate([x[0] for x in found])
    u = np.concatenate([x[1] for x in found], axis=1)
    order = np.argsort(-e, kind="stable")[:k]
    return e[order], u[:, order]


# ------------------------------------------------------------------ passes over the vectors

def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per vector length: rows and sums of a task."""
    total: dict[int, list] = {}
    for b in batches:
        for _, c in matrices(b.column(0)):
            x = integers(c)
            held = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            held[0] += len(x)
            held[1] += x.sum(axis=0).astype(object) if np.abs(x).max() < 1 << 40 else x.astype(object).sum(axis=0)
    for dims, (n, s) in total.items():
        yield pa.RecordBatch.from_pydict({"dims": pa.array(np.full(dims, dims, np.int32)), "i": pa.array(np.arange(dims, dtype=np.int32)),
                                          "n": pa.array(np.full(dims, n)), "s": pa.array([str(x) for x in s])})


class Centred:
    """Integer rows of one length, less their mean: ``S = n * whole + rest`` is kept exactly."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dims, self.sums = n, len(sums), sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([s % n / n for s in sums])
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, whole differences, x - S/n)."""
        for rows, c in matrices(column):
            if c.shape[1] == self.dims:
                y = integers(c) - self.whole
                yield rows, y, y - self.part

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 of each row; null beyond the range of a long."""
        if self.dims * (float(np.abs(y).max()) + 1) ** 2 * float(self.n) ** 2 < 1 << 62:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [x if x < 1 << 63 else None for x in exact]


def _entries(m: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(m))
    return pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(m[i, j])})


def _scatter(values, dims: int):
    """Upper triangle of the sum of outer products of a task's rows; ``values(batch)`` gives rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            for z in values(b):
                total += z.T @ z
        yield _entries(total)

    return run


def _collected(vectors: DataFrame, values, dims: int) -> np.ndarray:
    """The summed matrix: ``dims * (dims + 1) / 2`` rows reach the driver."""
    out = np.zeros((dims, dims))
    for r in vectors.mapInArrow(_scatter(values, dims), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


class Fit:
    """Everything that whitening a row needs."""

    def __init__(self, centred: Centred, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.centred, self.values, self.trace = centred, values, trace
        # below this a variance is rounding
        self.live = values > 64 * np.finfo(float).eps * centred.dims * max(values.max(initial=0), np.finfo(float).tiny)
        self.matrix = vectors[:, self.live] / np.sqrt(values[self.live])
        self.error: float | None = None


def fit(vectors: DataFrame, k: int = COMPONENTS, vector_col: str = "embedding") -> Fit | None:
    """Sums, covariance, components and the check of the whitened covariance; None without vectors."""
    only = vectors.select(vector_col)
    sums = only.mapInArrow(_sums, "dims int, i int, n long, s string").groupBy("dims", "i") \
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    # one row: the sums of the most frequent length
    kept = sums.groupBy("dims").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("sums")) \
        .orderBy(F.desc("n"), F.desc("dims")).first()
    if kept is None:
        return None
    centred = Centred(kept["n"], [int(x["s"]) for x in kept["sums"]])
    n, dims = centred.n, centred.dims
    covariance = _collected(only, lambda b: (z for _, _, z in centred.rows(b.column(0))), dims) / n
    e, u = components(covariance, k)
    out = Fit(centred, e, u, float(np.trace(covariance)))
    live = int(out.live.sum())
    if live:
        m = out.matrix
        white = _collected(only, lambda b: (z @ m for _, _, z in centred.rows(b.column(0))), live) / n
        out.error = float(np.abs(white - np.eye(live)).max())
    return out


def whiten(vectors: DataFrame, model: Fit | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every kept row and component: (id, component, n, deviation, whitened, explained, identity_error)."""
    schema = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType())]
                          + [T.StructField(c, t) for c, t in (("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
                                                              ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))])
    if model is None:
        return vectors.select(F.col(id_col)).limit(0).select(id_col, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]])
    k, share = len(model.values), [float(e) / model.trace if model.trace > 0 else None for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, y, z in model.centred.rows(b.column(1)):
                m = len(rows)
                white = np.full((m, k), np.nan)
                white[:, model.live] = z @ model.matrix
                dead = np.broadcast_to(~model.live, (m, k)).ravel()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.centred.n)), pa.array(model.centred.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(white.ravel(), mask=dead), pa.array(share * m, pa.float64()), pa.array([model.error] * (m * k), pa.float64())],
                    names=schema.fieldNames())

    return vectors.select(id_col, vector_col).mapInArrow(run, schema)
