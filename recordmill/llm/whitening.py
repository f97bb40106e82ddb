"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the distinct vectors is never formed. A pass over the vectors gives V·Q for a narrow
block Q: every task centres its vectors, multiplies them with Q and adds up XᵀXQ, and Spark sums the
results by dimension. A few block Krylov steps bound the unwanted spectrum [a, b]; then a polynomial of
the Chebyshev recurrence, one pass per degree, damps that interval and lets what lies above grow. QR and
a Rayleigh-Ritz step turn the block into approximate eigenvectors, and the next filter takes its bounds
from them, until the residuals certify the leading components.

What reaches the driver has the size of Q (dimensions by WIDTH), whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

#: Entries are counted in steps of 1/SCALE.
SCALE = 256
COMPONENTS = 4
#: Columns of the block: the components and guard vectors, which widen the gap to what is damped.
WIDTH = 16
#: Block Krylov steps that bound the spectrum, degree of a filter, and most filters.
STEPS, DEGREE, ROUNDS = 3, 12, 100
#: A component is certified when its residual, relative to the largest eigenvalue, is at rounding, or is
#: so small that its vector's error (residual by gap) is.
ROUNDING, VECTOR = 2e-14, 1e-13
#: Eigenvalues below this share of the largest are zero: their vectors are not determined.
ZERO = 1e-12


def whole(vector: Column) -> Column:
    """Entries as long, floor(SCALE * entry)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers. (An empty one is not null, but no row comes of it.)"""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole_sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns, also where 64 bits would not hold them."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    return [int(s) for s in (x if most * len(x) < 1 << 62 else x.astype(object)).sum(axis=0)]


@dataclass
class Centre:
    """Number of distinct vectors and the sum of each dimension."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        #: Sums as whole means and remainders, so that centring does not cancel.
        self.mean = np.array([s // self.n for s in self.sums], np.float64)
        self.rest = np.array([s % self.n for s in self.sums], np.float64) / self.n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)², exact; null where a long does not hold it."""
        sums = np.array(self.sums, object)
        bound = self.n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        fits = bound * bound * max(1, x.shape[1]) < 1 << 63
        d = (x * self.n - sums.astype(np.int64)) if fits else (x.astype(object) * self.n - sums)
        return [int(v) if int(v) < 1 << 63 else None for v in (d * d).sum(axis=1)]


@dataclass
class Components:
    """Leading components: unit columns of ``vectors``, falling ``values``, and the spectrum's sum."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def _summed(fit: DataFrame, rows: int, columns: int, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of ``block`` (vectors as a matrix to a matrix of rows by columns): each task
    sums its own, Spark sums by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for batch in batches:
            if len(batch):
                total += block(matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(total[:, j]) for j in range(columns))],
            ["i", *(f"y{j}" for j in range(columns))])

    names = [f"y{j}" for j in range(columns)]
    summed = fit.mapInArrow(run, "i int, " + ", ".join(f"{n} double" for n in names)).groupBy("i").agg(
        *(F.sum(n).alias(n) for n in names))
    out = np.zeros((rows, columns))
    for r in summed.collect():  # as many rows as Q has
        out[r["i"]] = r[1:]
    return out


def centre_of(fit: DataFrame, dimensions: int) -> Centre:
    """Exact count and sums of the vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimensions
        for batch in batches:
            n += len(batch)
            sums = [a + b for a, b in zip(sums, whole_sums(matrix(batch.column(0))), strict=True)] if len(batch) else sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array([n] * dimensions, pa.int64()),
             pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["i", "n", "s"])

    found = fit.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    return Centre(found[0]["n"] if found else 0, [int(r["s"]) for r in found])


def _basis(z: np.ndarray, scale: float) -> np.ndarray:
    """Orthonormal columns that span those of ``z``, without directions of rounding size."""
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    return u[:, s > 1e-10 * max(scale, 1e-300)]


def components(fit: DataFrame, centre: Centre, k: int = COMPONENTS, width: int = WIDTH, seed: int = 42) -> Components | None:
    """Certified leading components of the vectors in ``fit`` (one column, arrays of long of equal
    length), at most ``k``; fewer where eigenvalues are zero, None where there is no variance."""
    d = len(centre.sums)
    passes = 0

    def cov(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def block(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ q)

        return _summed(fit, d, q.shape[1], block) / centre.n

    trace = float(_summed(fit, 1, 1, lambda x: np.array([[np.square(centre.centred(x)).sum()]]))[0, 0]) / centre.n
    if not trace > 0:
        return None
    # Block Krylov steps: a lower bound of the spectrum and a first block.
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(width, d))))[0]
    basis, images = q, cov(q)
    for _ in range(STEPS - 1):
        z = images[:, -q.shape[1]:]
        for _ in range(2):
            z = z - basis @ (basis.T @ z)
        q = _basis(z, trace)[:, :d - basis.shape[1]]
        if not q.shape[1]:
            break
        basis, images = np.hstack([basis, q]), np.hstack([images, cov(q)])
    theta, u = np.linalg.eigh((lambda h: (h + h.T) / 2)(basis.T @ images))
    low = max(0.0, theta[0] - np.linalg.norm(images @ u[:, 0] - theta[0] * (basis @ u[:, 0])))
    w = min(width, basis.shape[1])
    q, y, theta = basis @ u[:, -w:], images @ u[:, -w:], theta[-w:]
    for _ in range(ROUNDS):
        # Falling order; residuals of the leading components.
        q, y, theta = q[:, ::-1], y[:, ::-1], theta[::-1]
        m = int(min(k, (theta > ZERO * theta[0]).sum()))
        residual = np.linalg.norm(y[:, :m] - q[:, :m] * theta[:m], axis=0)
        around = np.append(theta, 0.0)
        gap = np.array([min(around[i - 1] - around[i] if i else np.inf, around[i] - around[i + 1]) for i in range(m)])
        if np.all((residual <= ROUNDING * theta[0]) | (residual <= VECTOR * gap)):
            q = q[:, :m] / np.linalg.norm(q[:, :m], axis=0)
            return Components(centre, q, theta[:m], trace, passes)
        # The scaled Chebyshev recurrence on [low, high], scaled at the largest Ritz value.
        high = theta[-1] if q.shape[1] < d else 0.0
        if high <= low:  # the bound was too high, and the filter let the low end grow
            low = high / 2
        middle, half = (high + low) / 2, max((high - low) / 2, 1e-8 * theta[0])
        sigma = first = half / (theta[0] - middle)
        before, now = q, (y - middle * q) * (sigma / half)
        for _ in range(DEGREE - 1):
            nxt = 1 / (2 / first - sigma)
            before, now = now, 2 * (nxt / half) * (cov(now) - middle * now) - (sigma * nxt) * before
            sigma = nxt
        q = np.linalg.qr(now)[0]
        y = cov(q)
        theta, u = np.linalg.eigh((lambda h: (h + h.T) / 2)(q.T @ y))
        q, y = q @ u, y @ u
    raise ArithmeticError(f"components not certified after {ROUNDS} filters")


def fit_components(embeddings: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> Components | None:
    """Components of the distinct usable vectors of the most frequent length (the smaller of equally
    frequent ones). None without vectors or without variance; ties of eigenvalues get any basis."""
    sizes = embeddings.where(usable(F.col(vector))).groupBy(F.size(vector).alias("d")).count()
    most = sizes.where("d > 0").orderBy(F.desc("count"), "d").first()
    if most is None:
        return None
    rows = embeddings.where(usable(F.col(vector)) & (F.size(vector) == most["d"]))
    fit = cut_lineage(rows.select(whole(F.col(vector)).alias("x")).distinct(), "vectors")
    centre = centre_of(fit, most["d"])
    found = components(fit, centre, k)
    if found is None:
        return None
    m = len(found.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.whitened(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    sums = _summed(fit, m + 1, m, moments) / centre.n
    cov = sums[:m] - np.outer(sums[m], sums[m])
    found.identity_error = float(np.abs(cov - np.eye(m)).max())
    return found


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """For every row with a usable vector and every component: id, component (from 1, by falling
    variance), n (distinct vectors), deviation (sum of (n x - S)², null where a long does not hold it),
    whitened, explained (share of the total variance), identity_error (largest entry of the whitened
    covariance minus the identity).

    Rows with a null vector, or with null or non-finite entries, are left out; so are rows whose vector
    has another length than most. Components without variance are left out, so that an empty table, a
    single vector and equal vectors give no row. Repeated rows stay repeated but count once in the fit;
    ids may be null; other columns are ignored. Entries are exact up to 2^53 steps."""
    kind = dict(embeddings.dtypes)[id_col]
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    found = fit_components(embeddings, vector, k)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    d, m = len(found.centre.sums), len(found.values)
    explained = found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            if not rows:
                continue
            x = matrix(batch.column(1))
            again = np.repeat(np.arange(rows), m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(again)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * m, found.centre.n, np.int64)),
                 pa.array(found.centre.deviation(x), pa.int64()).take(pa.array(again)),
                 pa.array(found.whitened(x).ravel()), pa.array(np.tile(explained, rows)),
                 pa.array(np.full(rows * m, found.identity_error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = embeddings.where(usable(F.col(vector)) & (F.size(vector) == d))
    return rows.select(F.col(id_col), whole(F.col(vector)).alias("__x")).mapInArrow(run, schema)
