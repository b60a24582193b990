"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000. The fit list holds each distinct vector once; its sums are
exact. The leading eigenvectors of its covariance V are found without forming V: a pass over the fit list gives
V Q = Xc' (Xc Q) / n for a narrow Q, where each task centres its rows, multiplies and sums, and only one
matrix of Q's size a task is shuffled and added. Passes form a Chebyshev recurrence that is small on the unwanted
interval and grows outside it; then Q is made orthonormal (QR) and rotated to Ritz vectors (Rayleigh-Ritz). The
block holds two guard vectors for each wanted one, so what converges is parted by the eigenvalue behind the guards,
and an eigenvector that is still missing shows among them. The interval begins at a lower bound of the spectrum
from a few Lanczos steps and ends at the block's smallest Ritz value.

The loop ends when the wanted vectors are certified: residuals |V u - e u| at rounding level, no longer falling, and
one more pass whose whitened covariance is the identity. If that is not reached in ``PASSES`` passes it fails;
it never returns uncertified vectors. The driver holds matrices of dimension x block only.

Defined results: rows whose vector is null, empty, or holds a null, non-finite or greater entry than 1e17 (x would
not fit a long) are dropped; of vectors of several lengths the commonest length takes part (ties: the longer).
Repeated rows are all returned and fitted once; a null ``vec_id`` stays null. Components of no
variance are not returned, so a table of equal vectors (or an empty one) returns no rows. A deviation that does not
fit a long is null. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder

COMPONENTS = 16
GUARDS = 2                  # guard vectors for each wanted one
LANCZOS = 8                 # steps for the lower bound of the spectrum
DEGREE = 10                 # of a filter, at most
GROWTH = 1e10               # of the first vector over the unwanted ones in one filter, at most
SETTLED = 1e-12             # of the first eigenvalue: residuals below may stop as soon as they no longer fall
PASSES = 600
NO_VARIANCE = 1e-12         # of the trace
CLOSE = 1e-4                # largest entry of the whitened covariance minus the identity
VALUES_AT_ONCE = 1 << 20


def whole(rows: DataFrame) -> DataFrame:
    """``vec_id, x``: the rows that remain, as whole numbers."""
    v = F.col("embedding").cast("array<double>")
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= 1e17))
    return (rows.filter(F.coalesce((F.size(v) > 0) & fits, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(v, lambda c: F.floor(c * 64).cast("long") + F.lit(1000000).cast("long")).alias("x")))


def _pieces(column: pa.Array, dim: int):
    """Rows of whole numbers, some at a time."""
    step = max(1, VALUES_AT_ONCE // dim)
    for at in range(0, len(column), step):
        yield column.slice(at, step).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(dim: int):
    def run(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            for x in _pieces(batch.column(0), dim):
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])
    return run


class Fit:
    """The fit list: rows, sums, and products with its covariance."""

    def __init__(self, x: DataFrame, dim: int):
        self.x, self.dim, self.passes = x, dim, 0
        parts = (x.mapInArrow(_sums(dim), "i int, n long, high long, low long").groupBy("i")
                 .agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect())
        self.n = int(parts[0]["n"]) if parts else 0
        self.sums = [0] * dim
        for r in parts:
            self.sums[r["i"]] = (int(r["high"]) << 32) + int(r["low"])
        if self.n:
            self.base = np.array([s // self.n for s in self.sums], dtype=np.int64)
            self.part = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.part

    def product(self, q: np.ndarray) -> np.ndarray:
        """V q, one pass over the rows; the trace of V is kept."""
        dim, base, part = self.dim, self.base, self.part

        def run(batches):
            total, squares = np.zeros(q.shape), 0.0
            for batch in batches:
                for x in _pieces(batch.column(0), dim):
                    y = (x - base).astype(np.float64) - part
                    total += y.T @ (y @ q)
                    squares += float(np.einsum("ij,ij->", y, y))
            if squares:
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, q.size), pa.int32()), pa.array(np.append(squares, total))],
                                                 names=["cell", "part"])

        self.passes += 1
        if self.passes > PASSES:
            raise RuntimeError(f"not certified after {PASSES} passes")
        cells = np.zeros(q.size + 1)
        for r in self.x.mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("total")).collect():
            cells[r["cell"] + 1] = r["total"]
        self.trace = cells[0] / self.n
        return cells[1:].reshape(q.shape) / self.n


def lower_bound(fit: Fit, rng) -> float:
    """A number below which V has no eigenvalue, but for the bound of the last Lanczos residual; 0 at least."""
    q = rng.standard_normal(fit.dim)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS, fit.dim)):
        w = fit.product(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            for b in basis:
                w = w - (w @ b) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-10 * fit.trace:
            break
        basis.append(w / beta[-1])
    off = beta[:len(alpha) - 1]
    least = np.linalg.eigvalsh(np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1))[0]
    return max(0.0, float(least) - beta[-1])


def filtered(fit: Fit, u: np.ndarray, vu: np.ndarray, top: float, low: float, high: float) -> np.ndarray:
    """A Chebyshev polynomial of V times ``u``: small on [low, high], 1 at ``top``. ``vu`` is V u."""
    centre, half = (high + low) / 2, (high - low) / 2
    first = half / (top - centre)
    degree = int(max(1, min(DEGREE, math.log(2 * GROWTH) / math.acosh(max(1 / first, 1 + 1e-12)))))
    ratio, before, now = first, u, (vu - centre * u) * (first / half)
    for _ in range(degree - 1):
        then = 1 / (2 / first - ratio)
        before, now = now, (fit.product(now) - centre * now) * (2 * then / half) - ratio * then * before
        ratio = then
    return now


def eigenvectors(fit: Fit, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues and unit eigenvectors (columns), certified."""
    rng = np.random.default_rng(13)
    low = lower_bound(fit, rng)
    block = min(fit.dim, (1 + GUARDS) * wanted)
    q, _ = np.linalg.qr(rng.standard_normal((fit.dim, block)))
    last = math.inf
    while True:
        vq = fit.product(q)
        h = q.T @ vq
        values, w = np.linalg.eigh((h + h.T) / 2)
        values, w = values[::-1], w[:, ::-1]
        u, vu = q @ w, vq @ w
        if values[0] <= 0:
            return values[:0], u[:, :0]
        rest = float(np.linalg.norm(vu - u * values, axis=0)[:wanted].max())
        if rest <= SETTLED * values[0] and rest > last / 2 or rest <= 1e-15 * values[0]:
            there = values[:wanted] > NO_VARIANCE * fit.trace
            return values[:wanted][there], u[:, :wanted][:, there]
        last = rest
        # a block that covers every direction leaves nothing unwanted: only rounding is filtered
        high = max(float(values[-1]), low + 1e-9 * float(values[0]))
        q, _ = np.linalg.qr(filtered(fit, u, vu, max(float(values[0]), high * (1 + 1e-9)), low, high))


COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def deviations(x: np.ndarray, n: int, base: np.ndarray, rest: list[int]) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S)^2, where S = n base + rest."""
    near = x - base
    most = n * max(abs(int(near.min())), abs(int(near.max()))) + n
    if most * most * x.shape[1] < 1 << 63:
        d = n * near - np.array(rest, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    found = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in near.tolist()]
    return [d if d < 1 << 63 else None for d in found]


def whiten(rows: DataFrame, wanted: int = COMPONENTS, root: str | None = None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every remaining row and component."""
    spark = rows.sparkSession
    root = root or work_folder(spark, "whitening")
    x = whole(rows)
    size = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if size is None:
        return spark.createDataFrame([], COLUMNS)
    dim = int(size["dim"])
    x = x.filter(F.size("x") == dim)
    fit = Fit(cut(x.select("x").distinct(), root, "fit"), dim)
    values, u = eigenvectors(fit, wanted)
    if not len(values):
        return spark.createDataFrame([], COLUMNS)
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    error = float(np.abs(u.T @ fit.product(u) / np.sqrt(np.outer(values, values)) - np.eye(len(values))).max())
    if error > CLOSE:
        raise RuntimeError(f"the whitened covariance is off the identity by {error}")
    n, base, part = fit.n, fit.base, fit.part
    rest = [s % n for s in fit.sums]
    k, shares, onto = len(values), values / fit.trace, u / np.sqrt(values)

    def project(batches):
        for batch in batches:
            at = 0
            for some in _pieces(batch.column(1), dim):
                m = len(some)
                ids = batch.column(0).slice(at, m)
                at += m
                repeated = np.repeat(np.arange(m), k)
                whitened = ((some - base).astype(np.float64) - part) @ onto
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(repeated)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)),
                     pa.array(deviations(some, n, base, rest), pa.int64()).take(pa.array(repeated)),
                     pa.array(whitened.reshape(-1)), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    names=[c.split()[0] for c in COLUMNS.split(", ")])
    return x.mapInArrow(project, COLUMNS)
