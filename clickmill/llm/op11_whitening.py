"""Embedding whitening by Chebyshev-filtered subspace iteration.

Rows whose vector is null or holds null or non-finite entries drop out, and so do those
whose length is not that of most rows (on a tie the greater one). Each entry c becomes the
long x = floor(scale * c) + shift. Means and covariances are those of the fit list, each
distinct vector once, divisor n, centred before multiplying.

The covariance is never formed. A pass over the fit list computes its product with a thin
block Q, the sum of Xc'(Xc Q) over record batches: a partial block of dimension x width
numbers leaves each task, and Spark sums them cell by cell. Driver and tasks hold blocks of
that size only, whatever the number of rows.

1. A few Lanczos steps bound the spectrum from below.
2. A cycle: QR of the block, one pass, Rayleigh-Ritz; then a Chebyshev polynomial of degree
   DEGREE, by its three-term recurrence of passes, damps what lies between that bound and
   the block's smallest Ritz value and lifts the rest. The block is wider than the wanted
   components, so a close neighbour of the last one does not slow it down.
3. It ends when the residual |V u - e u| of every wanted pair is certified below
   TOLERANCE times the largest eigenvalue, or no longer falls and is below ROUNDED times
   it (rounding); after CYCLES without either it raises.

Where the block spans the whole space, one pass is enough.

 - Components whose eigenvalue is not above 1e-12 of the trace cannot be scaled and are not
   returned: fewer than wanted, none if all vectors are equal.
 - Rows that repeat a vec_id, and a missing one, keep a row each. An empty table, or one
   without a usable row, gives an empty result. Columns `deviation` and `whitened` of the
   input are replaced, all others pass through.
 - deviation is exact; where it could exceed a long, ArithmeticError is raised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
DEGREE, LANCZOS, CYCLES = 6, 10, 60
TOLERANCE, ROUNDED, SMALLEST = 1e-13, 1e-10, 1e-12
#: Rows of a record batch that are multiplied at a time.
_ROWS = 8192


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, eigenvalues by falling size, eigenvectors as columns, trace, and the largest residual."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: whole numbers are taken off exactly first."""
        whole = self.sums // self.n
        return (x - whole) - (self.sums - self.n * whole) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        return ((self.n * x - self.sums) ** 2).sum(1)


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The usable rows, and their vector as column x of longs."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long") + F.lit(shift).cast("long"))
    kept = rows.where(F.col(vector).isNotNull() & good & (F.size(vector) > 0)).withColumn("x", x)
    usual = kept.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return kept.where(F.size("x") == (usual[0]["n"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64, copy=False)


def _blocks(incoming: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in incoming:
        for at in range(0, batch.num_rows, _ROWS):
            yield _matrix(batch.column("x").slice(at, _ROWS))


def _summed(fit: DataFrame, partial, kind: str = "double") -> list[tuple[int, float]]:
    """Cells that tasks compute by partial(blocks of rows), summed over tasks; a bounded number."""
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(incoming):
            one = partial(block)
            total = one if total is None else total + one
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "value"])

    cells = fit.select("x").mapInArrow(run, f"cell long, value {kind}")
    return [(r["cell"], r["value"]) for r in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()]


def _filled(cells: list[tuple[int, float]], shape: tuple[int, ...], dtype=np.float64) -> np.ndarray:
    out = np.zeros(int(np.prod(shape)), dtype)
    for cell, value in cells:
        out[cell] = value
    return out.reshape(shape)


def moments(fit: DataFrame, shift: int = SHIFT) -> tuple[int, np.ndarray, float, int]:
    """Rows of the fit list, sums by dimension, trace of the covariance, and the largest |x - shift|."""
    def partial(x: np.ndarray) -> np.ndarray:
        c = x - shift
        return np.concatenate([[len(x)], c.sum(0), (c * c).sum(0)])

    cells = dict(_summed(fit, partial, "long"))
    if not cells:
        return 0, np.zeros(0, np.int64), 0.0, 0
    n, d = cells[0], (len(cells) - 1) // 2
    first, second = [cells[1 + j] for j in range(d)], [cells[1 + d + j] for j in range(d)]
    # Whole numbers of any size: the differences lose no digit.
    trace = sum(n * b - a * a for a, b in zip(first, second)) / (n * n)
    largest = fit.select(F.max(F.greatest(F.abs(F.array_max("x") - shift), F.abs(F.array_min("x") - shift)))).first()[0]
    return n, np.array([a + n * shift for a in first], np.int64), trace, int(largest)


def chebyshev(product, block: np.ndarray, done: np.ndarray, low: float, cut: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """Block filtered by the Chebyshev polynomial that is small on [low, cut], scaled to 1 at top; done is product(block)."""
    centre, half = (cut + low) / 2, (cut - low) / 2
    first = half / (top - centre)
    sigma = first
    before, now = block, (done - centre * block) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (product(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def lower_bound(product, d: int, steps: int = LANCZOS) -> float:
    """A number below the spectrum: the smallest Ritz value of Lanczos, less the norm of its last remainder."""
    q = np.random.default_rng(5).normal(size=(d, 1))
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        w = product(basis[-1])
        alphas.append(float((basis[-1] * w).sum()))
        for _ in range(2):
            for b in basis:
                w = w - b * float((b * w).sum())
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] < 1e-10 * max(map(abs, alphas)):
            break
        basis.append(w / betas[-1])
    t = np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1) + np.diag(betas[:len(alphas) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1]) * (1 - 1e-9)


def leading_pairs(product, d: int, k: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues, their vectors and the largest residual, from products with d x m blocks."""
    width = min(d, max(2 * k, k + 8))
    block = np.eye(d) if width == d else np.linalg.qr(np.random.default_rng(17).normal(size=(d, width)))[0]
    low, last = None, np.inf
    for _ in range(CYCLES):
        done = product(block)
        small = block.T @ done
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, done = block @ turn, done @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(done[:, :k] - block[:, :k] * values[:k], axis=0).max())
        if width == d or top == 0 or residual <= tolerance * top or last / 2 <= residual <= ROUNDED * top:
            return values[:k], block[:, :k], residual
        last = residual
        if low is None:
            low = lower_bound(product, d)
        cut = max(float(values[-1]), low + 1e-6 * top)
        block = np.linalg.qr(chebyshev(product, block, done, low, cut, top))[0]
    raise RuntimeError(f"residual {residual} of {top} after {CYCLES} cycles")


def fit(vectors: DataFrame, k: int = COMPONENTS, shift: int = SHIFT) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the distinct vectors in column x, and these as a written table; None without a row."""
    unique = settle(vectors.select("x").distinct(), "vectors")
    n, sums, trace, largest = moments(unique, shift)
    if not n:
        return None
    d = len(sums)
    if d * (2 * largest * n) ** 2 >= 2**63:
        raise ArithmeticError("deviations exceed a long")
    plain = Whitening(n, sums, np.ones(d), np.eye(d), trace, 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            c = plain.centred(x)
            return c.T @ (c @ block)

        return _filled(_summed(unique, partial), block.shape) / n

    values, vectors_, residual = leading_pairs(product, d, min(k, d))
    good = values > SMALLEST * trace
    return Whitening(n, sums, values[good], vectors_[:, good], trace, residual), unique


def identity_error(unique: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    m = len(model.values)
    if not m:
        return 0.0

    def partial(x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    cells = _filled(_summed(unique, partial), (m + m * m,)) / model.n
    mean = cells[:m]
    return float(np.abs(cells[m:].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows with column x: their deviation (long) and whitened (array of doubles) in its place."""
    kept = rows.drop("deviation", "whitened")
    names = [c for c in kept.columns if c != "x"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "x")

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                x = _matrix(part.column("x"))
                w = model.project(x)
                offsets = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(model.deviations(x)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))], [*names, "deviation", "whitened"])

    return kept.select(*names, "x").mapInArrow(run, f"{types}{', ' if types else ''}deviation long, whitened array<double>")


def whitened_rows(rows: DataFrame, k: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable row and component."""
    usable = integer_vectors(rows.select("vec_id", vector), vector).select("vec_id", "x")
    found = fit(usable, k)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if found is None:
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    model, unique = found
    error = identity_error(unique, model)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return transform(usable, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, "place").alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(table(spark, sf_dir, "embeddings"))
