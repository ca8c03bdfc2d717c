"""Embedding whitening by Chebyshev-filtered subspace iteration (Zhou and Saad, 2007).

The covariance matrix V is never formed. A block of vectors Q is multiplied by it in passes over the rows: each task adds up
X'(XQ) of its centred rows, and Spark adds up the tasks. A round is a Chebyshev polynomial in V, by its three-term recurrence
(a pass a degree), small on the interval that holds the unwanted spectrum and large above, then QR and Rayleigh-Ritz. The interval ends
at the smallest Ritz value of the block, and begins at a bound from a few Lanczos steps; a wrong interval costs rounds, not
correctness. A fit is certified when the residuals |Vq - eq| of the wanted pairs are at rounding level, and a further
round, in which fresh random vectors have taken the place of the guard vectors, finds the same eigenvalues: a direction
that the first start had missed would come up there. Only d x block numbers ever reach the driver.

Entries become whole numbers, x = floor(64 c) + 1000000. Each distinct x vector counts once in the fit. Rows are centred as
(n x - S) / n, whose numerator is exact, before anything is multiplied.

Rows whose vector is null, or holds a null or non-finite entry, or one of 2**40 and more, are dropped; empty vectors too. Vectors shorter than the
longest count as ending in zeros. A null id stays as it is, and repeated rows are all answered. Directions without variance
(e below 1e-12 of the largest) are no components: a table of one distinct vector, or an empty one, gives no component. `deviation`
is null where it exceeds 64 bits. Only the key and the vector are read, so further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
DEGREE = 8
LANCZOS_STEPS = 10
MAX_ROUNDS = 100
RESIDUAL = 2e-14  # of the largest eigenvalue, times the root of the dimension
NO_VARIANCE = 1e-12


def whole(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry, the entry taken as double; null if the row is to be dropped."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= 2.0**40))
    fit = ~F.coalesce(bad, F.lit(True)) & (F.size(x) > 0)
    return F.when(fit, F.transform(x, lambda v: F.floor(v * SCALE).cast("long") + SHIFT))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Model:
    """The fitted components; `vectors` has one in each column."""

    width: int
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    rounds: int = 0
    passes: int = 0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n) @ self.vectors / np.sqrt(self.values)


class Passes:
    """Sums over the rows of the fit list: each task adds up its own, Spark adds up the tasks by position."""

    def __init__(self, fit: DataFrame, width: int):
        self.fit, self.width, self.count = fit, width, 0
        self.n, self.sums = fit.agg(F.count(F.lit(1))).first()[0], np.zeros(width, np.int64)
        self.sums = self.total(lambda x, _: x.sum(axis=0), width, "long")

    def total(self, part: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
        """The sum of part(x, centred x) over all batches; it gives `size` numbers."""
        width, n, sums = self.width, self.n, self.sums
        dtype = np.int64 if kind == "long" else np.float64

        def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size, dtype)
            for batch in stream:
                if batch.num_rows:
                    x = _matrix(batch.column(0), width)
                    out += part(x, (n * x - sums) / n).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], ["at", "value"])

        self.count += 1
        rows = self.fit.mapInArrow(task, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(size, dtype)
        for r in rows:
            out[r["at"]] = r["value"]
        return out

    def product(self, q: np.ndarray) -> np.ndarray:
        """V Q."""
        return self.total(lambda x, c: c.T @ (c @ q), q.size).reshape(q.shape) / self.n


def lower_bound(passes: Passes, start: np.ndarray) -> float:
    """A likely lower bound of V's spectrum: the least Ritz value of a few Lanczos steps less the last remainder."""
    q, before, beta = start / np.linalg.norm(start), np.zeros_like(start), 0.0
    alphas, betas = [], []
    for _ in range(min(LANCZOS_STEPS, len(start))):
        w = passes.product(q[:, None])[:, 0] - beta * before
        alphas.append(float(w @ q))
        w -= alphas[-1] * q
        before, beta = q, float(np.linalg.norm(w))
        betas.append(beta)
        if beta <= 1e-12 * max(map(abs, alphas)):
            break
        q = w / beta
    ritz, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    return max(0.0, float(ritz[0] - betas[-1] * abs(vectors[-1, 0])))


def filtered(passes: Passes, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V that is small on [low, high], times Q; scaled to 1 at `top`."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - centre)
    now = (passes.product(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        q, now = now, (passes.product(now) - centre * now) * (2 * after / half) - sigma * after * q
        sigma = after
    return now


def ritz(passes: Passes, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling), vectors and residuals of V within the span of Q."""
    q, _ = np.linalg.qr(q)
    product = passes.product(q)
    small = q.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q = q @ turn
    return values, q, np.linalg.norm(product @ turn - q * values, axis=0)


def subspace(passes: Passes, components: int, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray, int]:
    """The largest eigenpairs of V and the rounds it took."""
    d = passes.width
    wanted = min(components, d)
    block = min(d, 3 * components)
    rng = np.random.default_rng(11)
    values, q, residual = ritz(passes, rng.standard_normal((d, block)))
    low = lower_bound(passes, rng.standard_normal(d)) if block < d else 0.0
    proven: np.ndarray | None = None
    rounds, best = 0, np.inf
    stuck = 0
    while True:
        error = float(residual[:wanted].max())
        stuck = 0 if error < best / 2 else stuck + 1
        best = min(best, error)
        # at rounding level, or no longer falling there
        done = error <= RESIDUAL * np.sqrt(d) * values[0] or (stuck >= 3 and error <= 1e-11 * values[0])
        if done and (block == d or (proven is not None and np.abs(proven - values[:wanted]).max() <= 1e-12 * values[0])):
            return values[:wanted], q[:, :wanted], rounds
        if rounds >= MAX_ROUNDS:
            raise ArithmeticError(f"eigenvectors not certified after {rounds} rounds; the largest residual is {error}")
        proven = None
        if done:
            proven = values[:wanted].copy()
            q = np.hstack([q[:, :wanted], rng.standard_normal((d, block - wanted))])
        high = values[-1]
        if not low < high < values[0]:
            low = 0.0
        if block < d and 0 < high < values[0] * (1 - 1e-9):
            q = filtered(passes, q, low, high, values[0], degree)
        rounds += 1
        values, q, residual = ritz(passes, q)


def fit(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> Model | None:
    """The whitening of the distinct vectors; None if there is none."""
    x = vectors.select(whole(F.col(vector)).alias("x")).where("x is not null")
    width = x.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    passes = Passes(staged(_padded(x, width).distinct()), width)
    trace = float(passes.total(lambda x, c: (c * c).sum(), 1)[0]) / passes.n
    if trace <= 0:
        return Model(width, passes.n, passes.sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0.0)
    values, q, rounds = subspace(passes, components)
    some = values > NO_VARIANCE * values[0]
    values, q = values[some], q[:, some]
    q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
    k = len(values)

    def moments(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        w = c @ q / np.sqrt(values)
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    sums = passes.total(moments, k * k + k) / passes.n
    identity = sums[: k * k].reshape(k, k) - np.outer(sums[k * k:], sums[k * k:])
    return Model(width, passes.n, passes.sums, values, q, trace, float(np.abs(identity - np.eye(k)).max()), rounds, passes.count)


def _padded(rows: DataFrame, width: int) -> DataFrame:
    return rows.withColumn("x", F.expr(f"concat(x, array_repeat({SHIFT}L, {width} - size(x)))"))


def whiten(vectors: DataFrame, model: Model | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened): for each row that is not dropped, the exact sum of squares of n x - S, and its entries
    on the components."""
    rows = vectors.select(F.col(key).alias("id"), whole(F.col(vector)).alias("x")).where("x is not null")
    key_type = rows.schema["id"].dataType.simpleString()
    out = f"`{key}` {key_type}, deviation long, whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                x = _matrix(batch.column(1), model.width)
                deviation = model.deviations(x)
                fits = (deviation.astype(float) ** 2).sum(axis=1) < 2.0**63 * (1 - 1e-9)
                square = (np.where(fits[:, None], deviation, 0) ** 2).sum(axis=1)
                w = model.whitened(x)
                offsets = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32) if w.shape[1] else np.zeros(len(w) + 1, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(square, mask=~fits), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], [key, "deviation", "whitened"]
                )

    return _padded(rows, model.width).mapInArrow(task, out)
