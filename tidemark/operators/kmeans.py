"""K-means with restarts: every start of every k shares each pass over the rows.

The centres of all running starts are one small table; a task finds each row's nearest centre of each start by one
product, and sends a row of sums per centre. So the number of jobs is that of the longest start, not of all
starts together. Starts whose centres have come to rest leave the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import offers as dims

# the first centres are drawn from at most so many rows (by a hash of the vector); every pass reads all rows
SEED_ROWS = 20_000
TOLERANCE = 1e-4  # squared movement of a start's centres, in mean variances of the columns


@dataclass(frozen=True)
class KChoice:
    """The best start of one k."""

    k: int
    inertia: float
    silhouette: float
    centres: np.ndarray


@dataclass
class _Sums:
    """Per centre: rows, coordinates, squared lengths, and squared distances to it."""

    n: np.ndarray
    x: np.ndarray
    squares: np.ndarray
    cost: np.ndarray


def _points(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _pass(vectors: DataFrame, runs: Sequence[np.ndarray]) -> list[_Sums]:
    """One pass: sums over the rows that are nearest to each centre of each run."""
    width = runs[0].shape[1]
    centres = np.vstack(runs)
    edges = np.cumsum([0, *[len(r) for r in runs]])
    lengths = (centres**2).sum(axis=1)

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(centres), 3 + width))
        for batch in stream:
            for at in range(0, batch.num_rows, 4096):
                x = _points(batch.column(0).slice(at, 4096), width)
                square = (x**2).sum(axis=1)
                gaps = lengths - 2 * (x @ centres.T)
                for a, b in zip(edges, edges[1:]):
                    nearest = gaps[:, a:b].argmin(axis=1)
                    mine = np.zeros((len(x), b - a))
                    mine[np.arange(len(x)), nearest] = 1.0
                    gap = np.maximum(gaps[np.arange(len(x)), a + nearest] + square, 0)
                    out[a:b] += mine.T @ np.hstack([np.ones((len(x), 1)), square[:, None], gap[:, None], x])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), *[pa.array(c.copy()) for c in out.T]], names)

    names = ["centre", "n", "squares", "cost", *[f"x{j}" for j in range(width)]]
    schema = ", ".join(f"{n} {'long' if n == 'centre' else 'double'}" for n in names)
    totals = np.zeros((len(centres), 3 + width))
    for r in vectors.select("vector").mapInArrow(task, schema).groupBy("centre").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect():
        totals[r["centre"]] = [r[n] for n in names[1:]]
    return [_Sums(t[:, 0], t[:, 3:], t[:, 1], t[:, 2]) for t in (totals[a:b] for a, b in zip(edges, edges[1:]))]


def _first_centres(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre is drawn by its squared distance to those there are."""
    chosen = [sample[draw.integers(len(sample))]]
    gap = ((sample - chosen[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        share = gap / gap.sum() if gap.sum() > 0 else None
        chosen.append(sample[draw.choice(len(sample), p=share)])
        gap = np.minimum(gap, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def fit(vectors: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = 42, max_iter: int = 300) -> dict[int, np.ndarray]:
    """The centres of the best start of each k. A centre that no row is nearest to stays where it is."""
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64("vector")).select("vector").limit(SEED_ROWS).collect()])
    if not len(sample):
        raise ValueError("no rows to cluster")
    still = TOLERANCE * float(sample.var(axis=0).mean())
    centres = {(k, i): _first_centres(sample, k, np.random.default_rng([seed, k, i])) for k in ks for i in range(restarts)}
    running = list(centres)
    for _ in range(max_iter):
        if not running:
            break
        moving = []
        for run, sums in zip(running, _pass(vectors, [centres[r] for r in running])):
            moved = np.where(sums.n[:, None] > 0, sums.x / np.maximum(sums.n, 1)[:, None], centres[run])
            shift = float(((moved - centres[run]) ** 2).sum())
            centres[run] = moved
            if shift > still:
                moving.append(run)
        running = moving
    runs = list(centres)
    cost = {run: float(s.cost.sum()) for run, s in zip(runs, _pass(vectors, [centres[r] for r in runs]))}
    return {k: centres[min((r for r in runs if r[0] == k), key=lambda r: (cost[r], r))] for k in ks}


def try_k(vectors: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = 42) -> list[KChoice]:
    """Inertia and mean silhouette (by squared distances) of each k's best start, over all rows."""
    best = fit(vectors, ks, restarts, seed)
    sums = dict(zip(ks, _pass(vectors, [best[k] for k in ks])))
    scores = _silhouettes(vectors, [best[k] for k in ks], [sums[k] for k in ks])
    return [KChoice(k, float(sums[k].cost.sum()), s, best[k]) for k, s in zip(ks, scores)]


def _silhouettes(vectors: DataFrame, runs: Sequence[np.ndarray], sums: Sequence[_Sums]) -> list[float]:
    """The mean squared distance of a row to a cluster follows from the cluster's sums, so one pass is enough."""
    width = runs[0].shape[1]

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = np.zeros(len(runs)), 0
        for batch in stream:
            x = _points(batch.column(0), width)
            square = (x**2).sum(axis=1)
            rows += len(x)
            for i, (centres, s) in enumerate(zip(runs, sums)):
                own = ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
                held = np.maximum(s.n, 1)
                mean = square[:, None] + s.squares / held - 2 * (x @ (s.x / held[:, None]).T)
                at = np.arange(len(x))
                inside = mean[at, own] * held[own] / np.maximum(held[own] - 1, 1)
                mean[at, own] = np.inf
                mean[:, s.n == 0] = np.inf
                other = mean.min(axis=1)
                most = np.maximum(inside, other)
                fits = (held[own] > 1) & (most > 0) & np.isfinite(other)
                out[i] += ((other - inside) / np.where(fits, most, 1.0))[fits].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(runs))), pa.array(out), pa.array(np.full(len(runs), rows))], ["run", "total", "n"])

    found = vectors.select("vector").mapInArrow(task, "run long, total double, n long").groupBy("run").agg(
        (F.sum("total") / F.sum("n")).alias("s")
    ).collect()
    by_run = {r["run"]: float(r["s"] or 0.0) for r in found}
    return [by_run[i] for i in range(len(runs))]


def best_k(tried: Sequence[KChoice]) -> KChoice:
    """Highest silhouette, the smaller k on a tie."""
    return max(tried, key=lambda c: (c.silhouette, -c.k))


def elbow_table(tried: Sequence[KChoice], vectors: DataFrame) -> DataFrame:
    rows = [(c.k, c.inertia, c.silhouette) for c in tried]
    return dims.literal_table(vectors.sparkSession, rows, "k int, inertia double, silhouette double")


def gaps(vector: Column, centres: np.ndarray) -> list[Column]:
    """The squared distance of an array column to each centre."""
    return [sum(((vector[j] - float(v)) * (vector[j] - float(v)) for j, v in enumerate(c)), F.lit(0.0)) for c in centres]


def nearest(vector: Column, centres: np.ndarray) -> Column:
    """The number of the closest centre, the smaller one on a tie; centres are literals of the plan."""
    return F.array_min(F.array(*[
        F.struct(gap.alias("gap"), F.lit(i).alias("id")) for i, gap in enumerate(gaps(vector, centres))
    ]))["id"]
