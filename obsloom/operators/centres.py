"""K-means for many numbers of clusters and restarts at once, and silhouettes from cluster statistics.

Every pass over the rows serves all fits that have not settled yet: a task measures its rows against the centres of
all of them and hands on, for each centre, how many rows it has and their sums. So the passes do not grow with the
fits, and what reaches the driver is a few numbers per centre, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows from which starting centres are drawn, at most, chosen by hash; numbers in one block of distances.
STARTS, BLOCK = 4096, 1 << 21
TOLERANCE = 1e-4
POINT = "x"


@dataclass
class Fit:
    """Centres (k, dimensions) of one fit, and the rows' squared distances to them in all."""

    k: int
    centres: np.ndarray
    cost: float = float("inf")
    settled: bool = False


def points_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(POINT).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (point, centre)."""
    apart = (points**2).sum(axis=1)[:, None] - 2.0 * points @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.maximum(apart, 0.0)


def starting_rows(points: DataFrame, seed: int) -> np.ndarray:
    """Up to ``STARTS`` rows with the smallest hashes: the same rows however the table is partitioned."""
    chosen = points.select(POINT).orderBy(F.xxhash64(POINT, F.lit(seed)), POINT).limit(STARTS).toArrow()
    return np.array(chosen.column(POINT).to_pylist(), dtype=float)


def spread_out(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the rows, each drawn with a chance that grows with its squared distance to those drawn before."""
    chance = np.random.default_rng(seed)
    centres = [rows[chance.integers(len(rows))]]
    nearest = np.full(len(rows), np.inf)
    while len(centres) < k:
        nearest = np.minimum(nearest, ((rows - centres[-1]) ** 2).sum(axis=1))
        total = nearest.sum()
        at = chance.choice(len(rows), p=nearest / total) if total > 0 else chance.integers(len(rows))
        centres.append(rows[at])
    return np.array(centres)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, columns: int) -> Iterator[np.ndarray]:
    rows = max(1, BLOCK // max(1, columns))
    for batch in batches:
        points = points_of(batch, width)
        for start in range(0, len(points), rows):
            yield points[start : start + rows]


def _gathered(points: DataFrame, tables: list[np.ndarray]) -> list[np.ndarray]:
    """For each table of centres, an array (centre, n, cost, squared norms, sums of every dimension) over all rows."""
    if not tables:
        return []
    width = tables[0].shape[1]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
    shared = points.sparkSession.sparkContext.broadcast(np.concatenate(tables))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        found = np.zeros((len(centres), 3 + width))
        for block in _blocks(batches, width, len(centres)):
            apart = distances(block, centres)
            norms = (block**2).sum(axis=1)
            for a, b in zip(bounds, bounds[1:]):
                nearest = apart[:, a:b].argmin(axis=1)
                member = np.zeros((len(block), b - a))
                member[np.arange(len(block)), nearest] = 1.0
                own = apart[:, a:b][np.arange(len(block)), nearest]
                found[a:b] += member.T @ np.column_stack([np.ones(len(block)), own, norms, block])
        used = np.flatnonzero(found[:, 0])
        columns = [pa.array(used), pa.array(list(found[used]), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["centre", "sums"])

    rows = points.select(POINT).mapInArrow(gather, "centre long, sums array<double>")
    summed = rows.groupBy("centre").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(3 + width)]).toArrow()
    total = np.zeros((int(bounds[-1]), 3 + width))
    total[summed.column("centre").to_numpy()] = np.column_stack([summed.column(f"s{i}").to_numpy() for i in range(3 + width)])
    shared.unpersist()
    return [total[a:b] for a, b in zip(bounds, bounds[1:])]


def fit_all(points: DataFrame, ks: Sequence[int], restarts: int = 1, seed: int = 42, max_iter: int = 20) -> list[Fit]:
    """The cheapest of ``restarts`` fits for each k, over the rows of ``points``, whose column ``x`` is an array.

    At most ``max_iter`` + 1 passes over the rows, for all fits together. A centre that loses all its rows stays.
    """
    rows = starting_rows(points, seed)
    if len(rows) < max(ks):
        raise ValueError(f"{len(rows)} rows cannot make {max(ks)} clusters")
    fits = [Fit(k, spread_out(rows, k, seed + i)) for k in ks for i in range(restarts)]
    for _ in range(max_iter):
        moving = [f for f in fits if not f.settled]
        if not moving:
            break
        for fit, sums in zip(moving, _gathered(points, [f.centres for f in moving])):
            n = sums[:, :1]
            centres = np.where(n > 0, sums[:, 3:] / np.maximum(n, 1.0), fit.centres)
            fit.settled = bool(((centres - fit.centres) ** 2).sum(axis=1).max() <= TOLERANCE**2)
            fit.centres = centres
    for fit, sums in zip(fits, _gathered(points, [f.centres for f in fits])):
        fit.cost = float(sums[:, 1].sum())
    return [min((f for f in fits if f.k == k), key=lambda f: f.cost) for k in ks]


def silhouettes(points: DataFrame, fits: Sequence[Fit]) -> list[float]:
    """The mean silhouette of each fit by squared distance, all in two passes over the rows."""
    if not fits:
        return []
    centres = [f.centres for f in fits]
    width = centres[0].shape[1]
    stats = _gathered(points, centres)
    shared = points.sparkSession.sparkContext.broadcast((centres, stats))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, stats = shared.value
        total, n = np.zeros(len(centres)), 0
        for block in _blocks(batches, width, max(len(c) for c in centres)):
            n += len(block)
            for i, (centre, stat) in enumerate(zip(centres, stats)):
                total[i] += worth(block, distances(block, centre).argmin(axis=1), stat[:, 0], stat[:, 2], stat[:, 3:]).sum()
        columns = [pa.array(range(len(centres)), pa.int64()), pa.array(total), pa.array([n] * len(centres), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["fit", "total", "n"])

    rows = points.select(POINT).mapInArrow(judge, "fit long, total double, n long")
    found = {r["fit"]: r["worth"] for r in rows.groupBy("fit").agg((F.sum("total") / F.sum("n")).alias("worth")).collect()}
    shared.unpersist()
    return [found[i] for i in range(len(fits))]


def worth(points: np.ndarray, own: np.ndarray, n: np.ndarray, norms: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Silhouette of each point from the clusters' sizes, sums of squared norms and sums; 0 alone in a cluster.

    The mean squared distance from a point to the rows of a cluster follows from these.
    """
    present = n > 0
    size = np.maximum(n, 1.0)
    mean = (norms / size)[None, :] + (points**2).sum(axis=1)[:, None] - 2.0 * points @ (sums / size[:, None]).T
    at = np.arange(len(points))
    inside = np.maximum(mean[at, own], 0.0) * n[own] / np.maximum(n[own] - 1, 1)
    mean = np.where(present[None, :], mean, np.inf)
    mean[at, own] = np.inf
    outside = np.maximum(mean.min(axis=1), 0.0)
    larger = np.maximum(inside, outside)
    usable = (n[own] > 1) & (larger > 0) & np.isfinite(larger)
    return np.where(usable, (outside - inside) / np.where(usable, larger, 1.0), 0.0)


def assigned(df: DataFrame, vector, centres: np.ndarray, out: str) -> DataFrame:
    """``df`` with the number of the nearest of a few centres, by built-in functions; NULL where ``vector`` is."""
    apart = [
        F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
        for c in centres
    ]
    measured = F.array(*apart)
    nearest = (F.array_position(measured, F.array_min(measured)) - 1).cast("int")
    return df.withColumn(out, F.when(vector.isNotNull(), nearest))


