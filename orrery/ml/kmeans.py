"""k-means of several restarts at once on blocks of rows: M9 for tables that one pass a restart and step takes too long over.

Method and parameters are Spark ML's: k-means|| (a random row, then rounds
that draw rows in proportion to their cost, 2 k expected; the candidates,
weighted by the rows nearest to them, are reduced by k-means++), then Lloyd
steps until no center moves by more than ``tol``.  All restarts share the
passes; equal rows of a block are one row with their number.  Random numbers
are numpy's, by restart and block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .blocks import blocks_in, description, merged, placed

#: Rows of a block: they are compared with all centers at a time, and 8 bytes a feature go through a task's memory.
BLOCK_ROWS = 16_384


@dataclass
class Points:
    place: tuple[int, int]
    x: np.ndarray
    rows: np.ndarray


def make_points(_: np.ndarray, x: np.ndarray) -> Points:
    x = np.ascontiguousarray(x, dtype=float)
    where, rows = merged(x.view(np.uint8).reshape(len(x), -1), np.zeros(len(x)))
    return Points((0, 0), x[where], rows.astype(float))


def points_of(df: DataFrame, slots: int, features_col: str = "features") -> RDD:
    rows = df.select(F.lit(0.0).alias("label"), vector_to_array(F.col(features_col)).alias("x"))
    block_rows = BLOCK_ROWS
    return placed(rows.mapInArrow(lambda batches: blocks_in(batches, make_points, block_rows), "block binary"), slots)


def costs(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centers)."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1), 0.0)


def nearest(x: np.ndarray, centers: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each restart the place and the cost of each row's nearest center."""
    found, at = costs(x, np.vstack(centers)), 0
    out = []
    for own in centers:
        part = found[:, at:at + len(own)]
        best = part.argmin(axis=1)
        out.append((best, part[np.arange(len(x)), best]))
        at += len(own)
    return out


def lloyd_pass(blocks: Iterable[Points], centers: list[np.ndarray]) -> Iterator[list[tuple[np.ndarray, np.ndarray, float]]]:
    """For each restart (sums by center, rows by center, cost)."""
    whole = [(np.zeros_like(c), np.zeros(len(c)), np.zeros(1)) for c in centers]
    for block in blocks:
        for (best, cost), (sums, counts, total) in zip(nearest(block.x, centers), whole, strict=True):
            weight = np.zeros((len(counts), len(best)))
            weight[best, np.arange(len(best))] = block.rows
            sums += weight @ block.x
            counts += np.bincount(best, block.rows, len(counts))
            total += (cost * block.rows).sum()
    yield whole


def drawn_rows(blocks: Iterable[Points], centers: list[np.ndarray], totals: list[float], k: int, seeds: list[int], step: int) -> Iterator[tuple[int, np.ndarray]]:
    """(restart, row) of the rows drawn in a round of k-means||."""
    for block in blocks:
        for r, (_, cost) in enumerate(nearest(block.x, centers)):
            share = np.minimum(2.0 * k * cost / totals[r], 1.0) if totals[r] > 0 else np.zeros(len(cost))
            draw = np.random.default_rng([seeds[r], step, *block.place]).random(len(cost))
            for i in np.flatnonzero(draw < 1 - (1 - share) ** block.rows):
                yield r, block.x[i]


def first_rows(blocks: Iterable[Points], wanted: dict[tuple[int, int], list[tuple[int, float]]]) -> Iterator[tuple[int, np.ndarray]]:
    for block in blocks:
        for r, share in wanted.get(block.place, []):
            reach = np.cumsum(block.rows)
            yield r, block.x[min(int(np.searchsorted(reach, share * reach[-1], side="right")), len(reach) - 1)]


def reduced(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, steps: int = 30) -> np.ndarray:
    """k-means++ and Lloyd steps on weighted candidates (as Spark's LocalKMeans)."""
    distinct, group = np.unique(candidates, axis=0, return_inverse=True)
    weights = np.bincount(group.ravel(), weights, len(distinct))
    if len(distinct) <= k:
        return distinct
    pick = lambda w: int(rng.choice(len(distinct), p=w / w.sum()))
    centers = distinct[[pick(weights if weights.sum() > 0 else np.ones(len(distinct)))]]
    while len(centers) < k:
        cost = costs(distinct, centers).min(axis=1)
        owed = cost * weights if (cost * weights).sum() > 0 else cost
        centers = np.vstack([centers, distinct[pick(owed) if owed.sum() > 0 else int(rng.integers(len(distinct)))]])
    before = None
    for _ in range(steps):
        best = costs(distinct, centers).argmin(axis=1)
        if before is not None and (best == before).all():
            break
        before = best
        for j in range(k):
            own = weights[best == j].sum()
            centers[j] = np.average(distinct[best == j], axis=0, weights=weights[best == j]) if own > 0 else distinct[int(rng.integers(len(distinct)))]
    return centers


def add_up(parts: list[list[tuple]]) -> list[tuple]:
    out = parts[0]
    for part in parts[1:]:
        out = [tuple(a + b for a, b in zip(x, y, strict=True)) for x, y in zip(out, part, strict=True)]
    return out


def centers_of(run: Callable, sizes: dict[tuple[int, int], float], k: int, seeds: list[int], *, init_steps: int, max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """The centers of least cost of the restarts ``seeds``, and that cost; ``run(pass, arguments)`` gives a pass's results of all tasks."""
    places = sorted(sizes)
    share = np.array([sizes[p] for p in places]) / sum(sizes.values())
    draws = [np.random.default_rng([s, 0]) for s in seeds]
    wanted: dict = {}
    for r, rng in enumerate(draws):
        wanted.setdefault(places[int(rng.choice(len(places), p=share))], []).append((r, float(rng.random())))
    centers = [row[None, :] for _, row in sorted(run(first_rows, wanted), key=lambda found: found[0])]
    for step in range(1, init_steps + 1):
        totals = [float(total[0]) for *_, total in add_up(run(lloyd_pass, centers))]
        found = sorted(run(drawn_rows, centers, totals, k, seeds, step), key=lambda f: (f[0], f[1].tolist()))
        centers = [np.vstack([c, *[row for r, row in found if r == i]]) for i, c in enumerate(centers)]
    weights = [counts for _, counts, _ in add_up(run(lloyd_pass, centers))]
    centers = [reduced(c, w, k, rng) for c, w, rng in zip(centers, weights, draws, strict=True)]
    cost, going = [np.inf] * len(seeds), list(range(len(seeds)))
    for _ in range(max_iter):
        if not going:
            break
        stays = []
        for r, (sums, counts, total) in zip(going, add_up(run(lloyd_pass, [centers[r] for r in going])), strict=True):
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers[r])
            if (((moved - centers[r]) ** 2).sum(axis=1) > tol * tol).any():
                stays.append(r)
            centers[r], cost[r] = moved, float(total[0])
        going = stays
    best = int(np.argmin(cost))
    return centers[best], cost[best]


def fit(est: KMeans, df: DataFrame, restarts: int) -> KMeansModel:
    """Spark ML's model of the best of ``restarts`` fits of ``est``, with seeds counted from its own."""
    spark = df.sparkSession
    points = points_of(df, spark.sparkContext.defaultParallelism, est.getFeaturesCol()).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = dict(points.map(lambda b: (b.place, float(b.rows.sum()))).collect())
    run = lambda one_pass, *args: points.mapPartitions(lambda blocks: one_pass(blocks, *args)).collect()
    centers, _ = centers_of(run, sizes, est.getK(), [est.getSeed() + i for i in range(restarts)], init_steps=est.getInitSteps(),
                            max_iter=est.getMaxIter(), tol=est.getTol())
    points.unpersist()
    path = scratch_path(spark, "kmeans")
    spark.createDataFrame([(description(est, "clustering.KMeansModel", est.uid),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    schema = T.StructType([T.StructField("clusterIdx", T.IntegerType()), T.StructField("clusterCenter", VectorUDT())])
    spark.createDataFrame([(i, Vectors.dense(c)) for i, c in enumerate(centers.tolist())], schema).coalesce(1).write.parquet(f"{path}/data")
    return KMeansModel.load(path)
