"""K-Means for many numbers of clusters and restarts at once: each pass over the rows serves all of them.

Fitting one model after another reads the rows once per model and iteration. Here every pass carries the
centres of all models (their number depends on the models alone) and brings back, for each centre, a count and
sums; partitions are reduced before anything is shuffled. Starting centres are drawn by k-means++ from all rows:
a row wins a round with the smallest -log(u) / distance², which picks it with a chance in proportion to its
squared distance. u comes from the row's hash, so a draw does not depend on partitions or order.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks carry the functions of this module with them, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows whose distances to the centres of a model are held at once.
SLICE_ROWS = 4000
#: A model is settled when no centre moves farther.
TOLERANCE = 1e-4


@dataclass
class Model:
    k: int
    seed: int
    centres: np.ndarray
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    squares: np.ndarray = field(default_factory=lambda: np.zeros(0))
    inertia: float = 0.0
    silhouette: float | None = None


def _uniform(noise: np.ndarray, salt: int) -> np.ndarray:
    """Numbers between 0 and 1 (without both), the same for the same hash and salt."""
    x = noise.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared, a row for each centre; exactly 0 where a point and a centre are equal.

    Points lie along the rows, so that numpy goes through them in one stretch for each of the few centres.
    """
    total, gap = np.zeros((len(centres), points.shape[1])), np.empty((len(centres), points.shape[1]))
    for axis, at in zip(points, centres.T):
        np.subtract(axis, at[:, None], out=gap)
        total += np.multiply(gap, gap, out=gap)
    return total


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each point the nearest centre, the first of equals, and the squared distance to it."""
    distances = _distances(points, centres)
    least = distances.min(0)
    return (distances == least).argmax(0), least


def _passed(rows: DataFrame, axes: list[str], reduce: Callable[[Iterator[tuple[np.ndarray, np.ndarray]]], dict], schema: str) -> DataFrame:
    """`reduce` turns the (points, hashes) of a partition, in slices, into columns. Points have a row for each axis."""

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                points = np.vstack([part.column(a).to_numpy(zero_copy_only=False).astype(float) for a in axes])
                if np.isnan(points).any():
                    raise ValueError("a feature is null")
                yield points, part.column("noise").to_numpy()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict(reduce(slices(batches)))

    return rows.mapInArrow(run, schema)


def _draw(rows: DataFrame, axes: list[str], models: list[Model], turn: int) -> None:
    """Adds one centre to each model, unless all rows lie on its centres."""
    centres, salts = [m.centres for m in models], [m.seed * 1_000_003 + m.k * 1009 + turn for m in models]

    def best(slices: Iterator[tuple[np.ndarray, np.ndarray]]) -> dict:
        key, at = np.full(len(centres), np.inf), np.zeros((len(centres), len(axes)))
        for points, noise in slices:
            for i, (held, salt) in enumerate(zip(centres, salts)):
                weight = _distances(points, held).min(0) if len(held) else np.ones(len(noise))
                keys = np.divide(-np.log(_uniform(noise, salt)), weight, out=np.full(len(noise), np.inf), where=weight > 0)
                least = keys.argmin()
                if keys[least] < key[i]:
                    key[i], at[i] = keys[least], points[:, least]
        won = np.flatnonzero(np.isfinite(key))
        return {"model": won.astype(np.int32), "key": key[won], "at": pa.array(at[won].tolist(), pa.list_(pa.float64()))}

    drawn = _passed(rows, axes, best, "model int, key double, at array<double>")
    for row in drawn.groupBy("model").agg(F.min_by("at", "key").alias("at")).collect():  # a row per model
        models[row.model].centres = np.vstack([models[row.model].centres, row.at])


def _assign(rows: DataFrame, axes: list[str], models: list[Model], settled: bool = False) -> None:
    """Per model the size and sums of its clusters; once `settled`, their squares and its inertia as well."""
    stacked, ends = np.vstack([m.centres for m in models]), np.cumsum([len(m.centres) for m in models])
    width = 1 + len(axes) + 2 * settled  # size, sums, inertia, squares

    def totals(slices: Iterator[tuple[np.ndarray, np.ndarray]]) -> dict:
        held = np.zeros((len(stacked), width))
        for points, _ in slices:
            squares = (points**2).sum(0)
            for start, end in zip([0, *ends[:-1]], ends):
                nearest, least = _nearest(points, stacked[start:end])
                for j, weights in enumerate([None, *points, least, squares][:width]):
                    held[start:end, j] += np.bincount(nearest, weights, end - start)
        return {"centre": np.arange(len(stacked), dtype=np.int32), **{f"v{j}": held[:, j] for j in range(width)}}

    names = [f"v{j}" for j in range(width)]
    found = _passed(rows, axes, totals, ", ".join(["centre int", *(f"{n} double" for n in names)]))
    held = np.zeros((len(stacked), len(names)))
    for row in found.groupBy("centre").agg(*[F.sum(n).alias(n) for n in names]).collect():  # a row per centre
        held[row.centre] = row[1:]
    for m, start, end in zip(models, [0, *ends[:-1]], ends):
        m.sizes, m.sums = held[start:end, 0], held[start:end, 1 : 1 + len(axes)]
        if settled:
            m.inertia, m.squares = float(held[start:end, -2].sum()), held[start:end, -1]


def _silhouettes(rows: DataFrame, axes: list[str], models: list[Model]) -> None:
    """The mean silhouette of squared distances, from the sums of the clusters."""
    stated = [(m.centres[m.sizes > 0], m.sizes[m.sizes > 0], m.sums[m.sizes > 0], m.squares[m.sizes > 0]) for m in models]

    def totals(slices: Iterator[tuple[np.ndarray, np.ndarray]]) -> dict:
        held, n = np.zeros(len(stated)), 0
        for points, _ in slices:
            n += points.shape[1]
            for i, (centres, sizes, sums, squares) in enumerate(stated):
                if len(sizes) < 2:
                    continue
                own, each = _nearest(points, centres)[0], np.arange(points.shape[1])
                mean = (points**2).sum(0) + (squares / sizes)[:, None] - 2 * (sums / sizes[:, None]) @ points
                mean = np.maximum(mean, 0)
                inside = mean[own, each] * sizes[own] / np.maximum(sizes[own] - 1, 1)
                mean[own, each] = np.inf
                outside = mean.min(0)
                larger = np.maximum(inside, outside)
                value = np.divide(outside - inside, larger, out=np.zeros(len(larger)), where=larger > 0)
                held[i] += value[sizes[own] > 1].sum()
        return {"model": np.arange(len(stated), dtype=np.int32), "total": held, "n": np.full(len(stated), n)}

    found = _passed(rows, axes, totals, "model int, total double, n long").groupBy("model").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    for row in found.collect():  # a row per model
        if row.n and len(stated[row.model][1]) > 1:
            models[row.model].silhouette = row.total / row.n


def fit(rows: DataFrame, axes: list[str], ks: Iterable[int], seeds: Iterable[int], iterations: int, tolerance: float = TOLERANCE) -> list[Model]:
    """Per k the best of the models that begin from `seeds`, with its inertia and silhouette.

    `rows` has the columns `axes` (doubles) and `noise` (a 64-bit hash that names the row); it is read once for each
    centre drawn and once for each iteration, whatever the number of models. A model has fewer than k centres if there
    are fewer different rows; with fewer than two clusters there is no silhouette. A null feature is an error.
    """
    seeds = list(seeds)
    models = [Model(k, seed, np.zeros((0, len(axes)))) for k in ks for seed in seeds]
    for turn in range(max((m.k for m in models), default=0)):
        _draw(rows, axes, [m for m in models if m.k > turn], turn)
    placed = live = [m for m in models if len(m.centres)]
    for _ in range(iterations):
        if not live:
            break
        _assign(rows, axes, live)
        moving = []
        for m in live:
            before = m.centres
            m.centres = np.where(m.sizes[:, None] > 0, m.sums / np.maximum(m.sizes, 1)[:, None], before)
            if ((m.centres - before) ** 2).sum(1).max() > tolerance**2:
                moving.append(m)
        live = moving
    if placed:
        _assign(rows, axes, placed, settled=True)
    best: dict[int, Model] = {}
    for m in models:
        if m.k not in best or m.inertia < best[m.k].inertia:
            best[m.k] = m
    if placed:
        _silhouettes(rows, axes, list(best.values()))
    return list(best.values())
