"""K-means with several restarts, all of them in one pass over the points per iteration."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import evenly_written

#: A restart is done when no centre moves further than this.
TOLERANCE = 1e-4
_SUMS = "restart int, centre int, slot int, value double"
_DRAWS = "restart int, draw int, weight double, x array<double>"


@dataclass(frozen=True)
class KMeansFit:
    """Centres of the restart with the lowest cost (the sum of squared distances)."""

    centres: list[list[float]]
    cost: float
    iterations: int


def _uniform(rid: np.ndarray, *salt: int) -> np.ndarray:
    """A number above 0 and below 1 for every row, the same in every run."""
    h = rid.astype(np.uint64)
    for s in salt:
        with np.errstate(over="ignore"):
            h = (h ^ np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` from the last axis of ``centres``."""
    out = np.zeros((len(x), *centres.shape[:-1]))
    for i in range(x.shape[1]):
        gap = x[:, i].reshape(-1, *[1] * (centres.ndim - 1)) - centres[..., i]
        out += gap * gap
    return out


def _batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        x = np.stack([batch.column(f"x{i}").to_numpy() for i in range(dims)], axis=1)
        yield batch.column("rid").to_numpy(), x


def _sums(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per restart and centre: points, cost (in the first centre's slot) and sums of columns.

    One restart at a time and one column after the other, so that what is computed stays in
    the processor's cache.
    """
    columns = [np.ascontiguousarray(c) for c in x.T]
    restarts, k, dims = centres.shape
    out = np.zeros((restarts, k, dims + 2))
    for r in range(restarts):
        own = np.zeros(len(x), dtype=np.intp)
        least = None
        for j in range(k):
            squares = np.zeros(len(x))
            for column, at in zip(columns, centres[r, j], strict=True):
                gap = column - at
                gap *= gap
                squares += gap
            if least is None:
                least = squares
            else:
                np.putmask(own, squares < least, j)
                np.minimum(least, squares, out=least)
        out[r, :, 0] = np.bincount(own, minlength=k)
        out[r, 0, 1] = least.sum()
        for i, column in enumerate(columns):
            out[r, :, 2 + i] = np.bincount(own, column, minlength=k)
    return out


def _drawn(
    points: DataFrame, dims: int, chosen: np.ndarray | None, restarts: int, draws: int, step: int, seed: int
) -> dict[tuple[int, int], np.ndarray]:
    """(restart, draw) to a point drawn with a weight of its squared distance to ``chosen``.

    The row with the least exponential number over its weight is such a draw, so one
    aggregate makes all of them. Without centres yet the weight is the same for all.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[float, list[float]]] = {}
        for rid, x in _batches(batches, dims):
            if not len(x):
                continue
            far = np.ones((len(x), restarts))
            if chosen is not None:
                far = _squares(x, chosen).min(axis=2)
            for r in range(restarts):
                for d in range(draws):
                    with np.errstate(divide="ignore"):
                        weight = -np.log(_uniform(rid, seed, r, step, d)) / far[:, r]
                    i = int(weight.argmin())
                    if np.isfinite(weight[i]) and weight[i] < best.get((r, d), (np.inf,))[0]:
                        best[r, d] = float(weight[i]), x[i].tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _ in best], pa.int32()),
                pa.array([d for _, d in best], pa.int32()),
                pa.array([w for w, _ in best.values()], pa.float64()),
                pa.array([p for _, p in best.values()], pa.list_(pa.float64())),
            ],
            ["restart", "draw", "weight", "x"],
        )

    rows = points.mapInArrow(draw, _DRAWS).groupBy("restart", "draw").agg(F.min_by("x", "weight").alias("x"))
    return {(r.restart, r.draw): np.array(r.x) for r in rows.collect()}


def _summed(
    points: DataFrame, dims: int, add: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray | None:
    """The sum of ``add`` over all points, an array (restart, centre, slot); None without points.

    Tasks add up their points first and send one number per entry, whatever the points.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _batches(batches, dims):
            for start in range(0, len(x), 20_000):
                own = add(x[start : start + 20_000])
                total = own if total is None else total + own
        if total is None:
            return
        index = np.indices(total.shape, dtype=np.int32).reshape(3, -1)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(i) for i in index), pa.array(total.ravel())], ["restart", "centre", "slot", "value"]
        )

    rows = points.mapInArrow(partial, _SUMS).groupBy("restart", "centre", "slot")
    found = rows.agg(F.sum("value").alias("value")).collect()
    if not found:
        return None
    out = np.zeros([max(r[i] for r in found) + 1 for i in range(3)])
    for r in found:
        out[r.restart, r.centre, r.slot] = r.value
    return out


def _seeds(points: DataFrame, dims: int, k: int, restarts: int, seed: int) -> np.ndarray | None:
    """Greedy k-means++: of a few points drawn by distance, the one that lowers the cost most."""
    first = _drawn(points, dims, None, restarts, 1, 0, seed)
    if not first:
        return None
    chosen = np.stack([first[r, 0] for r in range(restarts)])[:, None, :]
    draws = 2 + int(math.log(k))
    for step in range(1, k):
        found = _drawn(points, dims, chosen, restarts, draws, step, seed)
        # Without a point apart from the centres a centre is taken twice.
        tried = np.stack(
            [[found.get((r, d), chosen[r, 0]) for d in range(draws)] for r in range(restarts)]
        )

        def cost(x: np.ndarray, chosen=chosen, tried=tried) -> np.ndarray:
            near = _squares(x, chosen).min(axis=2)
            return np.minimum(near[:, :, None], _squares(x, tried)).sum(axis=0)[:, :, None]

        best = _summed(points, dims, cost)[:, :, 0].argmin(axis=1)
        taken = tried[np.arange(restarts), best]
        chosen = np.concatenate([chosen, taken[:, None, :]], axis=1)
    return chosen


def fit(
    vectors: DataFrame,
    column: str,
    k: int,
    restarts: int,
    iterations: int,
    seed: int,
    tolerance: float = TOLERANCE,
) -> KMeansFit:
    """The best of ``restarts`` fits on the array ``column`` of ``vectors``.

    Every iteration is one aggregate for all restarts: a task sends the sums, counts and
    costs of its points, restarts x k x (columns + 2) numbers. A restart whose centres
    stand still takes no further part. A centre without points stays where it is. Rows with
    a null vector do not count; without rows, or with fewer than one centre, ValueError.
    """
    if k < 1 or restarts < 1:
        raise ValueError("at least one centre and one restart are needed")
    rows = vectors.where(F.col(column).isNotNull())
    first = rows.select(F.size(column)).first()
    if first is None:
        raise ValueError("no rows to cluster")
    dims = first[0]
    points = evenly_written(
        rows.select(
            F.monotonically_increasing_id().alias("rid"),
            *(F.col(column)[i].alias(f"x{i}") for i in range(dims)),
        ),
        "kmeans-points",
    )
    centres = _seeds(points, dims, k, restarts, seed)
    moving = np.arange(restarts)
    done = 0

    def sums(centres: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        return lambda x: _sums(x, centres)

    while done < iterations and len(moving):
        total = _summed(points, dims, sums(centres[moving]))
        n = total[:, :, :1]
        new = np.where(n > 0, total[:, :, 2:] / np.maximum(n, 1), centres[moving])
        moved = ((new - centres[moving]) ** 2).sum(axis=2).max(axis=1)
        centres[moving] = new
        moving = moving[moved > tolerance**2]
        done += 1
    cost = _summed(points, dims, sums(centres))[:, 0, 1]
    best = int(cost.argmin())
    return KMeansFit([list(map(float, c)) for c in centres[best]], float(cost[best]), done)
