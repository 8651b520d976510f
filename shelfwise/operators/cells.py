"""Points in cells of a grid, compared with the points of the cells around."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points of a cell that meet one comparison task; a larger cell is split.
SPLIT = 5_000
#: Points whose comparisons are one task.
TASK_POINTS = 10_000


def parts() -> Column:
    """Into how many parts a group of points, one cell, is split."""
    return F.ceil(F.count("*") / SPLIT).cast("int")


def squared_distance(x: Column, y: Column, dims: int) -> Column:
    parts = [(x[i] - y[i]) * (x[i] - y[i]) for i in range(dims)]
    return reduce(lambda a, b: a + b, parts)


def around(cell: str, offsets: list[tuple[int, ...]]) -> Column:
    """The cells at some offsets from a cell."""
    steps = F.lit([list(map(int, o)) for o in offsets])
    return F.explode(F.transform(steps, lambda o: F.zip_with(cell, o, lambda a, b: a + b)))


def compared(probes: DataFrame, near: DataFrame, points: DataFrame) -> DataFrame:
    """Probes beside all points of the cells around theirs; large cells in several parts.

    Points are few bytes for many comparisons: partitions go by their number, not their size.
    """
    cores = points.sparkSession.sparkContext.defaultParallelism
    tasks = max(2 * cores, -(-points.count() // TASK_POINTS))
    salts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    wanted = probes.join(near, "cell").select(*probes.columns, "other", salts)
    other = points.select(
        F.col("cell").alias("other"),
        F.pmod(F.xxhash64("point"), "parts").cast("int").alias("part"),
        *(F.col(c).alias(f"_{c}") for c in points.columns if c not in ("cell", "parts")),
    )
    met = ["other", "part"]
    return wanted.repartition(tasks, *met).join(other.repartition(tasks, *met), met)
