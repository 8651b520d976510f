"""Clusters by density over several columns (DBSCAN), with cells as wide as the radius allows.

The space is cut into cells so small that all points of a cell lie within the radius of each
other. A cell with enough points needs no distance: all of them are core points. Only points
of other cells, of which a cell has few, are compared with the cells around. Cells with core
points are linked if two of their core points are near; boxes around the points decide
most pairs of cells, halved until they do.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import cells as grid
from shelfwise.operators.cells import around, compared, squared_distance
from shelfwise.operators.graph import components
from shelfwise.operators.skew import join_split_hot
from shelfwise.session import written

#: Pairs of cells with at most so many pairs of points are compared point by point.
SMALL = 10_000
MAX_HALVINGS = 60


def _box_distances(dims: int) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance of boxes ``lo``, ``hi`` and ``_lo``, ``_hi``."""
    least, most = [], []
    for i in range(dims):
        lo, hi, lo2, hi2 = (F.col(c)[i] for c in ("lo", "hi", "_lo", "_hi"))
        gap = F.greatest(lo2 - hi, lo - hi2, F.lit(0.0))
        reach = F.greatest(hi2 - lo, hi - lo2)
        least.append(gap * gap)
        most.append(reach * reach)
    return reduce(lambda a, b: a + b, least), reduce(lambda a, b: a + b, most)


def _boxes(points: DataFrame, keys: list[str], dims: int) -> DataFrame:
    """Number and box of the points of each group."""
    return points.groupBy(*keys).agg(
        F.count("*").alias("m"),
        F.array(*(F.min(F.col("x")[i]) for i in range(dims))).alias("lo"),
        F.array(*(F.max(F.col("x")[i]) for i in range(dims))).alias("hi"),
    )


def linked_cells(core: DataFrame, offsets: list[tuple[int, ...]], eps: float, dims: int) -> DataFrame:
    """Pairs (``a``, ``b``) of cells that hold two core points within ``eps`` of each other.

    ``core`` is a written table with ``cell``, ``cell_id``, ``point`` and ``x``. The boxes of two cells are near
    or far altogether, or open. Open pairs of few points are compared point by point; for
    the others both cells are halved in every direction, again and again, and the boxes of
    the parts decide. A pair of cells is done as soon as two of its parts are near.
    """
    limit = F.lit(eps * eps)
    least, most = _box_distances(dims)
    cells = written(_boxes(core, ["cell", "cell_id"], dims), "core-cells")
    other = cells.select(
        F.col("cell").alias("other"), F.col("cell_id").alias("b"), F.col("m").alias("_m"),
        F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
    )
    half = [o for o in offsets if o > (0,) * dims]
    pairs = written(
        cells.withColumn("other", around("cell", half))
        .join(other, "other")
        .where(least <= limit)
        .select(F.col("cell_id").alias("a"), "b", (most <= limit).alias("near"), (F.col("m") * F.col("_m")).alias("work")),
        "cell-pairs",
    )
    links = [pairs.where("near").select("a", "b")]
    xs = core.select(F.col("cell_id").alias("a"), "x")
    ys = core.select(F.col("cell_id").alias("b"), F.col("x").alias("y"))
    small = pairs.where(~F.col("near") & (F.col("work") <= SMALL)).select("a", "b")
    met = small.join(xs, "a").join(ys, "b")
    met = met.where(squared_distance(F.col("x"), F.col("y"), dims) <= limit)
    links.append(met.select("a", "b").distinct())
    todo = pairs.where(~F.col("near") & (F.col("work") > SMALL))
    todo = written(todo.select("a", "b", F.lit(0).alias("u"), F.lit(0).alias("v")), "open-pairs")
    # Part 0 of a cell is all of it; a part's number is the hash of its place after halving.
    parent = core.withColumn("part", F.lit(0)).withColumn("scale", F.lit(1.0))
    for depth in range(1, MAX_HALVINGS + 1):
        if todo.isEmpty():
            break
        used = todo.select(F.col("a").alias("cell_id"), F.col("u").alias("part")).union(
            todo.select(F.col("b"), F.col("v"))
        )
        points = written(_halved(parent.join(used.distinct(), ["cell_id", "part"], "left_semi"), dims), "parts")
        boxes = written(_boxes(points, ["cell_id", "part", "child"], dims), "part-boxes")
        left = boxes.select(F.col("cell_id").alias("a"), F.col("part").alias("u"), F.col("child").alias("u2"), "lo", "hi")
        right = boxes.select(
            F.col("cell_id").alias("b"), F.col("part").alias("v"), F.col("child").alias("v2"),
            F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
        )
        checked = written(
            todo.join(left, ["a", "u"]).join(right, ["b", "v"]).where(least <= limit).select(
                "a", "b", F.col("u2").alias("u"), F.col("v2").alias("v"), (most <= limit).alias("near")
            ),
            "open-pairs",
        )
        near = checked.where("near").select("a", "b").distinct()
        links.append(near)
        todo = written(checked.join(near, ["a", "b"], "left_anti").select("a", "b", "u", "v"), "open-pairs")
        parent = points.select("cell_id", "x", F.col("child").alias("part"))
    else:
        raise RuntimeError("boxes of cells did not settle")
    return reduce(DataFrame.union, links)


def _halved(points: DataFrame, dims: int) -> DataFrame:
    """Add ``child``: the half-spaces of the middle of the part's box, as a new part number."""
    boxes = _boxes(points, ["cell_id", "part"], dims).select("cell_id", "part", "lo", "hi")
    sides = [F.when(F.col("x")[i] > (F.col("lo")[i] + F.col("hi")[i]) / 2, 1).otherwise(0) for i in range(dims)]
    side = reduce(lambda a, b: a * 2 + b, sides)
    child = F.xxhash64("part", side)
    return points.select("cell_id", "part", "x").join(boxes, ["cell_id", "part"]).select(
        "cell_id", "part", child.alias("child"), "x"
    )


def density_clusters(
    df: DataFrame, key: str, columns: Sequence[str], eps: float, min_points: int
) -> DataFrame:
    """``df`` with ``role`` (core, border, noise) and ``cluster``.

    A point is core if at least ``min_points`` rows, itself included, lie within ``eps`` by Euclidean
    distance over ``columns``. Core points within ``eps`` of each other share a cluster, named by
    the smallest ``key`` of its core rows. Other rows within ``eps`` of a core point are border
    rows and go to the smallest such cluster; the rest is noise, without a cluster.

    Equal points are counted once and compared once. No task holds all points of a cell:
    cells with very many are split wherever points are compared. A row with a null, NaN or
    infinite value has neither role nor cluster; a null key names no cluster unless all are
    null; an empty table gives no rows. Scale the columns before; the cells around a cell
    grow in number with the power of the columns, so a few columns are meant.
    """
    dims = len(columns)
    if not columns or eps <= 0 or min_points < 1:
        raise ValueError("columns, a radius above 0 and at least one point are needed")
    side = eps / math.sqrt(dims) * (1 - 1e-9)
    reach = math.floor(math.sqrt(dims)) + 1
    offsets = list(itertools.product(range(-reach, reach + 1), repeat=dims))
    # Adding 0 makes a negative zero the plain one.
    x = [F.col(f"`{c}`").cast("double") + 0.0 for c in columns]
    sound = reduce(lambda a, b: a & b, [F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) for v in x])
    where = F.when(sound, F.concat_ws("|", *(v.cast("string") for v in x)))
    placed = written(df.withColumn("_where", where), "rows")
    cell = F.array(*(F.floor(v / side) for v in x))
    found = (
        placed.where("_where is not null")
        .groupBy("_where")
        .agg(F.count("*").alias("rows"), F.min(F.col(key)).alias("name"), F.first(F.array(*x)).alias("x"), F.first(cell).alias("cell"))
    )
    found = written(found.withColumn("point", F.monotonically_increasing_id()), "points")
    cells = written(
        found.groupBy("cell").agg(
            F.sum("rows").alias("n"), F.min("point").alias("cell_id"),
            grid.parts().alias("parts"),
        ),
        "cells",
    )
    points = written(found.join(cells, "cell"), "points-in-cells")
    few = cells.where(F.col("n") < min_points).select("cell")
    near = few.withColumn("other", around("cell", offsets)).join(
        cells.select(F.col("cell").alias("other"), "parts"), "other"
    )
    near = written(near, "cells-around")
    limit = F.lit(eps * eps)
    within = squared_distance(F.col("x"), F.col("_x"), dims) <= limit
    probes = points.where(F.col("n") < min_points).select("point", "cell", "x")
    met = compared(probes, near, points.select("point", "cell", "parts", "x", "rows")).where(within)
    counts = met.groupBy("point").agg(F.sum("_rows").alias("neighbours"))
    judged = points.join(counts, "point", "left").withColumn(
        "core", (F.col("n") >= min_points) | (F.coalesce("neighbours", F.lit(0)) >= min_points)
    )
    judged = written(judged, "judged")
    core = written(judged.where("core").select("point", "cell", "cell_id", "parts", "x", "name"), "core")
    nodes = core.select(F.col("cell_id").alias("node")).distinct()
    groups = components(nodes, linked_cells(core, offsets, eps, dims))
    named = core.join(groups.withColumnRenamed("node", "cell_id"), "cell_id")
    names = named.groupBy("root").agg(F.min("name").alias("cluster"))
    core = written(named.join(names, "root").select("point", "cell", "parts", "x", "cluster"), "named-core")
    loose = judged.where("not core").select("point", "cell", "x")
    border = compared(loose, near, core).where(within).groupBy("point").agg(
        F.count("*").alias("_met"), F.min("_cluster").alias("cluster")
    )
    labels = core.select("point", "cluster", F.lit("core").alias("role")).union(
        border.select("point", "cluster", F.lit("border"))
    )
    labels = judged.select("point", "_where").join(labels, "point", "left").select(
        "_where", "cluster", F.coalesce("role", F.lit("noise")).alias("role")
    )
    joined = join_split_hot(placed, labels, "_where", "left")
    return joined.drop("_where")
