"""Bottom-up clusters by single linkage: the spanning tree of least distances, and its cuts.

Single linkage merges the two nearest clusters again and again. Its merges are the edges of
a minimum spanning tree in the order of their lengths, so the tree holds every cut. It is
found by Boruvka's rounds: every cluster but the largest looks for its nearest point
outside, in the cells around its own points, and all merge at once. When no cluster has a
neighbour within the radius, the radius is doubled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import cells as grid
from shelfwise.operators.graph import components, tree_roots
from shelfwise.operators.skew import join_split_hot
from shelfwise.session import written

#: Points that a ball of the first radius holds about, were they spread evenly.
FIRST_NEIGHBOURS = 8


def _first_radius(points: DataFrame, dims: int) -> float:
    """The radius at which evenly spread points have a few neighbours; 0 for a single point."""
    x = F.col("x")
    row = points.agg(
        F.count("*"), *(F.max(x[i]) - F.min(x[i]) for i in range(dims))
    ).first()
    n, extents = row[0], [e for e in row[1:] if e]
    if not extents:
        return 0.0
    return (math.prod(extents) * FIRST_NEIGHBOURS / n) ** (1 / len(extents))


def _in_cells(points: DataFrame, radius: float, dims: int) -> tuple[DataFrame, DataFrame]:
    """Points with their cell and its number of parts, and the table of cells."""
    side = radius * (1 + 1e-9)
    cell = F.array(*(F.floor(F.col("x")[i] / side) for i in range(dims)))
    placed = points.withColumn("cell", cell)
    table = written(placed.groupBy("cell").agg(grid.parts().alias("parts")), "cells")
    return written(placed.join(table, "cell"), "placed"), table


def nearest_outside(
    placed: DataFrame, table: DataFrame, clusters: DataFrame, largest: object, radius: float, dims: int
) -> DataFrame:
    """(``cluster``, ``best``): every cluster's shortest way out, but for the largest one's.

    ``best`` is (weight, a, b, to): the squared distance, the two points and the cluster met. Pairs
    of points are compared cell by cell, large cells in parts, and only the shortest of a
    task is shuffled.
    """
    points = written(placed.join(clusters, "point"), "clustered")
    probes = points.where(F.col("cluster") != F.lit(largest)).select("point", "cell", "x", "cluster")
    steps = [()]
    for _ in range(dims):
        steps = [(*s, d) for s in steps for d in (-1, 0, 1)]
    near = probes.select("cell").distinct().withColumn("other", grid.around("cell", steps))
    near = near.join(table.select(F.col("cell").alias("other"), "parts"), "other")
    weight = grid.squared_distance(F.col("x"), F.col("_x"), dims)
    met = (
        grid.compared(probes, near, points.select("point", "cell", "parts", "x", "cluster"))
        .where("cluster != _cluster")
        .withColumn("weight", weight)
        .where(F.col("weight") <= radius * radius)
    )
    ends = F.struct(
        "weight",
        F.least("point", "_point").alias("a"),
        F.greatest("point", "_point").alias("b"),
        F.col("_cluster").alias("to"),
    )
    return met.groupBy("cluster").agg(F.min(ends).alias("best"))


def spanning_tree(points: DataFrame, dims: int) -> DataFrame:
    """The edges (``a``, ``b``, ``weight``) of the tree of least squared distances over all points.

    ``points`` is a written table with ``point``, any value that sorts, and ``x``. Equal lengths are ordered
    by their points, so the tree is the same in every run. Different points never share
    all of ``x``.
    """
    radius = _first_radius(points, dims)
    clusters = written(points.select("point", F.col("point").alias("cluster")), "clusters")
    taken = []
    placed = None
    while True:
        sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
        largest = sizes.orderBy(F.desc("n"), "cluster").limit(2).collect()
        if len(largest) < 2:
            break
        if placed is None:
            placed, table = _in_cells(points, radius, dims)
        best = written(
            nearest_outside(placed, table, clusters, largest[0]["cluster"], radius, dims), "nearest"
        )
        if best.isEmpty():
            radius *= 2
            placed = None
            continue
        taken.append(best.select("best.a", "best.b", "best.weight").distinct())
        picks = best.select(F.col("cluster").alias("node"), F.col("best.to").alias("up"))
        back = picks.select(F.col("node").alias("up"), F.col("up").alias("_back"))
        # Two clusters that take the same edge would point at each other; a cluster that is
        # only pointed at is on top.
        mutual = (F.col("_back") == F.col("node")) & (F.col("node") < F.col("up"))
        ups = picks.join(back, "up", "left").select(
            "node", F.when(mutual, F.col("node")).otherwise(F.col("up")).alias("up")
        )
        tops = picks.select(F.col("up").alias("node")).distinct().join(picks, "node", "left_anti")
        roots = tree_roots(ups.union(tops.select("node", F.col("node").alias("up"))))
        moved = roots.select(F.col("node").alias("cluster"), "root")
        clusters = written(
            clusters.join(moved, "cluster", "left").select("point", F.coalesce("root", "cluster").alias("cluster")),
            "clusters",
        )
    if not taken:
        return points.select(F.col("point").alias("a"), F.col("point").alias("b"), F.lit(0.0).alias("weight")).limit(0)
    return reduce(DataFrame.union, taken)


def merge_tree(df: DataFrame, key: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, merges) of single linkage over ``columns``.

    ``rows`` is ``df`` with ``point``, the smallest ``key`` of the rows at the same place (null if a value is null,
    NaN or infinite). ``merges`` has a row per merge of two places: ``a``, ``b``, the nearest points of
    the two clusters, and ``height``, their distance. Its shortest rows are the first merges.
    """
    if not columns:
        raise ValueError("columns are needed")
    x = [F.col(f"`{c}`").cast("double") + 0.0 for c in columns]
    sound = reduce(
        lambda a, b: a & b, [F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) for v in x]
    )
    where = F.when(sound & F.col(key).isNotNull(), F.concat_ws("|", *(v.cast("string") for v in x)))
    rows = written(df.withColumn("_where", where), "rows")
    found = rows.where("_where is not null").groupBy("_where").agg(
        F.min(F.col(key)).alias("point"), F.first(F.array(*x)).alias("x")
    )
    found = written(found, "points")
    edges = written(spanning_tree(found.select("point", "x"), len(columns)), "merges")
    merges = edges.select("a", "b", F.sqrt("weight").alias("height"))
    return join_split_hot(rows, found.select("_where", "point"), "_where", "left").drop("_where"), merges


def cut(merges: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(``point``, ``cluster``) of the tree cut into ``k`` clusters: without its k - 1 longest merges.

    ``points`` has the column ``point``. A cluster is named by its smallest point. With fewer than ``k``
    points every point is a cluster.
    """
    if k < 1:
        raise ValueError("at least one cluster is needed")
    merges = written(merges, "merges")
    longest = merges.orderBy(F.desc("height"), F.desc("a"), F.desc("b")).limit(k - 1)
    left = merges.join(longest, ["a", "b"], "left_anti").select("a", "b")
    nodes = points.select(F.col("point").alias("node")).distinct()
    return components(nodes, left).select(
        F.col("node").alias("point"), F.col("root").alias("cluster")
    )


def single_linkage(df: DataFrame, key: str, columns: Sequence[str], k: int) -> DataFrame:
    """``df`` with ``cluster``, the smallest ``key`` of its cluster after cutting into ``k``.

    Rows at the same place share a cluster. A row with a null key, or a null, NaN or infinite
    value, has no cluster. ``k`` clusters at most, fewer if there are fewer places; an empty
    table gives no rows. Distances are Euclidean: scale the columns before.
    """
    rows, merges = merge_tree(df, key, columns)
    rows = written(rows.withColumnRenamed("point", "_point"), "rows")
    points = rows.where("_point is not null").select(F.col("_point").alias("point")).distinct()
    found = cut(merges, points, k).withColumnRenamed("point", "_point")
    return join_split_hot(rows, found, "_point", "left").drop("_point")
