"""Graphs as tables of edges: connected components and minimum spanning forests.

Both contract the graph round by round. Every node picks one neighbour, the picks form
trees, each tree becomes one node and edges inside it go. That halves the nodes that have
edges at least, so a table of any size takes a few rounds, each a handful of aggregates
and joins. Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import written

MAX_ROUNDS = 64


def tree_roots(picks: DataFrame) -> DataFrame:
    """(``node``, ``root``) of a forest of (``node``, ``up``), a node on top being its own ``up``.

    Every step doubles the reach of a pointer.
    """
    table = written(picks.select("node", F.col("up").alias("root")), "pointers")
    for _ in range(MAX_ROUNDS):
        above = table.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        moved = table.join(above, F.col("root") == F.col("_node")).select(
            "node", F.col("_root").alias("root"), (F.col("_root") != F.col("root")).alias("moved")
        )
        table = written(moved, "pointers")
        if table.where("moved").isEmpty():
            return table.select("node", "root")
    raise RuntimeError(f"pointers did not settle in {MAX_ROUNDS} rounds")


def _relabelled(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``, ...) between the roots of their ends, without those inside a tree."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
    others = [c for c in edges.columns if c not in ("a", "b")]
    return (
        edges.join(left, "a")
        .join(right, "b")
        .where("_a != _b")
        .select(F.col("_a").alias("a"), F.col("_b").alias("b"), *others)
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = [F.col("b").alias("a"), F.col("a").alias("b")]
    others = [c for c in edges.columns if c not in ("a", "b")]
    return edges.select("a", "b", *others).union(edges.select(*turned, *others))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every row of ``nodes`` (column ``node``, different ones).

    ``root`` is the smallest node that can be reached over ``edges`` (``a``, ``b``, both in ``nodes``). In
    a round every node moves to its smallest neighbour if that is smaller; a node with
    very many edges is added up before the shuffle and has fewer in the next round, as
    edges that lead to the same tree become one. Without edges every node is its own root.
    """
    edges = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    found = written(nodes.select("node", F.col("node").alias("root")), "components")
    for _ in range(MAX_ROUNDS):
        if edges.isEmpty():
            return found
        low = _both_ways(edges).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        roots = tree_roots(low.select("node", F.least("node", "low").alias("up")))
        to = roots.select(F.col("node").alias("root"), F.col("root").alias("_to"))
        found = written(
            found.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root")),
            "components",
        )
        edges = written(_relabelled(edges, roots).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def spanning_forest(edges: DataFrame) -> DataFrame:
    """The edges (``a``, ``b``, ``weight``) of a minimum spanning forest, by Boruvka's rounds.

    In a round every tree takes its lightest edge to another tree. Edges of equal weight are
    ordered by their ends (smaller first), so no cycle can arise and the result is the same
    in every run. Between two trees only the lightest edge goes on to the next round.
    """
    ordered = edges.where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "weight"
    )
    ends = F.struct("weight", F.col("a").alias("x"), F.col("b").alias("y"))
    left = written(
        ordered.groupBy("a", "b").agg(F.min("weight").alias("weight")).select("a", "b", ends.alias("edge")),
        "edges",
    )
    taken = []
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        best = _both_ways(left).groupBy(F.col("a").alias("node")).agg(
            F.min(F.struct("edge", "b")).alias("best")
        )
        best = written(best.select("node", "best.edge", F.col("best.b").alias("to")), "lightest")
        taken.append(best.select("edge").distinct())
        # Two trees that take the same edge would point at each other: the smaller is on top.
        back = best.select(F.col("node").alias("to"), F.col("to").alias("_back"))
        picks = best.join(back, "to").select(
            "node", F.when((F.col("_back") == F.col("node")) & (F.col("node") < F.col("to")), F.col("node")).otherwise(F.col("to")).alias("up")
        )
        left = _relabelled(left, tree_roots(picks)).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "edge"
        )
        left = written(left.groupBy("a", "b").agg(F.min("edge").alias("edge")), "edges")
    else:
        raise RuntimeError(f"spanning forest did not settle in {MAX_ROUNDS} rounds")
    if not taken:
        return ordered.select("a", "b", "weight").limit(0)
    out = taken[0]
    for part in taken[1:]:
        out = out.union(part)
    return out.select(F.col("edge.x").alias("a"), F.col("edge.y").alias("b"), "edge.weight")
