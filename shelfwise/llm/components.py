"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import written

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (``a``, ``b``).

    ``root`` is the smallest node that can be reached. Rounds of large-star and small-star
    steps: each is an aggregate per node and a join by node, so a node with very many
    links is pre-aggregated on the map side and split by the join. Each round is written
    to the shared folder, which cuts the lineage. Links of a node with itself, repeated
    links and links with a null end give nothing of their own.
    """
    pairs = (
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = written(pairs, "links")
    before = None
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour of a node moves to the node's smallest one.
        both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = (
            pairs.join(low, pairs.v == low.n)
            .select("u", F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        # Small star: a node's smaller neighbours and the node itself meet at the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        pairs = written(small, "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v"), F.col("v")).distinct()
    )
