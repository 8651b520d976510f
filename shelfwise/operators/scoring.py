"""Composite score, ranking and the join back to the full product record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import checked_broadcast, pinned

# Weights of the score, of the cluster quality, and the shortlist length.
WEIGHTS = {
    "top_product_probability": 0.60,
    "cluster_quality_score": 0.15,
    "rating": 0.15,
    "reviews": 0.05,
    "in_stock_flag": 0.05,
}
QUALITY_WEIGHTS = {"rating": 0.7, "reviews": 0.3}
TOP_K = 50
MAX_TOP = 200

SCORE_COLUMNS = (
    "top_product_probability",
    "cluster_id",
    "cluster_quality_score",
    "final_score",
    "pca_1",
    "pca_2",
)


def cluster_quality(df: DataFrame) -> DataFrame:
    """Per cluster: weighted sum of mean rating and mean number of reviews."""
    w = QUALITY_WEIGHTS
    return (
        df.where("cluster_id is not null")
        .groupBy("cluster_id")
        .agg(F.avg("rating").alias("avg_rating"), F.avg("reviews").alias("avg_reviews"))
        .withColumn(
            "cluster_score",
            F.col("avg_rating") * w["rating"] + F.col("avg_reviews") * w["reviews"],
        )
    )


def add_cluster_quality(df: DataFrame) -> DataFrame:
    """Look the cluster score up for every row; no cluster gives 0."""
    scores = checked_broadcast(cluster_quality(df).select("cluster_id", "cluster_score"))
    return df.join(scores, "cluster_id", "left").withColumn(
        "cluster_quality_score", F.coalesce("cluster_score", F.lit(0.0))
    ).drop("cluster_score")


def in_stock_flag(df: DataFrame) -> Column:
    """The one-hot stock column as a number, 0 where the table lacks it."""
    if "stock_in_stock" in df.columns:
        return F.coalesce(F.col("stock_in_stock").cast("double"), F.lit(0.0))
    return F.lit(0.0)


def _minmax(df: DataFrame, names: list[str]) -> dict[str, Column]:
    row = df.agg(*[F.min(n) for n in names], *[F.max(n) for n in names]).first()
    out = {}
    for i, name in enumerate(names):
        lo, hi = row[i] or 0.0, row[len(names) + i] or 0.0
        out[name] = (F.col(name) - lo) / ((hi - lo) or 1.0)
    return out


def add_final_score(
    df: DataFrame, weights: dict[str, float] = WEIGHTS, normalize: str | None = None
) -> DataFrame:
    """Weighted sum of the five signals.

    The signals keep their own scale by default, so reviews weigh most; ``"minmax"``
    brings each to 0..1 first.
    """
    signals = df.withColumns(
        {
            "in_stock_flag": in_stock_flag(df),
            "rating": F.coalesce("rating", F.lit(0.0)),
            "reviews": F.coalesce("reviews", F.lit(0.0)),
        }
    )
    values = {name: F.col(name) for name in weights}
    if normalize == "minmax":
        values = _minmax(signals, list(weights))
    elif normalize is not None:
        raise ValueError(f"unknown normalization {normalize!r}")
    total = None
    for name, weight in weights.items():
        part = values[name] * F.lit(weight)
        total = part if total is None else total + part
    return signals.withColumn("final_score", total)


def top_k(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best rows; ties by product id. Each task sends at most k rows."""
    return scored.orderBy(F.desc("final_score"), "product_id").limit(k)


def attach_products(ranked: DataFrame, products: DataFrame) -> DataFrame:
    """Full product record beside the scores of a short list; a missing one leaves the id.

    The product table is reduced to the listed ids first, so it is scanned but not
    shuffled, and the record carries its own price and rating, not the filled-in ones.
    """
    small = pinned(ranked)
    ranked = ranked if small is None else small
    both = set(ranked.columns) & set(products.columns)
    # Two shops may share an id: platform and store belong to the key where they are known.
    key = [c for c in ("platform", "store", "product_id") if c in both]
    ids = checked_broadcast(ranked.select(*key))
    reduced = products.join(ids, key, "left_semi")
    scores = ranked.select(*key, *[c for c in SCORE_COLUMNS if c in ranked.columns])
    return scores.join(checked_broadcast(reduced), key, "left").select(
        "product_id",
        *[c for c in products.columns if c != "product_id"],
        *[c for c in scores.columns if c not in key],
    )


def top_products(df: DataFrame, limit: int = 10) -> DataFrame:
    """The best rows by score, an unreadable score counting as 0."""
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise ValueError("limit must be an integer")
    if not 1 <= limit <= MAX_TOP:
        raise ValueError(f"limit must lie between 1 and {MAX_TOP}")
    score = F.coalesce(F.col("final_score").try_cast("double"), F.lit(0.0))
    return df.orderBy(F.desc(score), "product_id").limit(limit)


def cluster_summary(df: DataFrame, cluster_id: int) -> DataFrame:
    """Count and mean price and rating of one cluster, one row; fails if it is empty."""
    if isinstance(cluster_id, bool) or not isinstance(cluster_id, int):
        raise ValueError("cluster_id must be an integer")
    if cluster_id < 0:
        raise ValueError("cluster_id must be >= 0")
    members = df.where(F.col("cluster_id") == cluster_id)
    if members.isEmpty():
        raise ValueError(f"no products in cluster {cluster_id}")
    return cluster_summaries(members)


def cluster_summaries(df: DataFrame) -> DataFrame:
    """The same for every cluster."""
    price = F.col("price").try_cast("double")
    rating = F.col("rating").try_cast("double")
    return df.groupBy("cluster_id").agg(
        F.count("*").alias("product_count"),
        F.round(F.avg(price), 4).alias("avg_price"),
        F.round(F.avg(rating), 4).alias("avg_rating"),
        F.count(price).alias("price_samples"),
        F.count(rating).alias("rating_samples"),
    )
