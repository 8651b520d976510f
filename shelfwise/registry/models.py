"""Checks of scaling, clustering, projection and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import features, models
from shelfwise.plans import train_score
from shelfwise.registry import query
from shelfwise.registry.data import (
    ASSIGNED,
    FILLED,
    assigned,
    catalog_table,
    prepared,
    table,
)
from shelfwise.session import scratch_path, written
from shelfwise.sources import artifacts


@query(
    "scaled_features",
    f"""with {FILLED},
    stats as (
      select avg(price) as pm, stddev_pop(price) as ps, avg(rating) as rm,
             stddev_pop(rating) as rs, avg(review_count) as vm, stddev_pop(review_count) as vs
      from labelled)
    select product_id, round((price - pm) / ps, 6) as price,
           round((rating - rm) / rs, 6) as rating,
           round((review_count - vm) / vs, 6) as reviews
    from labelled cross join stats""",
)
def scaled_features(spark, sf):
    df = features.add_reviews(prepared(spark, sf)[0])
    scaler = models.fit_scaler(df)
    return df.select(
        "product_id", *[F.round(scaler.scaled(c), 6).alias(c) for c in scaler.columns]
    )


@query(
    "cluster_assignment",
    f"with {ASSIGNED} select product_id, cluster_id from assigned",
)
def cluster_assignment(spark, sf):
    return assigned(spark, sf).select("product_id", "cluster_id")


@query(
    "projection",
    f"""with {ASSIGNED}
    select product_id, round(pca_1, 9) + 0.0 as pca_1, round(pca_2, 9) + 0.0 as pca_2
    from assigned""",
)
def projection(spark, sf):
    # Adding zero turns a negative zero into a plain one.
    return assigned(spark, sf).select(
        "product_id", *[(F.round(c, 9) + 0.0).alias(c) for c in ("pca_1", "pca_2")]
    )


@query(
    "confusion_metrics",
    """with c as (
      select count(*) filter (where quality = 0 and guess = 0) as true_negative,
             count(*) filter (where quality = 0 and guess = 1) as false_positive,
             count(*) filter (where quality = 1 and guess = 0) as false_negative,
             count(*) filter (where quality = 1 and guess = 1) as true_positive
      from (select quality, case when n_chars >= 1500 then 1 else 0 end as guess
            from labels join documents using (doc_id)))
    select *,
           coalesce((true_positive + true_negative) / nullif(true_positive + true_negative
             + false_positive + false_negative, 0), 0.0::double) as accuracy,
           coalesce(true_positive / nullif(true_positive + false_positive, 0), 0.0::double)
             as precision,
           coalesce(true_positive / nullif(true_positive + false_negative, 0), 0.0::double)
             as recall,
           coalesce(2 * true_positive / nullif(2 * true_positive + false_positive
             + false_negative, 0), 0.0::double) as f1_score,
           true_negative + false_positive + false_negative + true_positive as test_samples
    from c""",
)
def confusion_metrics(spark, sf):
    lengths = table(spark, sf, "documents", "doc_id", "n_chars")
    rows = table(spark, sf, "labels", "doc_id", "quality").join(lengths, "doc_id")
    guess = F.when(F.col("n_chars") >= 1500, 1).otherwise(0)
    return models.confusion(rows, F.col("quality"), guess)


@query(
    "silhouette_euclidean",
    """with sums as (
      select a.vec_id, a.label as own, b.label as other,
             sum(list_distance(cast(a.embedding as double[]), cast(b.embedding as double[])))
               as total,
             count(*) as n
      from embeddings a cross join embeddings b group by 1, 2, 3),
    per_point as (
      select vec_id, max(case when own = other then n end) as own_n,
             max(case when own = other then total / nullif(n - 1, 0) end) as a,
             min(case when own <> other then total / n end) as b
      from sums group by vec_id)
    select round(avg(case when own_n = 1 then 0.0::double
                          else (b - a) / greatest(a, b) end), 9) as silhouette_score,
           count(*) as n_samples
    from per_point""",
)
def silhouette_euclidean(spark, sf):
    points = table(spark, sf, "embeddings", "embedding", "label")
    return models.silhouette(points, F.col("embedding"), "label").select(
        F.round("silhouette_score", 9).alias("silhouette_score"), "n_samples"
    )


@query("kmeans_clusters")
def kmeans_clusters(spark, sf):
    table_ = written(features.add_reviews(prepared(spark, sf)[0]), "prepared")
    segmenter = models.fit_segmenter(table_)
    return segmenter.assign(table_).groupBy("cluster_id").agg(
        F.count("*").alias("products"),
        F.round(F.avg("price"), 4).alias("avg_price"),
        F.round(F.avg("pca_1"), 4).alias("avg_pca_1"),
        F.round(F.avg("pca_2"), 4).alias("avg_pca_2"),
    )


@query("segment_metrics")
def segment_metrics(spark, sf):
    table_ = written(features.add_reviews(prepared(spark, sf)[0]), "prepared")
    segmenter = models.fit_segmenter(table_)
    return models.segment_metrics(table_, segmenter, metric="squaredEuclidean")


@query("classifier_metrics")
def classifier_metrics(spark, sf):
    df = catalog_table(spark, sf)
    table_ = written(features.fit(df).transform(df), "features")
    return models.train_and_test(table_)[1]


@query("classifier_probability")
def classifier_probability(spark, sf):
    df = catalog_table(spark, sf)
    table_ = written(features.fit(df).transform(df), "features")
    fitted, _ = models.train_and_test(table_)
    return fitted.probability(table_).select("product_id", "top_product_probability")


@query("train_and_score")
def train_and_score(spark, sf):
    return train_score.train_and_score(catalog_table(spark, sf))


@query("model_save_load")
def model_save_load(spark, sf):
    enriched = catalog_table(spark, sf)
    trained = train_score.train(enriched)
    path = scratch_path(spark, "models")
    artifacts.save_models(spark, trained.fitted, path)
    artifacts.save_metrics(trained.classifier_metrics, f"{path}/metrics")
    loaded = artifacts.load_models(spark, path)
    return train_score.shortlist(enriched, loaded.features.transform(enriched), loaded)


@query("random_forest_cross_validation")
def random_forest_cross_validation(spark, sf):
    df = catalog_table(spark, sf)
    table_ = written(features.fit(df).transform(df), "features")
    model, f1 = models.cross_validate_forest(table_)
    return spark.createDataFrame(
        [(model.getNumTrees, round(f1, 6))], "trees int, mean_f1 double"
    )


@query("hierarchical_clusters")
def hierarchical_clusters(spark, sf):
    table_ = written(features.add_reviews(prepared(spark, sf)[0]), "prepared")
    return models.hierarchical_clusters(table_).groupBy("cluster_id").agg(
        F.count("*").alias("products"), F.round(F.avg("price"), 4).alias("avg_price")
    )
