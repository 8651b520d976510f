"""From enriched products to fitted models and the ranked shortlist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfwise.operators import features, models, scoring
from shelfwise.session import written
from shelfwise.sources.artifacts import Fitted



@dataclass
class Trained:
    fitted: Fitted
    features: DataFrame
    classifier_metrics: DataFrame


def train(
    enriched: DataFrame,
    *,
    trees: int = models.TREES,
    restarts: int = models.RESTARTS,
    iterations: int = models.ITERATIONS,
    exclude_leaky: bool = False,
) -> Trained:
    """Fit features, classifier and segmenter. The feature table is written once and read
    by all fits."""
    feature_model = features.fit(enriched)
    table = written(feature_model.transform(enriched), "features")
    classifier, metrics = models.train_and_test(
        table, trees=trees, exclude_leaky=exclude_leaky
    )
    segmenter = models.fit_segmenter(table, restarts=restarts, iterations=iterations)
    return Trained(Fitted(feature_model, classifier, segmenter), table, metrics)


def score(feature_table: DataFrame, fitted: Fitted, normalize: str | None = None) -> DataFrame:
    """Every row with probability, cluster, projection, cluster quality and final score."""
    if "reviews" not in feature_table.columns:
        feature_table = features.add_reviews(feature_table)
    with_probability = fitted.classifier.probability(feature_table)
    assigned = fitted.segmenter.assign(with_probability)
    return scoring.add_final_score(
        scoring.add_cluster_quality(assigned), normalize=normalize
    )


def shortlist(
    enriched: DataFrame,
    feature_table: DataFrame,
    fitted: Fitted,
    k: int = scoring.TOP_K,
    normalize: str | None = None,
) -> DataFrame:
    """The k best products with their full record."""
    ranked = written(scoring.top_k(score(feature_table, fitted, normalize), k), "ranked")
    return scoring.attach_products(ranked, enriched)


def train_and_score(enriched: DataFrame, k: int = scoring.TOP_K, **params) -> DataFrame:
    trained = train(enriched, **params)
    return shortlist(enriched, trained.features, trained.fitted, k)


