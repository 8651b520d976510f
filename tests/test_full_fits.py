"""The registered queries fit the whole models, not smaller ones."""

import pytest

from shelfwise.operators import models
from shelfwise.registry import QUERIES, load

load()


class Stop(Exception):
    pass


def spy(monkeypatch, name):
    """Stop at the fit called ``name``; its arguments are kept."""
    seen = {}

    def taken(*args, **kwargs):
        seen.update(kwargs)
        raise Stop

    monkeypatch.setattr(models, name, taken)
    return seen


@pytest.mark.parametrize(
    "name", ["train_and_score", "model_save_load", "classifier_metrics", "classifier_probability"]
)
def test_queries_boost_all_trees(spark, sf, monkeypatch, name):
    seen = spy(monkeypatch, "GBTClassifier")
    with pytest.raises(Stop):
        QUERIES[name](spark, sf)
    assert seen["maxIter"] == 200


@pytest.mark.parametrize(
    "name", ["train_and_score", "model_save_load", "kmeans_clusters", "segment_metrics"]
)
def test_queries_cluster_with_all_restarts(spark, sf, monkeypatch, name):
    fit = models.fit_kmeans
    seen = []

    def taken(vectors, k, restarts, iterations):
        seen.append((restarts, iterations))
        raise Stop

    # The boosted trees come first in a training; two of them are enough here.
    boost = models.fit_classifier
    monkeypatch.setattr(models, "fit_classifier", lambda *a, **b: boost(*a, **b | {"trees": 2}))
    monkeypatch.setattr(models, "fit_kmeans", taken)
    with pytest.raises(Stop):
        QUERIES[name](spark, sf)
    assert seen == [(10, 300)] and fit.__defaults__ == (3, 10, 300)


def test_query_validates_the_whole_forest(spark, sf, monkeypatch):
    seen = spy(monkeypatch, "CrossValidator")
    with pytest.raises(Stop):
        QUERIES["random_forest_cross_validation"](spark, sf)
    assert seen["numFolds"] == 5 and seen["estimator"].getNumTrees() == 100
