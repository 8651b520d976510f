"""Fitted models and metrics on disk."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators.features import FeatureModel
from shelfwise.operators.models import Classifier, Scaler, Segmenter


@dataclass
class Fitted:
    features: FeatureModel
    classifier: Classifier
    segmenter: Segmenter


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()[0]


def save_models(spark: SparkSession, fitted: Fitted, path: str) -> None:
    seg = fitted.segmenter
    fitted.classifier.model.write().overwrite().save(f"{path}/classifier")
    seg.pca.write().overwrite().save(f"{path}/pca")
    numbers = {
        "columns": fitted.classifier.columns,
        "scaler": asdict(seg.scaler),
        "centres": seg.centres,
        "loadings": seg.loadings,
        "variance_share": seg.variance_share,
    }
    _write_text(spark, json.dumps(numbers), f"{path}/numbers")
    _write_text(spark, fitted.features.to_json(), f"{path}/features")


def load_models(spark: SparkSession, path: str) -> Fitted:
    numbers = json.loads(_read_text(spark, f"{path}/numbers"))
    return Fitted(
        FeatureModel.from_json(_read_text(spark, f"{path}/features")),
        Classifier(
            GBTClassificationModel.load(f"{path}/classifier"), numbers["columns"]
        ),
        Segmenter(
            Scaler(**{k: tuple(v) for k, v in numbers["scaler"].items()}),
            numbers["centres"],
            numbers["loadings"],
            numbers["variance_share"],
            PCAModel.load(f"{path}/pca"),
        ),
    )


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)
