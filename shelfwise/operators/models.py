"""Classifier, clustering and projection: fits with ``pyspark.ml`` and their application."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import kmeans
from shelfwise.operators.features import matrix_columns
from shelfwise.operators.split import check_clusterable, check_trainable, with_test_flag
from shelfwise.schemas import CLUSTER_INPUTS
from shelfwise.session import checked_broadcast, written

# Parameters of the boosted trees and of the clustering.
TREES = 200
TREE_DEPTH = 5
LEARNING_RATE = 0.05
ROW_SHARE = 0.9
COLUMN_SHARE = 0.9
SEED = 42
CLUSTERS = 3
RESTARTS = 10
ITERATIONS = 300


# --- Classifier ----------------------------------------------------------------------


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Feature vector of ``columns`` (null as 0), beside the given columns."""
    matrix = {
        f"f_{i}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
        for i, c in enumerate(columns)
    }
    return (
        VectorAssembler(inputCols=list(matrix), outputCol=out)
        .transform(df.withColumns(matrix))
        .drop(*matrix)
    )


@dataclass
class Classifier:
    model: GBTClassificationModel
    columns: list[str]

    def probability(self, df: DataFrame, out: str = "top_product_probability") -> DataFrame:
        """Add the probability of class 1."""
        scored = self.model.transform(assemble(df, self.columns))
        return scored.withColumn(out, vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )


def fit_classifier(
    df: DataFrame,
    label: str = "is_top_product",
    *,
    trees: int = TREES,
    depth: int = TREE_DEPTH,
    exclude_leaky: bool = False,
) -> Classifier:
    """Boosted trees on the numeric columns of ``df``."""
    columns = [c for c in matrix_columns(df, exclude_leaky) if c not in (label, "is_test")]
    check_trainable(df, label, columns)
    data = assemble(df, columns).select("features", F.col(label).cast("double").alias("label"))
    model = GBTClassifier(
        maxIter=trees,
        maxDepth=depth,
        stepSize=LEARNING_RATE,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=str(COLUMN_SHARE),
        seed=SEED,
    ).fit(data)
    return Classifier(model, columns)


def confusion(df: DataFrame, label: Column, prediction: Column) -> DataFrame:
    """Confusion counts and the four ratios, one row; an empty denominator gives 0."""
    counts = df.agg(
        F.count_if((label == 0) & (prediction == 0)).alias("true_negative"),
        F.count_if((label == 0) & (prediction == 1)).alias("false_positive"),
        F.count_if((label == 1) & (prediction == 0)).alias("false_negative"),
        F.count_if((label == 1) & (prediction == 1)).alias("true_positive"),
    )
    tn, fp = F.col("true_negative"), F.col("false_positive")
    fn, tp = F.col("false_negative"), F.col("true_positive")

    def ratio(over: Column, under: Column) -> Column:
        return F.coalesce(F.try_divide(over.cast("double"), under), F.lit(0.0))

    return counts.select(
        "*",
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        (tn + fp + fn + tp).alias("test_samples"),
    )


def train_and_test(
    df: DataFrame, label: str = "is_top_product", id_column: str = "product_id", **params
) -> tuple[Classifier, DataFrame]:
    """Fit on the training side of the split; metrics of the test side as one row."""
    flagged = with_test_flag(df, label, id_column)
    fitted = fit_classifier(flagged.where("not is_test"), label, **params)
    tested = fitted.probability(flagged.where("is_test"))
    predicted = (F.col("top_product_probability") > 0.5).cast("int")
    return fitted, confusion(tested, F.col(label), predicted)


def cross_validate_forest(
    df: DataFrame,
    label: str = "is_top_product",
    *,
    trees: int = 100,
    depth: int = TREE_DEPTH,
    folds: int = 5,
    exclude_leaky: bool = False,
) -> tuple[RandomForestClassificationModel, float]:
    """A random forest on all rows and its mean F1 score over ``folds`` folds."""
    columns = [c for c in matrix_columns(df, exclude_leaky) if c not in (label, "is_test")]
    check_trainable(df, label, columns)
    data = assemble(df, columns).select("features", F.col(label).cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED)
    fitted = CrossValidator(
        estimator=forest,
        estimatorParamMaps=[{}],
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=folds,
        seed=SEED,
    ).fit(data)
    return fitted.bestModel, float(fitted.avgMetrics[0])


# --- Scaling, clustering, projection -------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column (0 deviation counts as 1)."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def scaled(self, column: str) -> Column:
        i = self.columns.index(column)
        value = F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))
        return (value - self.means[i]) / self.deviations[i]

    def vector(self) -> Column:
        return array_to_vector(F.array(*[self.scaled(c) for c in self.columns]))


def fit_scaler(df: DataFrame, columns: tuple[str, ...] = CLUSTER_INPUTS) -> Scaler:
    numbers = [F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns]
    row = df.agg(
        *[F.avg(v) for v in numbers], *[F.stddev_pop(v) for v in numbers]
    ).first()
    k = len(columns)
    return Scaler(tuple(columns), tuple(row[:k]), tuple(d or 1.0 for d in row[k:]))


def fit_kmeans(
    vectors: DataFrame,
    k: int = CLUSTERS,
    restarts: int = RESTARTS,
    iterations: int = ITERATIONS,
) -> kmeans.KMeansFit:
    """The restart with the lowest cost; ``vectors`` has an array column ``scaled``."""
    return kmeans.fit(vectors, "scaled", k, restarts, iterations, SEED)


def nearest_centre(coordinates: list[Column], centres: list[list[float]]) -> Column:
    """Index of the centre with the smallest squared distance (the first on a tie)."""
    distances = []
    for centre in centres:
        d = F.lit(0.0)
        for x, c in zip(coordinates, centre, strict=True):
            d = d + (x - F.lit(float(c))) * (x - F.lit(float(c)))
        distances.append(d)
    smallest = F.least(*distances) if len(distances) > 1 else distances[0]
    out = F.lit(0)
    for i in reversed(range(len(centres))):
        out = F.when(distances[i] == smallest, i).otherwise(out)
    return out.cast("int")


def project(coordinates: list[Column], loadings: list[list[float]]) -> list[Column]:
    """One column per component: the sum of coordinate times loading."""
    out = []
    for component in loadings:
        total = F.lit(0.0)
        for x, w in zip(coordinates, component, strict=True):
            total = total + x * F.lit(float(w))
        out.append(total)
    return out


def oriented_loadings(model: PCAModel) -> list[list[float]]:
    """Loadings per component, the largest in size made positive."""
    columns = np.asarray(model.pc.toArray()).T
    return [list(map(float, c * np.sign(c[np.argmax(np.abs(c))]))) for c in columns]


@dataclass
class Segmenter:
    """Scaler, cluster centres and projection; applying them is a map over the rows."""

    scaler: Scaler
    centres: list[list[float]]
    loadings: list[list[float]]
    variance_share: float
    pca: PCAModel | None = None

    def assign(self, df: DataFrame) -> DataFrame:
        """Add cluster_id, pca_1 and pca_2."""
        x = [self.scaler.scaled(c) for c in self.scaler.columns]
        parts = project(x, self.loadings)
        return df.withColumns(
            {"cluster_id": nearest_centre(x, self.centres)}
            | {f"pca_{i + 1}": p for i, p in enumerate(parts)}
        )


def fit_segmenter(
    df: DataFrame,
    columns: tuple[str, ...] = CLUSTER_INPUTS,
    *,
    k: int = CLUSTERS,
    restarts: int = RESTARTS,
    iterations: int = ITERATIONS,
    components: int = 2,
) -> Segmenter:
    """Scaler, k-means and PCA on three columns of ``df``; the vectors are written once."""
    check_clusterable(df, columns)
    scaler = fit_scaler(df, columns)
    scaled = F.array(*[scaler.scaled(c) for c in scaler.columns])
    vectors = written(df.select(scaled.alias("scaled")), "scaled")
    fitted = fit_kmeans(vectors, k, restarts, iterations)
    dense = vectors.select(array_to_vector("scaled").alias("scaled"))
    pca = PCA(k=components, inputCol="scaled", outputCol="projected").fit(dense)
    return Segmenter(
        scaler,
        fitted.centres,
        oriented_loadings(pca),
        float(sum(pca.explainedVariance)),
        pca,
    )


def hierarchical_clusters(
    df: DataFrame, columns: tuple[str, ...] = CLUSTER_INPUTS, k: int = CLUSTERS
) -> DataFrame:
    """Add ``cluster_id`` from top-down splits of the scaled columns."""
    check_clusterable(df, columns)
    scaler = fit_scaler(df, columns)
    vectors = df.withColumn("scaled", scaler.vector())
    model = BisectingKMeans(k=k, seed=SEED, featuresCol="scaled", predictionCol="cluster_id").fit(
        vectors.select("scaled")
    )
    return model.transform(vectors).drop("scaled")


# --- Cluster quality -----------------------------------------------------------------


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows by one matrix product; near pairs, where the squares
    would cancel out, by their differences."""
    if not (np.isfinite(a).all() and np.isfinite(b).all()):
        return np.stack([np.sqrt(((row - b) ** 2).sum(axis=1)) for row in a])
    middle = b.mean(axis=0)
    a, b = a - middle, b - middle
    sizes = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)
    squares = sizes - 2.0 * (a @ b.T)
    near, other = np.nonzero(squares < 1e-4 * sizes)
    for start in range(0, len(near), 50_000):
        i, j = near[start : start + 50_000], other[start : start + 50_000]
        gap = a[i] - b[j]
        squares[i, j] = (gap * gap).sum(axis=1)
    return np.sqrt(squares, out=squares)


def _block_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Per point and cluster: sum of distances to the cluster's rows in the other block.

    Two blocks meet once, and both sides get their sums; a block beside itself has one side.
    """
    columns = {"point": [], "cluster": [], "total": []}
    if len(left) and len(right):
        a = np.stack(left["x"].to_list()).astype(float)
        b = np.stack(right["x"].to_list()).astype(float)
        copies = [side["copies"].to_numpy(dtype=float) for side in (left, right)]
        names, own = zip(*(np.unique(side["cluster"], return_inverse=True) for side in (left, right)), strict=True)
        weights = []
        for n, at, c in zip(names, own, copies, strict=True):
            weights.append(np.zeros((len(at), len(n))))
            weights[-1][np.arange(len(at)), at] = c
        same = left["i"].iloc[0] == left["j"].iloc[0]
        back = np.zeros((len(b), len(names[0])))
        step = max(1, 4_000_000 // max(len(b), 1))
        forth = []
        for start in range(0, len(a), step):
            gap = _distances(a[start : start + step], b)
            forth.append(gap @ weights[1])
            if not same:
                back += gap.T @ weights[0][start : start + step]
        sides = [(left, names[1], np.concatenate(forth))]
        if not same:
            sides.append((right, names[0], back))
        for side, clusters, totals in sides:
            for k, cluster in enumerate(clusters):
                columns["point"].append(side["point"].to_numpy())
                columns["cluster"].append(np.full(len(side), cluster))
                columns["total"].append(totals[:, k])
    return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in columns.items()})


def silhouette(df: DataFrame, x: Column, cluster: str, block_rows: int = 8192) -> DataFrame:
    """Mean silhouette with plain Euclidean distance, one row.

    Equal points of a cluster are counted and taken once. The distances between all
    points are part of the definition, so the work grows with the square of the distinct
    points; ``squared_silhouette`` is the linear-time relative for large tables. Points
    are dealt to blocks of bounded size, and every two blocks meet once, in one numpy task
    that returns sums per point and cluster for both, never pairs.
    """
    counted = df.groupBy(x.alias("x"), F.col(cluster).alias("cluster")).agg(
        F.count("*").alias("copies")
    )
    # Written, so that the numbers given to the points stay the same.
    points = written(
        counted.withColumn("point", F.monotonically_increasing_id()), "silhouette-points"
    )
    blocks = max(1, -(-points.count() // block_rows))
    dealt = points.withColumn("block", F.pmod(F.xxhash64("point"), F.lit(blocks)))
    block = F.col("block")
    later = F.explode(F.sequence(block, F.lit(blocks - 1).cast("bigint"))).alias("j")
    earlier = F.explode(F.sequence(F.lit(0).cast("bigint"), block)).alias("i")
    values = ("point", "x", "cluster", "copies")
    left = dealt.select(block.alias("i"), later, *values)
    right = dealt.select(earlier, block.alias("j"), *values)
    sums = (
        left.groupBy("i", "j")
        .cogroup(right.groupBy("i", "j"))
        .applyInPandas(_block_sums, "point bigint, cluster int, total double")
        .groupBy("point", "cluster")
        .agg(F.sum("total").alias("total"))
    )
    sizes = checked_broadcast(
        points.groupBy("cluster").agg(F.sum("copies").alias("rows")).withColumn(
            "cluster", F.col("cluster").cast("int")
        )
    )
    own = F.col("cluster") == F.col("own")
    per_point = (
        sums.join(sizes, "cluster")
        .join(points.select("point", F.col("cluster").alias("own"), "copies"), "point")
        .groupBy("point")
        .agg(
            F.max("copies").alias("copies"),
            F.max(F.when(own, F.col("rows"))).alias("own_rows"),
            F.max(F.when(own, F.try_divide("total", F.col("rows") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("rows"))).alias("b"),
        )
    )
    value = F.when(F.col("own_rows") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return per_point.agg(
        (F.sum(value * F.col("copies")) / F.sum("copies")).alias("silhouette_score"),
        F.sum("copies").alias("n_samples"),
    )


def squared_silhouette(
    df: DataFrame, features: str = "scaled", cluster: str = "cluster_id"
) -> float:
    """Mean silhouette with squared Euclidean distance, in time linear in the rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(df)


def segment_metrics(
    df: DataFrame, segmenter: Segmenter, metric: str = "euclidean"
) -> DataFrame:
    """Silhouette, clusters, samples and variance share, one row."""
    assigned = segmenter.assign(df)
    scaler = segmenter.scaler
    if metric == "euclidean":
        x = F.array(*[scaler.scaled(c) for c in scaler.columns])
        base = silhouette(assigned, x, "cluster_id")
    else:
        vectors = assigned.withColumn("scaled", scaler.vector())
        score = squared_silhouette(vectors)
        base = vectors.agg(
            F.lit(score).alias("silhouette_score"), F.count("*").alias("n_samples")
        )
    return base.select(
        "silhouette_score",
        F.lit(float(len(segmenter.centres))).alias("n_clusters"),
        F.col("n_samples").cast("double").alias("n_samples"),
        F.lit(segmenter.variance_share).alias("pca_explained_variance_ratio_sum"),
    )


