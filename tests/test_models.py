import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from shelfwise.operators import features, kmeans, models, scoring
from shelfwise.plans import train_score
from shelfwise.registry.data import catalog_table
from shelfwise.sources import artifacts


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_silhouette_equals_plain_loop(spark, block_rows):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    labels = rng.integers(0, 3, 60)
    labels[0] = 9
    x[20:40], labels[20:40] = x[1], labels[1]
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "id bigint, x array<double>, c int")
    got = models.silhouette(df, F.col("x"), "c", block_rows).first()
    assert got["silhouette_score"] == pytest.approx(brute_silhouette(x, labels))
    assert got["n_samples"] == 60


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaler = models.fit_scaler(df, ("a", "b"))
    assert scaler.deviations == (pytest.approx(np.std([1, 2, 3, 4])), 1.0)
    assert [r[0] for r in df.select(scaler.scaled("b")).collect()] == [0.0] * 4


def test_confusion_of_nothing(spark):
    df = spark.createDataFrame([], "y int, p int")
    row = models.confusion(df, F.col("y"), F.col("p")).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (0.0,) * 4


def test_nearest_centre_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame([(0.0,), (0.9,), (1.0,), (5.0,)], "x double")
    got = df.select(models.nearest_centre([F.col("x")], [[0.0], [2.0], [5.0]])).collect()
    assert [r[0] for r in got] == [0, 0, 0, 2]


@pytest.fixture(scope="module")
def trained(spark):
    enriched = catalog_table(spark, "/root/testdata/sf0.001")
    return enriched, train_score.train(enriched, trees=5, restarts=3)


def test_training_and_scoring(spark, trained):
    enriched, t = trained
    rows = train_score.score(t.features, t.fitted)
    n = rows.count()
    assert n == enriched.count()
    assert rows.where("top_product_probability between 0 and 1").count() == n
    assert {r[0] for r in rows.select("cluster_id").distinct().collect()} == {0, 1, 2}
    assert 0 < t.fitted.segmenter.variance_share <= 1
    metrics = t.classifier_metrics.first()
    assert metrics["test_samples"] == 40 and metrics["accuracy"] > 0.7
    top = train_score.shortlist(enriched, t.features, t.fitted, 10).collect()
    assert len(top) == 10 and len({r["product_id"] for r in top}) == 10


def test_segment_metrics(spark, trained):
    _, t = trained
    for metric in ("euclidean", "squaredEuclidean"):
        row = models.segment_metrics(t.features, t.fitted.segmenter, metric=metric).first()
        assert (row["n_clusters"], row["n_samples"]) == (3.0, 200.0)
        assert -1 <= row["silhouette_score"] <= 1


def test_assignment_equals_the_fitted_models(spark, trained):
    _, t = trained
    seg = t.fitted.segmenter
    mine = seg.assign(t.features)
    columns = list(seg.scaler.columns)
    rows = mine.select("cluster_id", *[seg.scaler.scaled(c).alias(c) for c in columns]).toPandas()
    gaps = rows[columns].to_numpy()[:, None, :] - np.array(seg.centres)[None]
    assert ((gaps**2).sum(axis=2).argmin(axis=1) == rows["cluster_id"]).all()
    for component in seg.loadings:
        assert max(component, key=abs) > 0


def test_restarts_keep_the_lowest_cost(spark, trained):
    _, t = trained
    scaler = t.fitted.segmenter.scaler
    scaled = F.array(*[scaler.scaled(c) for c in scaler.columns])
    vectors = t.features.select(scaled.alias("scaled"))
    one = models.fit_kmeans(vectors, restarts=1).cost
    best = models.fit_kmeans(vectors)
    assert best.cost <= one + 1e-9
    # Not above the best of as many fits by the library, one after the other.
    dense = t.features.select(scaler.vector().alias("scaled")).cache()
    fits = [
        KMeans(k=3, maxIter=300, featuresCol="scaled", seed=42 + i).fit(dense).summary.trainingCost
        for i in range(10)
    ]
    assert best.cost <= min(fits) * (1 + 1e-9)


def test_centres_are_the_means_of_their_points(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 0.3, (80, 2)) for m in ((0, 0), (4, 0), (0, 5), (6, 6))])
    df = spark.createDataFrame([(p.tolist(),) for p in x], "v array<double>").repartition(5)
    got = kmeans.fit(df, "v", 4, 5, 300, 1)
    centres = np.array(got.centres)
    squares = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    own = squares.argmin(axis=1)
    assert sorted(np.bincount(own)) == [80] * 4
    assert np.allclose(centres, [x[own == i].mean(axis=0) for i in range(4)])
    assert got.cost == pytest.approx(squares.min(axis=1).sum())


def test_kmeans_of_few_points(spark):
    df = spark.createDataFrame([([1.0],)] * 7 + [([3.0],), (None,)], "v array<double>")
    got = kmeans.fit(df, "v", 4, 3, 300, 1)
    assert got.cost == 0 and {c[0] for c in got.centres} == {1.0, 3.0} and len(got.centres) == 4
    with pytest.raises(ValueError, match="no rows"):
        kmeans.fit(df.limit(0), "v", 2, 1, 10, 1)


def test_saved_models_score_alike(spark, trained, tmp_path):
    enriched, t = trained
    artifacts.save_models(spark, t.fitted, str(tmp_path / "m"))
    loaded = artifacts.load_models(spark, str(tmp_path / "m"))
    a = train_score.score(t.features, t.fitted).select("product_id", F.round("final_score", 9))
    b = train_score.score(loaded.features.transform(enriched), loaded).select(
        "product_id", F.round("final_score", 9)
    )
    assert a.exceptAll(b).isEmpty()


def test_final_score(spark):
    row = (0.5, 2.0, 4.0, 100.0, 1)
    df = spark.createDataFrame(
        [row], "top_product_probability double, cluster_quality_score double, rating double,"
        "reviews double, stock_in_stock int",
    )
    want = 0.5 * 0.6 + 2.0 * 0.15 + 4.0 * 0.15 + 100.0 * 0.05 + 0.05
    assert scoring.add_final_score(df).first()["final_score"] == pytest.approx(want)
    without = scoring.add_final_score(df.drop("stock_in_stock")).first()
    assert without["final_score"] == pytest.approx(want - 0.05)
    with pytest.raises(ValueError):
        scoring.add_final_score(df, normalize="rank")


def test_missing_record_keeps_the_id(spark):
    ranked = spark.createDataFrame([("1", 9.0), ("2", 8.0)], "product_id string, final_score double")
    products = spark.createDataFrame([("1", "Mug")], "product_id string, name string")
    got = {r["product_id"]: r["name"] for r in scoring.attach_products(ranked, products).collect()}
    assert got == {"1": "Mug", "2": None}


def test_tool_arguments(spark):
    df = spark.createDataFrame([("1", "x", 1)], "product_id string, final_score string, cluster_id int")
    df = df.withColumns({"price": F.lit("9"), "rating": F.lit("n/a")})
    for bad in (0, 201, True, "5"):
        with pytest.raises(ValueError):
            scoring.top_products(df, bad)
    for bad in (-1, True, "1", 5):
        with pytest.raises(ValueError):
            scoring.cluster_summary(df, bad)
    row = scoring.cluster_summary(df, 1).first()
    assert (row["avg_price"], row["avg_rating"], row["price_samples"], row["rating_samples"]) == (9.0, None, 1, 0)


def test_no_cluster_scores_zero(spark):
    df = spark.createDataFrame([(1, 4.0, 10.0), (None, 1.0, 1.0)], "cluster_id int, rating double, reviews double")
    got = {r["cluster_id"]: r["cluster_quality_score"] for r in scoring.add_cluster_quality(df).collect()}
    assert got == {1: pytest.approx(5.8), None: 0.0}


def test_leaky_columns_can_be_left_out(spark, trained):
    _, t = trained
    fitted = models.fit_classifier(t.features, trees=2, exclude_leaky=True)
    assert "rating" not in fitted.columns and "price" in fitted.columns


def test_features_by_model_have_fixed_columns(spark, trained):
    enriched, t = trained
    one_row = t.fitted.features.transform(enriched.limit(1))
    assert one_row.columns == t.features.columns
    assert isinstance(t.fitted.features, features.FeatureModel)
