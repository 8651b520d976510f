import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import features, quantiles, split
from shelfwise.operators.skew import hot_keys, join_split_hot

SETTINGS = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@SETTINGS
@given(
    st.lists(
        st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=60
    ),
    st.sampled_from([0.0, 0.3, 0.5, 0.7, 1.0]),
)
def test_quantiles_by_narrowing(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {"v": (F.col("v"), q)}
    got = quantiles.exact_quantiles(df, wanted, bins=4)["v"]
    assert got == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-12)
    assert got == pytest.approx(quantiles.exact_quantiles(df, wanted)["v"], rel=1e-9, abs=1e-9)


def test_kth_values_with_a_dominant_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id")).alias("v"))
    values = sorted(5.0 if i % 3 == 0 else float(i) for i in range(3000))
    ranks = [0, 3, 500, 1003, 2999, 3000]
    wanted = {f"r{r}": (F.col("v"), r) for r in ranks}
    got = quantiles.kth_values(df, wanted, bins=8)
    assert [got[f"r{r}"] for r in ranks] == [values[r] if r < 3000 else None for r in ranks]


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, {"v": (F.col("v"), 0.5)}) == {"v": None}


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0, float("inf")],
        [-float("inf"), -1e308, -1.0, 0.0, 5e-324, 1e308, float("inf"), float("inf")],
        [7.0] * 400 + [float(i) for i in range(800)],
        [2.0**k for k in range(-1000, 1000, 7)],
    ],
)
def test_ranks_of_wide_ranges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {f"r{r}": (F.col("v"), r) for r in range(0, len(values), max(1, len(values) // 9))}
    got = quantiles.kth_values(df, wanted)
    ordered = sorted(values)
    assert all(got[f"r{r}"] == ordered[r] for _, r in wanted.values())
    middle = quantiles.exact_quantiles(df, {"v": (F.col("v"), 1.0)})["v"]
    assert middle == ordered[-1]


@pytest.mark.parametrize("most", [50_000, 40])
def test_ranks_in_two_passes_or_by_bins(spark, monkeypatch, most):
    """A few values between two of the grid are counted one by one, many in bins; both are exact."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", most)
    reads = []
    counted = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: reads.append(a) or counted(*a))
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(0, 3, 20_000), np.full(10_000, 1.5), -rng.random(5000)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "v double").repartition(6)
    ranks = [0, 1, 4999, 5000, 17_000, 26_250, 34_998, 34_999, 35_000]
    got = quantiles.kth_values(df, {f"r{r}": (F.col("v"), r) for r in ranks}, bins=64)
    ordered = np.sort(values)
    assert [got[f"r{r}"] for r in ranks] == [*(ordered[r] for r in ranks[:-1]), None]
    assert len(reads) == 1 if most == 50_000 else len(reads) > 1


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(quantiles._Profile, "bracket", lambda self, rank: (self.grid[400], self.grid[450]))
    df = spark.range(2000).select(F.col("id").cast("double").alias("v"))
    got = quantiles.kth_values(df, {"a": (F.col("v"), 3), "b": (F.col("v"), 1999)})
    assert got == {"a": 3.0, "b": 1999.0}


CATALOG = (
    "product_id string, price string, promotional_price string, rating string,"
    "review_count string, stock_status string, standardized_category string"
)


def test_fill_and_discount(spark):
    rows = [
        ("1", "100", "75", "4", "10", "In_Stock", "Home"),
        ("2", "abc", None, None, "x", None, None),
        ("3", "0", "0", "2", "3.9", "out_of_stock", "Health"),
        ("4", "50", "80", "nan", "1", "in_stock", "Home"),
    ]
    df = spark.createDataFrame(rows, CATALOG)
    model = features.fit(df)
    assert model.medians == features.Medians(3.0, 50.0)
    got = {r["product_id"]: r for r in model.prepare(df).collect()}
    assert (got["2"]["price"], got["2"]["promotional_price"], got["2"]["rating"]) == (50.0, 50.0, 3.0)
    assert (got["2"]["stock_status"], got["2"]["standardized_category"]) == ("unknown", "Unknown")
    assert [got[i]["is_in_stock"] for i in "1234"] == [1, 0, 0, 1]
    assert [got[i]["discount_ratio"] for i in "1234"] == [0.25, 0.0, 0.0, 0.0]
    assert [got[i]["review_count"] for i in "1234"] == [10, 0, 3, 1]
    encoded = model.transform(df)
    assert {"cat_Home", "cat_Health", "cat_Unknown", "stock_unknown"} <= set(encoded.columns)
    assert "stock_status" not in encoded.columns
    assert features.FeatureModel.from_json(model.to_json()) == model


def test_narrowing_fits_the_same_model(spark, sf):
    from shelfwise.registry.data import catalog_table

    df = catalog_table(spark, sf)
    a, b = features.fit(df), features.fit(df.repartition(3))
    assert a.medians.price == pytest.approx(b.medians.price)
    assert a.cuts.discount == pytest.approx(b.cuts.discount)
    assert a.vocabulary == b.vocabulary


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12, 13, 40])
def test_fallback_labels_pick_an_exact_number(spark, n):
    rows = [(str(i), "10", None, str(i % 3), "0", "out_of_stock", "Home") for i in range(n)]
    df = spark.createDataFrame(rows, CATALOG)
    labels = features.fit(df).prepare(df)
    assert labels.agg(F.sum("is_top_product")).first()[0] == features.fallback_size(n)
    best = labels.where("is_top_product = 1").agg(F.min("rating")).first()[0]
    rest = labels.where("is_top_product = 0").agg(F.max("rating")).first()[0]
    assert best >= rest


def test_fallback_size_rounds_half_to_even():
    assert [features.fallback_size(n) for n in (2, 3, 4, 5, 12, 13, 100)] == [1, 1, 2, 2, 2, 3, 20]


def test_matrix_leaves_names_and_leaks_out(spark):
    df = spark.createDataFrame(
        [("1", "n", 1.0, 2, True, None, 1)],
        "product_id string, name string, price double, review_count int, flag boolean,"
        "cat_A int, is_top_product int",
    )
    assert features.matrix_columns(df) == ["price", "review_count", "flag", "cat_A"]
    assert features.matrix_columns(df, exclude_leaky=True) == ["price", "flag", "cat_A"]
    assert features.feature_matrix(df).first().asDict() == {"price": 1.0, "review_count": 2.0, "flag": 1.0, "cat_A": 0.0}


@SETTINGS
@given(st.integers(0, 60), st.integers(0, 60))
def test_split_sizes(zeros, ones):
    counts = {c: n for c, n in ((0, zeros), (1, ones)) if n}
    if not counts:
        return
    sizes = split.test_sizes(counts)
    rows = sum(counts.values())
    assert sum(sizes.values()) == math.ceil(rows * 0.2)
    assert all(abs(sizes[c] - math.ceil(rows * 0.2) * n / rows) < 1 for c, n in counts.items())


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("product_id"), (F.col("id") % 10 == 0).cast("int").alias("y")
    )
    flagged = split.with_test_flag(df, "y")
    got = {r["y"]: r["n"] for r in flagged.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 180, 1: 20}
    again = split.with_test_flag(df.repartition(7), "y")
    assert flagged.exceptAll(again).count() == 0


def test_split_without_stratification(spark):
    df = spark.createDataFrame([(str(i), int(i == 0)) for i in range(10)], "product_id string, y int")
    assert split.with_test_flag(df, "y").where("is_test").count() == 2


def test_training_guards(spark):
    one = spark.createDataFrame([(1.0, 1)], "x double, y int")
    with pytest.raises(ValueError, match="two classes"):
        split.check_trainable(one, "y", ["x"])
    with pytest.raises(ValueError, match="not found"):
        split.check_trainable(one, "z", ["x"])
    with pytest.raises(ValueError, match="no numeric"):
        split.check_trainable(one, "y", [])
    with pytest.raises(ValueError, match="empty"):
        split.check_trainable(one.where("false"), "y", ["x"])
    with pytest.raises(ValueError, match="at least 4"):
        split.check_clusterable(one, ("x",))
    with pytest.raises(ValueError, match="missing"):
        split.check_clusterable(one, ("price",))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(spark.createDataFrame([(1, 77)], "k bigint, w bigint"))
    got = join_split_hot(left, right, "k", how, hot_rows=100)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_keys(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("id").cast("string")).alias("k"))
    assert hot_keys(df, "k", 1000) == ["a"]
    assert hot_keys(df, "k") == []
    assert hot_keys(df.where("false"), "k") == []
