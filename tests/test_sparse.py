from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from shelfwise.operators import features, sparse

COLUMNS = ["standardized_category", "stock_status"]


def test_vectors_equal_the_columns(spark):
    rows = [(i, c, s) for i, (c, s) in enumerate(
        [("Home", "in_stock"), ("home", "In_Stock"), ("Health", "unknown"), ("Toys, big", "in_stock")]
    )]
    df = spark.createDataFrame(rows, "id int, standardized_category string, stock_status string")
    vocabulary = sparse.fit_vocabulary(df, COLUMNS)
    got = {r.id: r for r in sparse.one_hot_vectors(df, vocabulary, COLUMNS).collect()}
    known = features.fit_vocabulary(df)
    wide = {r["id"]: r for r in features.one_hot(df, known).collect()}
    for i, row in wide.items():
        assert got[i].standardized_category_vector.toArray().tolist() == [row[f"cat_{v}"] for v in sorted(known.categories, key=str.lower)]
        assert got[i].stock_status_vector.toArray().tolist() == [row[f"stock_{v}"] for v in sorted(known.stock, key=str.lower)]


def test_null_and_unknown_values_have_no_entry(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, c string")
    vocabulary = sparse.fit_vocabulary(df, ["c"])
    new = spark.createDataFrame([(1, "B"), (2, None), (3, "zzz")], "id int, c string")
    got = {r.id: r.c_vector for r in sparse.one_hot_vectors(new, vocabulary, ["c"]).collect()}
    assert [got[i].toArray().tolist() for i in (1, 2, 3)] == [[0, 1], [0, 0], [0, 0]]
    none = sparse.fit_vocabulary(df.limit(0), ["c"])
    empty = sparse.one_hot_vectors(new, none, ["c"]).collect()
    assert {(r.c_vector.size, r.c_vector.numNonzeros()) for r in empty} == {(1, 0)}


def test_many_categories_fit_and_apply(spark, monkeypatch):
    """100,000 categories, a third of all rows in one of them, in several ranges."""
    monkeypatch.setattr(sparse, "RANGE_ROWS", 30_000)
    n = 150_000
    value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.lpad((F.col("id")).cast("string"), 7, "0")))
    df = spark.range(n).select("id", value.alias("c"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    vocabulary = sparse.fit_vocabulary(df, ["c"])
    values = [r["value"] for r in vocabulary.orderBy("index").collect()]
    assert len(values) == 100_001 and values == sorted(values)
    assert vocabulary.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first() == (0, 100_000, 100_001)
    rows = sparse.feature_vectors(sparse.one_hot_vectors(df, vocabulary, ["c"]), ["id"], ["c_vector"])
    row = rows.where("id = 4").first()
    assert row.features.size == 100_002 and row.features.numNonzeros() == 2
    assert row.features[1 + values.index("c0000004")] == 1
    model = LogisticRegression(maxIter=2, featuresCol="c_vector").fit(rows.select("c_vector", "label").limit(2000))
    assert model.numFeatures == 100_001
