"""Work that must not grow: payloads parsed once, bounded files, blocks and Python rows."""

import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import catalog, cells, enrichment, models
from shelfwise.registry import enrichment as lots
from shelfwise.registry import payloads
from shelfwise.schemas import WOO_PRODUCT
from shelfwise.session import dealt
from shelfwise.streaming import emerging


def test_variants_parse_a_payload_once(spark, sf):
    for query in (payloads.shopify_variants, payloads.woo_variants):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_few_payloads_are_read_for_their_keys(spark):
    texts = ['{"id": "1", "name": "a", "review_count": 1, "variations": []}',
             '{"id": "2", "name": "a", "review_count": 1, "variations": [], "prices": null}',
             '{"id": "3", "name": "a", "review_count": 1, "variations": [], "pr\\u0069ces": null}']
    raw = spark.createDataFrame([("woocommerce", "s", 1, i, t) for i, t in enumerate(texts)], "platform string, store string, page int, pos int, raw string")
    parsed = catalog._parsed(raw, WOO_PRODUCT, catalog.WOO_NOT_NULL)
    assert [r["keys"] is None for r in parsed.orderBy("pos").collect()] == [True, False, False]
    got = catalog.map_woo(raw).orderBy("pos").collect()
    assert [r["reasons"] for r in got] == ["", "prices_null", "prices_null"]


def test_distances_by_products_equal_those_by_differences():
    rng = np.random.default_rng(3)
    a = rng.normal(1e3, 1.0, (40, 5))
    b = np.concatenate([a[:20], a[20:] + 1e-9, rng.normal(1e3, 1.0, (30, 5))])
    want = np.sqrt(((a[:, None, :] - b) ** 2).sum(axis=2))
    assert np.allclose(models._distances(a, b), want, rtol=1e-10, atol=0)


def test_blocks_meet_once(spark):
    rng = np.random.default_rng(4)
    rows = [(rng.normal(c, 1.0, 3).tolist(), c) for c in (0, 1, 5) for _ in range(20)] * 2
    df = spark.createDataFrame(rows, "x array<double>, c int")
    x, c = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    gap = np.sqrt(((x[:, None, :] - x) ** 2).sum(axis=2))
    sums = np.stack([gap[:, c == k].sum(axis=1) for k in (0, 1, 5)], axis=1)
    own = np.searchsorted([0, 1, 5], c)
    a = sums[np.arange(len(c)), own] / 39
    sums[np.arange(len(c)), own] = np.inf
    b = (sums / 40).min(axis=1)
    want = ((b - a) / np.maximum(a, b)).mean()
    got = models.silhouette(df, F.col("x"), "c", block_rows=7).first()
    assert abs(got["silhouette_score"] - want) < 1e-12 and got["n_samples"] == 120


def test_products_are_held_in_slices(spark, monkeypatch):
    monkeypatch.setattr(enrichment, "HELD_ROWS", 7)
    df = spark.range(1000).select(F.col("id").cast("string").alias("product_id"), *(
        F.lit(None).cast(f.dataType).alias(f.name) for f in enrichment.PRODUCT if f.name != "product_id"))
    found = enrichment.enrich_with(df.coalesce(1), lambda row: {"short_summary": row["product_id"]}, attempts=1)
    assert {r.product_id for r in found.where("short_summary = product_id").collect()} == {str(i) for i in range(1000)}


def test_files_of_a_lot_grow_with_the_documents(spark, tmp_path, monkeypatch):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for i in range(13):
        rows = [(i, f"text {i}", "en", "web", 7)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    files = []
    write = lots.tables.write_json
    monkeypatch.setattr(lots.tables, "write_json", lambda df, path: (files.append(df.rdd.getNumPartitions()), write(df, path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert lots.incremental_enrichment(spark, str(tmp_path)).count() == 13
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files[0] > 3 and files[0] % 3 == 0


def test_emerging_state_needs_no_python(spark):
    stream = spark.readStream.format("rate").load().select(
        F.lit("a").alias("product"), F.col("timestamp").alias("week_end"),
        F.lit(1).alias("records"), F.lit(2).alias("cents"))
    plan = emerging.closed_weeks(stream)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "InPandasWithState" not in plan


def test_partitions_grow_with_the_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert dealt(df, "k", rows=5).rdd.getNumPartitions() == 20
    assert dealt(df, "k").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_comparisons_of_cells_are_dealt_by_points(spark, monkeypatch):
    monkeypatch.setattr(cells, "TASK_POINTS", 3)
    rows = [(i, [i % 7], 1, float(i)) for i in range(60)]
    points = spark.createDataFrame(rows, "point int, cell array<bigint>, parts int, x double")
    near = points.select("cell", F.col("cell").alias("other"), "parts").distinct()
    met = cells.compared(points.select("point", "cell", "x"), near, points)
    assert met.rdd.getNumPartitions() == 20
    assert met.count() == sum(1 for a in range(60) for b in range(60) if a % 7 == b % 7)


def test_points_of_one_file_are_dealt_to_all_cores(spark, monkeypatch):
    from pyspark.sql import functions as F

    from shelfwise.operators import kmeans

    taken = []
    real = kmeans._summed

    def summed(points, *rest):
        taken.append(len(points.select(F.input_file_name()).distinct().collect()))
        return real(points, *rest)

    monkeypatch.setattr(kmeans, "_summed", summed)
    df = spark.range(0, 120_000, 1, 1).select(F.array((F.col("id") % 2 * 5.0), F.lit(1.0)).alias("v"))
    got = kmeans.fit(df, "v", 2, 2, 20, 7)
    assert set(taken) == {spark.sparkContext.defaultParallelism}
    assert sorted(got.centres) == [[0.0, 1.0], [5.0, 1.0]] and got.cost == 0.0
