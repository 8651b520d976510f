import itertools
import time
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text as texts
from shelfwise.operators import enrichment, history, report
from shelfwise.registry.enrichment import text_products
from shelfwise.streaming import incremental


def answer(row):
    if row["name"] == "bad":
        raise RuntimeError("service down")
    tags = ["a"] if row["name"] == "few" else ["a", "b", "c"]
    return {"standardized_category": "Home", "short_summary": row["name"], "extracted_tags": tags}


def named_products(spark, sf, names):
    ids = F.array(*[F.lit(n) for n in names])
    one = text_products(spark, sf).limit(1).drop("product_id", "name")
    return one.select("*", F.posexplode(ids).alias("i", "name")).withColumn(
        "product_id", F.col("i").cast("string")
    ).drop("i")


def test_service_errors_become_rows(spark, sf):
    products = named_products(spark, sf, ["ok", "bad", "few"])
    results = enrichment.enrich_with(products, answer, attempts=2, wait_seconds=0.0, concurrency=2)
    good, bad = enrichment.split_results(results)
    assert [r["name"] for r in good.collect()] == ["ok"]
    assert {r["product_id"]: r["error"] for r in bad.collect()} == {"1": "service down", "2": "tag_count"}
    summary = enrichment.run_summary(3, good, bad).first()
    assert tuple(summary) == (3, 1, 2)
    with pytest.raises(ValueError):
        enrichment.enrich_with(products, answer, concurrency=0)


def test_retries_until_it_works(spark, sf, tmp_path):
    marker = str(tmp_path / "calls")

    def flaky(row):
        with open(marker, "a") as f:
            f.write("x")
        if len(open(marker).read()) < 3:
            raise RuntimeError("busy")
        return answer(row)

    products = named_products(spark, sf, ["ok"])
    rows = enrichment.enrich_with(products, flaky, attempts=3, wait_seconds=0.0).collect()
    assert [r["error"] for r in rows] == [None]


def test_calls_in_flight(spark, sf, tmp_path):
    """Up to 15 calls at a time in a task, also across batches; rows are those of single calls."""
    log = tmp_path / "log"

    def slow(row):
        with open(log, "a") as f:
            f.write("+")
        time.sleep(0.05 if int(row["product_id"]) % 7 else 0.3)
        with open(log, "a") as f:
            f.write("-")
        if int(row["product_id"]) % 10 == 3:
            raise RuntimeError("no")
        return answer(row) | {"short_summary": row["product_id"]}

    products = named_products(spark, sf, ["ok"] * 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        many = enrichment.enrich_with(products, slow, attempts=1, concurrency=1, in_flight=15).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    open_calls = list(itertools.accumulate(1 if c == "+" else -1 for c in log.read_text()))
    assert max(open_calls) == 15 and open_calls[-1] == 0 and len(open_calls) == 200
    one = enrichment.enrich_with(products, slow, attempts=1, concurrency=1).collect()
    assert sorted(map(repr, many)) == sorted(map(repr, one))
    assert {r["short_summary"] for r in many} == {str(i) for i in range(100) if i % 10 != 3} | {None}
    with pytest.raises(ValueError):
        enrichment.enrich_with(products, slow, in_flight=0)


def test_pause_before_a_call(spark, sf):
    start = time.time()
    products = named_products(spark, sf, ["ok"] * 6)
    rows = enrichment.enrich_with(products, answer, concurrency=1, in_flight=2, pause_seconds=0.2).collect()
    assert len(rows) == 6 and time.time() - start >= 0.6


def test_rule_enrichment_satisfies_the_contract(spark, sf):
    enriched = enrichment.enrich_with_rules(text_products(spark, sf))
    good, bad = enrichment.split_results(enriched)
    assert good.count() + bad.count() == text_products(spark, sf).count()
    assert good.count() > 150


def test_categories(spark):
    rows = [("1", "A wireless phone charger"), ("2", "wool socks and a mug"), ("3", "nothing"), ("4", "mug socks")]
    df = spark.createDataFrame(rows, "product_id string, text string")
    got = enrichment.add_category(df, F.col("text")).collect()
    assert [r["standardized_category"] for r in got] == ["Electronics", "Apparel", "Unknown", "Apparel"]


def test_tags_do_not_depend_on_the_hot_split(spark):
    rows = [(str(i), "common " * 3 + f"word{chr(97 + i % 5)} rare{chr(97 + i)}") for i in range(20)]
    df = spark.createDataFrame(rows, "id string, text string")
    tf = enrichment.term_counts(df, "id", F.col("text"))
    a, b = (
        enrichment.term_weights(tf, "id", 20, share).select("id", "term", F.round("weight", 9))
        for share in (0.01, 2.0)
    )
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert enrichment.tags(df, "id", F.col("text"), 2).count() == 40


def test_summary(spark):
    rows = [("One. Two!  Three?",), ("no end",), ("",), ("a" * 400,), (None,)]
    got = spark.createDataFrame(rows, "t string").select(texts.first_sentences(F.col("t"))).collect()
    assert [r[0] for r in got] == ["One. Two!", "no end", "", "a" * 320, None]


def write_lot(folder, name, products):
    folder.mkdir(exist_ok=True)
    rows = [json.loads(line) for line in products.toJSON().collect()]
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_lots_run_once(spark, sf, tmp_path):
    calls = str(tmp_path / "calls")

    def enrich(products):
        def service(row):
            with open(calls, "a") as f:
                f.write(row["product_id"] + "\n")
            return answer(row)

        return enrichment.enrich_with(products, service, attempts=1)

    source, store = tmp_path / "in", incremental.Store(str(tmp_path / "out"))
    write_lot(source, "a.json", named_products(spark, sf, ["x", "y", "bad"]))
    first = incremental.enrich_incremental(spark, str(source), store, enrich)
    assert sorted(r["product_id"] for r in first.collect()) == ["0", "1"]
    again = incremental.enrich_incremental(spark, str(source), store, enrich)
    assert again.count() == 2
    # A product enriched before is not sent again; one that failed is, in every run.
    write_lot(source, "b.json", named_products(spark, sf, ["x", "y", "ok", "new"]))
    last = incremental.enrich_incremental(spark, str(source), store, enrich)
    assert sorted(r["product_id"] for r in last.collect()) == ["0", "1", "2", "3"]
    sent = open(calls).read().split()
    assert sorted(sent) == ["0", "1", "2", "2", "2", "2", "3"]


def test_failed_lot_is_noted_and_skipped(spark, sf, tmp_path):
    def enrich(products):
        if products.where("name = 'boom'").count():
            raise RuntimeError("lot broken")
        return enrichment.enrich_with(products, answer, attempts=1)

    source, store = tmp_path / "in", incremental.Store(str(tmp_path / "out"))
    write_lot(source, "a.json", named_products(spark, sf, ["boom"]))
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 0
    write_lot(source, "b.json", named_products(spark, sf, ["x", "y"]))
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 2
    notes = spark.read.parquet(store.failed_lots).collect()
    assert len(notes) == 1 and "lot broken" in notes[0]["error"]


def test_invalid_cache_entry_counts_as_missing(spark, sf):
    products = named_products(spark, sf, ["a", "b", "c"])
    cache = enrichment.enrich_with(
        products.where("name <> 'c'"), lambda r: answer(r | {"name": "few" if r["name"] == "b" else "ok"})
    ).drop("error")
    hits, misses = enrichment.split_by_cache(products, cache)
    assert [r["product_id"] for r in hits.collect()] == ["0"]
    assert sorted(r["product_id"] for r in misses.collect()) == ["1", "2"]


def test_trend_over_day_borders(spark):
    rows = [("a", f"2024-01-0{d} 0{h}:00:00", float(v)) for d, h, v in [(1, 1, 5), (1, 2, 7), (4, 1, 7), (4, 3, 2)]]
    rows += [("b", "2024-01-02 00:00:00", 1.0)]
    df = spark.createDataFrame(rows, "k string, at string, v double").withColumn("at", F.to_timestamp("at"))
    got = history.trend(df, "k", "at", "v").orderBy("k", "at").collect()
    assert [(r["previous"], r["direction"]) for r in got] == [
        (None, None), (5.0, "up"), (7.0, "flat"), (7.0, "down"), (None, None),
    ]


def test_outliers(spark):
    values = [1.0, 1.1, 1.2, 1.3, 1.55, 5.0, 9.9, 9.9, 9.9, 9.9]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = history.density_outliers(df, "g", "v", 0.3, 4).collect()
    # 1.55 is near a dense value, so only 5.0 is alone.
    assert [(r["v"], r["rows"], r["neighbours"]) for r in got] == [(5.0, 1, 1)]


def test_history_takes_the_last_six(spark):
    rows = [(1, t, "USER" if t % 2 else "assistant", f"m{t}") for t in range(9)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    text = report.history_context(df).first()["history_context"]
    assert text.split("\n")[0] == "User: m3" and text.split("\n")[-1] == "Assistant: m8"
    products = spark.createDataFrame([("1", 2.0)], "product_id string, final_score double")
    row = report.chat_context(products, df).first()
    assert row["question"] == "m8" and row["history_context"].startswith("Assistant: m2")
    assert json.loads(row["data_summary"]) == [{"product_id": "1", "final_score": 2.0}]


def test_report_bundle(spark):
    rows = [("1", "A", "Home", "in_stock", 9.0, 1.0, 0, 0.1, 0.2, ["t"]), ("2", "B", "Health", None, None, 2.0, 1, None, 0.2, ["t"])]
    scored = spark.createDataFrame(
        rows, "product_id string, name string, standardized_category string, stock_status string,"
        "price double, final_score double, cluster_id int, pca_1 double, pca_2 double, tags array<string>",
    )
    rules = spark.createDataFrame(
        [(["1"], ["2"], ["A"], ["B"], 0.1, 0.255, 1.5)],
        "antecedents array<string>, consequents array<string>, antecedents_names array<string>,"
        "consequents_names array<string>, support double, confidence double, lift double",
    )
    out = report.bundle(scored, rules, categories=["Health"])
    assert tuple(out["kpis"].first()) == (1, 0.0, 2.0)
    assert out["filter_options"].count() == 3
    row = out["rows"].first().asDict()
    assert "tags" not in row and row["price"] == "N/A"
    assert out["price_score_chart"].count() == 0 and out["projection_chart"].count() == 0
    assert report.rule_texts(out["association_rules"]).first()["rule"] == "[A] -> [B]"
    assert report.display_table(scored).columns[0] == "product id"


def test_filters_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "t")
    rows = spark.range(10).select(
        F.lit("Home").alias("standardized_category"), F.lit("in_stock").alias("stock_status"),
        F.col("id").cast("double").alias("price"), F.col("id").cast("double").alias("final_score"),
        F.lit("long text").alias("description"),
    )
    rows.write.parquet(path)
    df = report.kpis(report.filter_products(spark.read.parquet(path), ["Home"], ["in_stock"]))
    plan = df._jdf.queryExecution().toString()
    assert "EqualTo(standardized_category,Home)" in plan and "EqualTo(stock_status,in_stock)" in plan
    assert "description" not in plan.split("ReadSchema")[1]
