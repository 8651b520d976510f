import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import enrichment
from shelfwise.streaming import incremental


def record(store, product_id, **other):
    base = {"platform": "shopify", "store": store, "product_id": product_id, "name": "mug"}
    return base | {
        "description": "A mug. It holds tea", "category": "Home", "price": 5.0,
        "review_count": 1, "stock_status": "in_stock", "variants": [],
    } | other


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def keys(df):
    return sorted((r["store"], r["product_id"]) for r in df.select("store", "product_id").collect())


def answer(row):
    return {
        "standardized_category": "Home", "short_summary": row["name"], "extracted_tags": list("abc"),
    }


@pytest.mark.parametrize("rules", [False, True])
def test_every_product_is_enriched_or_an_error(spark, tmp_path, rules):
    """Shops share an id, in one lot and in a later one; a row breaks the contract."""

    def enrich(products):
        if rules:
            return enrichment.enrich_with_rules(products)
        return enrichment.enrich_with(products, answer, attempts=1)

    source, store = tmp_path / "in", incremental.Store(str(tmp_path / "out"))
    first = [record("a", "1"), record("b", "1", name="red cup"), record("a", "2", price=-1.0)]
    land(source, "a.json", first)
    incremental.enrich_incremental(spark, str(source), store, enrich)
    land(source, "b.json", [record("c", "1"), record("a", "1"), record(None, "1")])
    done = incremental.enrich_incremental(spark, str(source), store, enrich)
    assert sorted((str(a), b) for a, b in {(r["store"], r["product_id"]) for r in done.collect()}) == [
        ("None", "1"), ("a", "1"), ("b", "1"), ("c", "1"),
    ]
    assert done.count() == 4
    bad = spark.read.parquet(store.errors)
    assert [tuple(r) for r in bad.select("store", "product_id", "error").collect()] == [
        ("a", "2", "price_negative")
    ]


def test_failed_lot_is_taken_up_again(spark, tmp_path):
    source, store = tmp_path / "in", incremental.Store(str(tmp_path / "out"))
    down = tmp_path / "down"
    down.touch()

    def enrich(products):
        if down.exists():
            raise RuntimeError("service down")
        return enrichment.enrich_with(products, answer, attempts=1)

    land(source, "a.json", [record("a", "1"), record("a", "2", name="")])
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 0
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 0
    notes = spark.read.schema(incremental.NOTE).parquet(store.failed_lots)
    assert [r["error"] for r in notes.collect()] == ["service down"]
    # The files may be gone by the time the service is back.
    (source / "a.json").unlink()
    down.unlink()
    land(source, "b.json", [record("b", "1")])
    done = incremental.enrich_incremental(spark, str(source), store, enrich)
    assert keys(done) == [("a", "1"), ("b", "1")]
    assert keys(spark.read.parquet(store.errors)) == [("a", "2")]
    assert spark.read.schema(incremental.NOTE).parquet(store.failed_lots).where(
        F.col("lot").isNotNull()
    ).count() == 0
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 2


def test_products_wait_while_the_service_is_down(spark, tmp_path):
    """An outage of some calls loses nothing: input = enriched + waiting + errors in every run."""
    source, store = tmp_path / "in", incremental.Store(str(tmp_path / "out"))
    down = tmp_path / "down"
    down.write_text("b")

    def ask(row):
        if down.exists() and (down.read_text() == "all" or str(row["store"]) in down.read_text()):
            raise RuntimeError("service down")
        return answer(row)

    def enrich(products):
        return enrichment.enrich_with(products, ask, attempts=1)

    land(source, "a.json", [record("a", "1"), record("b", "1"), record(None, "1"), record("b", "2", price=-1.0)])
    incremental.enrich_incremental(spark, str(source), store, enrich, files_per_lot=1)
    done = incremental.read_cache(spark, store)
    assert done.count() == 2 and incremental.read_waiting(spark, store).count() == 1
    # The service is down altogether, new products come in, old ones stay in line.
    down.write_text("all")
    land(source, "b.json", [record("c", "1"), record("b", "1", name="later")])
    incremental.enrich_incremental(spark, str(source), store, enrich, files_per_lot=1)
    assert incremental.read_cache(spark, store).count() == 2
    assert incremental.read_waiting(spark, store).select("store", "product_id").distinct().count() == 2
    down.unlink()
    done = incremental.enrich_incremental(spark, str(source), store, enrich, files_per_lot=1)
    assert sorted(str(r["store"]) for r in done.collect()) == ["None", "a", "b", "c"]
    assert incremental.read_waiting(spark, store).count() == 0
    assert keys(spark.read.parquet(store.errors)) == [("b", "2")]
    assert incremental.enrich_incremental(spark, str(source), store, enrich).count() == 4


def test_cache_is_told_apart_by_shop(spark):
    rows = [("shopify", "a", "1", "x"), ("shopify", "b", "1", "x"), ("shopify", None, "1", "x")]
    products = spark.createDataFrame(rows, "platform string, store string, product_id string, name string")
    cached = enrichment.enrich_with(
        spark.createDataFrame([record("a", "1"), record(None, "1")], incremental.LANDED), answer, attempts=1
    ).drop("error")
    hits, misses = enrichment.split_by_cache(products, cached)
    assert {r["store"] for r in hits.collect()} == {"a", None}
    assert [r["store"] for r in misses.collect()] == ["b"]
