import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import catalog, contracts
from shelfwise.plans import ingest
from shelfwise.sources import pages

RAW = "platform string, store string, page int, pos int, raw string"


def mapped(spark, mapper, *payloads):
    rows = [("p", "s", 1, i, json.dumps(p)) for i, p in enumerate(payloads)]
    return {r["pos"]: r for r in mapper(spark.createDataFrame(rows, RAW)).collect()}


def shopify(**changes):
    product = {
        "id": 7,
        "title": "  Mug ",
        "body_html": "<p>Blue <b>mug</b></p>",
        "product_type": " Kitchen ",
        "variants": [{"id": 1, "price": "8.50", "compare_at_price": "10.00", "available": True}],
    }
    return {k: v for k, v in (product | changes).items() if v != "absent"}


def variant(price, compare=None, available=False):
    return {"id": 1, "price": price, "compare_at_price": compare, "available": available}


def test_shopify_product_is_mapped(spark):
    row = mapped(spark, catalog.map_shopify, shopify())[0]
    assert (row["product_id"], row["name"], row["category"]) == ("7", "Mug", "Kitchen")
    assert row["description"] == "Blue  mug"
    assert (row["price"], row["promotional_price"]) == (10.0, 8.5)
    assert row["stock_status"] == "in_stock"
    assert 3.0 <= row["rating"] <= 5.0 and 0 <= row["review_count"] <= 850
    assert row["is_imputed"] and row["reasons"] == ""


@pytest.mark.parametrize(
    ("variants", "price", "promo"),
    [
        ([], 0.0, None),
        ([variant("5", "5")], 5.0, None),
        ([variant("5", "4")], 5.0, None),
        ([variant("5", "9"), variant("7", "8")], 8.0, 5.0),
        ([variant("", "3")], 3.0, 0.0),
        ([variant(None, "")], 0.0, None),
        ([variant("5", "")], 5.0, None),
    ],
)
def test_shopify_prices(spark, variants, price, promo):
    row = mapped(spark, catalog.map_shopify, shopify(variants=variants))[0]
    assert (row["price"], row["promotional_price"]) == (price, promo)


def test_shopify_stock_and_category(spark):
    rows = mapped(
        spark,
        catalog.map_shopify,
        shopify(variants=[variant("1"), variant("2")]),
        shopify(variants=[variant("1"), variant("2", available=True)]),
        shopify(product_type="   "),
        shopify(product_type=None),
    )
    assert [rows[i]["stock_status"] for i in (0, 1)] == ["out_of_stock", "in_stock"]
    assert [rows[i]["category"] for i in (2, 3)] == ["unknown", "unknown"]


def test_shopify_rows_set_aside(spark):
    rows = mapped(
        spark,
        catalog.map_shopify,
        shopify(body_html=None),
        shopify(body_html="absent"),
        shopify(title=None),
        shopify(variants=None),
        shopify(variants="absent"),
        shopify(variants=[variant("cheap")]),
        shopify(title="  "),
        shopify(id="absent"),
        shopify(variants=[variant("-1")]),
    )
    reasons = [rows[i]["reasons"].split(",") for i in range(9)]
    assert reasons[0] == ["body_html_null"]
    assert reasons[1] == [""]
    assert "title_null" in reasons[2] and "name_empty" in reasons[2]
    assert reasons[3] == ["variants_null"]
    assert reasons[4] == [""]
    assert reasons[5] == ["amount_unreadable"]
    assert reasons[6] == ["name_empty"]
    assert reasons[7] == ["product_id_empty"]
    assert reasons[8] == ["price_negative"]


def woo(**changes):
    product = {
        "id": 3,
        "name": "Lamp",
        "description": "<p>Desk lamp</p>",
        "short_description": "<i>Lamp</i>",
        "prices": {"price": "1500", "regular_price": "2000", "sale_price": "1500"},
        "categories": [{"name": "Home"}, {"name": "Light"}],
        "is_in_stock": True,
        "average_rating": "4.5",
        "review_count": 12,
    }
    return {k: v for k, v in (product | changes).items() if v != "absent"}


def test_woo_product_is_mapped(spark):
    row = mapped(spark, catalog.map_woo, woo())[0]
    assert (row["product_id"], row["name"], row["category"]) == ("3", "Lamp", "Home")
    assert row["description"] == "Desk lamp"
    assert (row["price"], row["promotional_price"]) == (20.0, 15.0)
    assert (row["rating"], row["review_count"], row["is_imputed"]) == (4.5, 12, False)
    assert row["variants"] == []


@pytest.mark.parametrize(
    ("changes", "price", "promo"),
    [
        ({"prices": {"regular_price": "2000", "sale_price": "2000"}}, 20.0, None),
        ({"prices": {"regular_price": "2000", "sale_price": "2500"}}, 20.0, None),
        ({"prices": {"regular_price": "2000", "sale_price": "0"}}, 20.0, None),
        ({"prices": "absent", "price": "900"}, 9.0, None),
        ({"prices": "absent", "price": "900", "regular_price": "1000"}, 10.0, None),
        ({"prices": {"price": ""}, "price": "700"}, 7.0, None),
        ({"prices": "absent"}, 0.0, None),
    ],
)
def test_woo_prices(spark, changes, price, promo):
    row = mapped(spark, catalog.map_woo, woo(**changes))[0]
    assert (row["price"], row["promotional_price"]) == (price, promo)


def test_woo_details(spark):
    rows = mapped(
        spark,
        catalog.map_woo,
        woo(description=""),
        woo(categories=[]),
        woo(average_rating="0", review_count=5),
        woo(review_count="absent", rating_count=9),
        woo(is_in_stock="absent"),
        woo(is_in_stock=False),
        woo(average_rating="7"),
        woo(prices=None),
        woo(review_count=None),
        woo(prices={"price": "12a"}),
    )
    assert rows[0]["description"] == "Lamp"
    assert rows[1]["category"] == "unknown"
    assert rows[2]["is_imputed"] and rows[2]["rating"] >= 3.0
    assert rows[3]["review_count"] == 9
    assert [rows[i]["stock_status"] for i in (4, 5)] == ["in_stock", "out_of_stock"]
    assert rows[6]["reasons"] == "rating_out_of_range"
    assert rows[7]["reasons"] == "prices_null"
    assert rows[8]["reasons"] == "review_count_null"
    assert rows[9]["reasons"] == "amount_unreadable"


def test_woo_variations(spark):
    objects = [
        {"id": 1, "name": "S", "price": "100", "regular_price": "150"},
        {"id": 2, "prices": {"price": "200", "regular_price": "200"}, "is_in_stock": False},
        {"id": 4},
    ]
    rows = mapped(
        spark,
        catalog.map_woo,
        woo(variations=objects),
        woo(variations=[11, objects[0], None, "x"]),
        woo(variations=[]),
        woo(variations=None),
    )
    got = [(v["variant_id"], v["price"], v["compare_at_price"], v["available"]) for v in rows[0]["variants"]]
    assert got == [("1", 1.0, 1.5, True), ("2", 2.0, None, False), ("4", 0.0, None, True)]
    assert [v["variant_id"] for v in rows[1]["variants"]] == ["1"]
    assert rows[1]["reasons"] == ""
    assert rows[2]["variants"] == []
    assert rows[3]["reasons"] == "variations_null"


def test_minor_unit_digits(spark):
    raw = spark.createDataFrame([("p", "s", 1, 0, json.dumps(woo()))], RAW)
    assert catalog.map_woo(raw, minor_unit_digits=0).first()["price"] == 2000.0


def land(root, platform, store, page, payload):
    folder = root / f"platform={platform}" / f"store={store}" / f"page={page}"
    folder.mkdir(parents=True)
    (folder / "payload.json").write_text(json.dumps(payload, indent=1))


def test_landed_files(spark, tmp_path):
    for page, products in {1: [shopify(id=1), shopify(id=2)], 2: [shopify(id=3)], 3: [], 4: [shopify(id=4)]}.items():
        land(tmp_path, "shopify", "007", page, {"products": products})
    land(tmp_path, "shopify", "full", 21, {"products": [shopify(id=9)]})
    land(tmp_path, "woocommerce", "w", 1, [woo(id=1), woo(id=2, average_rating="9")])
    land(tmp_path, "woocommerce", "w", 2, {"code": "no more pages"})
    land(tmp_path, "woocommerce", "w", 3, [woo(id=3)])
    land(tmp_path, "woocommerce", "unlisted", 1, [woo(id=5)])
    stores = [
        ("woocommerce", "w"),
        ("shopify", "007"),
        ("shopify", "full"),
        ("magento", "m"),
    ]
    limited = [("w", "1"), ("007", "1"), ("007", "2"), ("007", "3")]
    for max_pages, want, good in ((20, limited, 2), (None, [*limited, ("full", "9")], 3)):
        found = ingest.ingest_catalog(spark, str(tmp_path), stores, max_pages=max_pages)
        rows = found.products.select("platform", "store", "page", "pos", "product_id").collect()
        rows.sort(key=lambda r: (stores.index((r["platform"], r["store"])), r["page"], r["pos"]))
        assert [(r["store"], r["product_id"]) for r in rows] == want
        bad = found.quarantine.collect()
        assert [(r["product_id"], r["reasons"]) for r in bad] == [("2", ["rating_out_of_range"])]
        assert found.summary.first().asDict() == {
            "successful_stores": good,
            "failed_stores": 4 - good,
            "total_products": len(want),
        }
    assert pages.read_shopify_pages(spark, str(tmp_path)).count() == 4
    assert pages.read_shopify_pages(spark, str(tmp_path), max_pages=20).count() == 3
    assert pages.read_woo_pages(spark, str(tmp_path)).count() == 3


def test_cap_takes_stores_in_order(spark):
    rows = [(s, p, i, f"{s}{p}{i}") for s in "abc" for p in (1, 2) for i in range(5)]
    products = spark.createDataFrame(rows, "store string, page int, pos int, product_id string")
    order = spark.createDataFrame([("c", 0), ("a", 1), ("b", 2)], "store string, store_ord int")
    got = catalog.cap_rows(products, 13, order).orderBy("row_no").collect()
    want = [r[3] for r in rows if r[0] == "c"] + ["a10", "a11", "a12"]
    assert [r["product_id"] for r in got] == want
    assert [r["row_no"] for r in got] == list(range(1, 14))


def test_dedupe_keeps_the_first(spark):
    rows = [("p", "s", 2, 0, "x"), ("p", "s", 1, 5, "x"), ("p", "t", 9, 0, "x")]
    products = spark.createDataFrame(rows, "platform string, store string, page int, pos int, product_id string")
    kept = catalog.dedupe_products(products)
    assert sorted((r["store"], r["page"]) for r in kept.collect()) == [("s", 1), ("t", 9)]
    plan = kept._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert sorted(catalog.union_all([a, b]).collect()) == [(1, "x"), (2, None)]


def test_contract_edges(spark):
    base = dict(
        product_id="1", name="n", description="", category="c", price=1.0,
        promotional_price=None, rating=None, review_count=0, stock_status="in_stock",
    )
    cases = [
        ({}, ""),
        ({"price": -0.01}, "price_negative"),
        ({"price": float("nan")}, "price_negative"),
        ({"price": None}, "price_negative"),
        ({"promotional_price": -1.0}, "promotional_price_negative"),
        ({"rating": 5.0}, ""),
        ({"rating": 5.1}, "rating_out_of_range"),
        ({"review_count": -1}, "review_count_negative"),
        ({"product_id": "  "}, "product_id_empty"),
        ({"name": "\t"}, "name_empty"),
        ({"stock_status": ""}, "stock_status_empty"),
        ({"description": None}, "description_missing"),
        ({"category": None}, "category_missing"),
    ]
    schema = (
        "product_id string, name string, description string, category string, price double,"
        "promotional_price double, rating double, review_count bigint, stock_status string"
    )
    rows = [tuple((base | change).values()) for change, _ in cases]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    got = [r["reasons"] for r in contracts.check_products(df).collect()]
    assert got == [reason for _, reason in cases]


def test_enriched_contract_edges(spark):
    rows = [
        ("Home", "s", ["a", "b", "c"]),
        ("Toys", "s", ["a", "b", "c"]),
        (None, "s", ["a", "b", "c"]),
        ("Home", "", ["a", "b", "c"]),
        ("Home", "x" * 321, ["a", "b", "c"]),
        ("Home", "s", ["a", "b"]),
        ("Home", "s", list("abcdef")),
        ("Home", "s", ["a", None, "c"]),
    ]
    schema = "standardized_category string, short_summary string, extracted_tags array<string>"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    got = [r["reasons"] for r in contracts.check(df, contracts.enrichment_rules()).collect()]
    category = "category_not_in_taxonomy"
    assert got == ["", category, category, "summary_length", "summary_length", "tag_count", "tag_count", "tag_missing"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="stock_status"):
        contracts.require_columns(spark.range(1).withColumn("product_id", F.lit("x")))


AMOUNT = st.one_of(st.none(), st.just(""), st.integers(0, 2000).map(lambda c: f"{c / 100:.2f}"))


def plain_shopify_price(variants):
    """The price rule as a loop over variants."""
    cheapest, lowest_compare = None, None
    for price, compare in variants:
        value = float(price or 0)
        cheapest = value if cheapest is None else min(cheapest, value)
        if compare:
            limit = float(compare)
            lowest_compare = limit if lowest_compare is None else min(lowest_compare, limit)
    cheapest = cheapest or 0.0
    if lowest_compare is not None and lowest_compare > cheapest:
        return lowest_compare, cheapest
    return cheapest, None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(AMOUNT, AMOUNT), max_size=4), min_size=1, max_size=30))
def test_shopify_price_rule(spark, products):
    payloads = [shopify(variants=[variant(*v) for v in variants]) for variants in products]
    rows = mapped(spark, catalog.map_shopify, *payloads)
    for i, variants in enumerate(products):
        got = rows[i]["price"], rows[i]["promotional_price"]
        assert got == plain_shopify_price(variants)
        assert got[1] is None or got[1] < got[0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(*[st.one_of(st.none(), st.just(""), st.integers(0, 500).map(str))] * 3),
        min_size=1,
        max_size=30,
    )
)
def test_woo_price_rule(spark, products):
    fields = ("price", "regular_price", "sale_price")
    payloads = [woo(prices=dict(zip(fields, amounts))) for amounts in products]
    rows = mapped(spark, catalog.map_woo, *payloads)
    for i, (price, regular, sale) in enumerate(products):
        want = float(regular or price or 0) / 100
        assert rows[i]["price"] == want
        reduced = sale and 0 < float(sale) / 100 < want
        assert rows[i]["promotional_price"] == (float(sale) / 100 if reduced else None)
