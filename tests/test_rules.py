from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.operators import baskets, catalog


def brute_force(found, min_support, min_confidence, min_lift):
    n = len(found)
    items = sorted({i for b in found for i in b})
    support = {}
    for size in range(1, len(items) + 1):
        for combo in combinations(items, size):
            freq = sum(set(combo) <= b for b in found)
            if freq and freq / n >= min_support:
                support[combo] = freq
    rules = {}
    for combo, freq in support.items():
        for size in range(1, len(combo)):
            for ant in combinations(combo, size):
                con = tuple(i for i in combo if i not in ant)
                confidence = freq / support[ant]
                lift = confidence / (support[con] / n)
                if confidence >= min_confidence and (min_lift is None or lift > min_lift):
                    rules[ant, con] = (freq / n, confidence, lift)
    return support, rules


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sets(st.sampled_from("abcde"), min_size=1), min_size=1, max_size=12),
    st.sampled_from([0.005, 0.3, 0.5]),
    st.sampled_from([None, 1.1]),
)
def test_rules_equal_brute_force(spark, found, min_support, min_lift):
    rows = [(str(i), item) for i, basket in enumerate(found) for item in basket]
    items = spark.createDataFrame(rows, "basket_id string, item string")
    sets, n = baskets.frequent_itemsets(items, min_support)
    support, rules = brute_force(found, min_support, 0.2, min_lift)
    assert {tuple(r["items"]): r["freq"] for r in sets.collect()} == support
    got = baskets.rules(sets, n, 0.2, min_lift).collect()
    assert {(tuple(r[0]), tuple(r[1])) for r in got} == set(rules)
    for r in got:
        assert tuple(r)[2:] == pytest.approx(rules[tuple(r[0]), tuple(r[1])])


def test_no_baskets(spark):
    items = spark.createDataFrame([], "basket_id string, item string")
    assert baskets.mine(items).count() == 0


def test_names_keep_order_and_fall_back_to_ids(spark):
    rows = [(str(i), item) for i in range(4) for item in ("a", "b", "c")]
    rows += [("x", "a"), ("y", "z")]
    items = spark.createDataFrame(rows, "basket_id string, item string")
    products = spark.createDataFrame([("b", "Bowl"), ("c", "Cup")], "product_id string, name string")
    got = baskets.mine(items, products).collect()
    names = {"a": "a", "b": "Bowl", "c": "Cup"}
    assert got
    for r in got:
        assert r["antecedents_names"] == [names[i] for i in r["antecedents"]]
        assert r["consequents_names"] == [names[i] for i in r["consequents"]]
    lifts = [r["lift"] for r in got]
    assert min(lifts) > 1.1


def test_pool_is_limited_per_category(spark):
    rows = [(f"{i:03}", "x" if i % 3 else "y") for i in range(60)]
    df = spark.createDataFrame(rows, "product_id string, category string")
    pool = baskets.best_seller_pool(df)
    assert pool.groupBy("category").count().collect() and pool.count() == 16
    assert "WindowGroupLimit" in pool._jdf.queryExecution().toString()


def test_support_is_compared_as_a_share(spark):
    rows = [(i, "a") for i in range(7)] + [(i, "b") for i in range(100)]
    items = spark.createDataFrame(rows, "basket_id int, item string")
    sets, n = baskets.frequent_itemsets(items, 0.07)
    assert n == 100
    assert {tuple(r["items"]): r["freq"] for r in sets.collect()} == {
        ("a",): 7, ("b",): 100, ("a", "b"): 7
    }


def test_long_sets_grow_only_confident_consequents(spark):
    whole = [f"i{k:02d}" for k in range(25)]
    small = [([x], 1000) for x in whole] + [([x for x in whole if x != y], 10) for y in whole]
    itemsets = spark.createDataFrame([(whole, 10), *small], "items array<string>, freq bigint")
    got = baskets.rules(itemsets, 1000, 0.9, None)
    assert got.where("size(antecedents) = 24 and size(consequents) = 1").count() == 25


def test_same_store_name_on_two_platforms(spark):
    rows = [("shopify", "s", 1, 0, "a"), ("shopify", "s", 1, 1, "b"), ("woocommerce", "s", 1, 0, "a")]
    schema = "platform string, store string, page int, pos int, product_id string"
    products = spark.createDataFrame(rows, schema)
    stores = spark.createDataFrame(
        [(0, "shopify", "s"), (1, "woocommerce", "s"), (2, "shopify", "t")],
        "store_ord int, platform string, store string",
    )
    capped = catalog.cap_rows(products, 10, stores.select("platform", "store", "store_ord"))
    assert capped.count() == 3
    assert tuple(catalog.ingest_summary(stores, products).first()) == (2, 1, 3)


def test_equal_baskets_are_one_row(spark, monkeypatch):
    sizes = []
    real = baskets.written

    def counted(df, name):
        out = real(df, name)
        if name == "bases":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(baskets, "written", counted)
    found = [("a", "b", "c")] * 40 + [("b", "c")] * 30 + [("c",)] * 30 + [("a", "rare")]
    rows = [(i, item) for i, basket in enumerate(found) for item in basket]
    items = spark.createDataFrame(rows, "basket_id int, item string")
    sets, n = baskets.frequent_itemsets(items, 0.1)
    assert n == 101 and sizes and max(sizes) <= 4
    assert {"".join(r["items"]): r["freq"] for r in sets.collect()} == {
        "a": 41, "b": 70, "c": 100, "ab": 40, "ac": 40, "bc": 70, "abc": 40
    }
