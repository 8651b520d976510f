import json

import pytest

from shelfwise.operators import contracts
from shelfwise.schemas import RULE
from shelfwise.sources import tables

PRODUCT = {
    "product_id": "007", "name": "n", "price": 1.5, "stock_status": "in_stock",
    "variants": [{"variant_id": "1", "price": 1.5}],
}


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_read_products(spark, tmp_path, layout):
    records = [PRODUCT, PRODUCT | {"extra": 1}, PRODUCT | {"price": -1}, {"product_id": "2"}]
    text = json.dumps(records, indent=1) if layout == "array" else "\n".join(map(json.dumps, records))
    (tmp_path / "p.json").write_text(text)
    checked = tables.read_products(spark, str(tmp_path), layout)
    good = contracts.valid(checked).collect()
    assert [(r["product_id"], r["category"], r["review_count"]) for r in good] == [("007", "unknown", 0)]
    reasons = sorted(r["reasons"] for r in contracts.quarantine(checked).collect())
    assert ["price_negative"] in reasons and ["unknown_key"] in reasons and len(reasons) == 3


def test_array_layout_rejects_objects(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PRODUCT))
    with pytest.raises(ValueError, match="array"):
        tables.read_products(spark, str(tmp_path), "array")


def test_read_enriched_drops_what_is_no_object(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([PRODUCT, 5, "x", None]))
    assert tables.read_enriched(spark, str(tmp_path), "array").count() == 1
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "p.json").write_text("[]")
    with pytest.raises(ValueError, match="empty"):
        tables.read_enriched(spark, str(empty), "array")


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_read_topk_coerces(spark, tmp_path, layout):
    rows = [
        {"product_id": "1", "price": "9.5", "final_score": "bad", "cluster_id": "2"},
        {"product_id": "2", "price": 3, "final_score": 1.25, "cluster_id": None},
    ]
    text = json.dumps(rows, indent=1) if layout == "array" else "\n".join(map(json.dumps, rows))
    (tmp_path / "t.json").write_text(text)
    got = {r["product_id"]: r for r in tables.read_topk(spark, str(tmp_path), layout).collect()}
    assert (got["1"]["price"], got["1"]["final_score"], got["1"]["cluster_id"]) == (9.5, None, 2)
    assert (got["2"]["price"], got["2"]["final_score"], got["2"]["cluster_id"]) == (3.0, 1.25, None)


def test_rules_keep_the_strongest(spark, tmp_path):
    rows = [([f"{i:02}"], ["z"], None, None, 0.1, 0.5, float(i)) for i in range(60)]
    path = str(tmp_path / "rules")
    tables.write_rules(spark.createDataFrame(rows, RULE), path)
    assert spark.read.schema(RULE).json(path).count() == 50
    assert [r["lift"] for r in tables.read_rules(spark, path).collect()] == [float(i) for i in range(59, 44, -1)]


def test_feature_table_guards(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.write_features(spark.createDataFrame([("1",)], "product_id string"), path)
    assert tables.read_features(spark, path).count() == 1
    with pytest.raises(ValueError, match="reviews"):
        tables.read_features(spark, path, ("product_id", "reviews"))
