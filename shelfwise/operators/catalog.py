"""Mapping raw payload products to the product schema, and catalogue-level operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import impute, prices, text
from shelfwise.operators import contracts
from shelfwise.schemas import SHOPIFY_PRODUCT, WOO_PRODUCT
from shelfwise.session import checked_broadcast

# The two platforms.
PLATFORMS = ("shopify", "woocommerce")

# Fields that may be absent from a payload but not null.
SHOPIFY_NOT_NULL = ("body_html", "title", "variants")
WOO_NOT_NULL = ("name", "prices", "review_count")

_ORIGIN = ("platform", "store", "page", "pos")


def _parsed(raw: DataFrame, schema: T.StructType, not_null: Iterable[str]) -> DataFrame:
    """The payload fields as ``p``; ``keys`` lists the keys present if one of the fields
    ``not_null`` is null though its name is in the text, as it is or perhaps in escapes, so
    that few payloads are read a second time."""
    p, raw_text = F.col("p"), F.col("raw")
    escaped = raw_text.contains("\\u")
    suspicious = reduce(
        lambda a, b: a | b,
        [p[f].isNull() & (raw_text.contains(f'"{f}"') | escaped) for f in not_null],
    )
    return raw.withColumn("p", F.from_json("raw", schema)).withColumn(
        "keys", F.when(suspicious, F.json_object_keys("raw"))
    )


def _null_in_payload(field: str) -> Column:
    """True if the key is there but holds JSON null (an absent key is fine)."""
    listed = F.coalesce(F.array_contains("keys", field), F.lit(False))
    return F.col("p")[field].isNull() & listed


def map_shopify(raw: DataFrame) -> DataFrame:
    """``raw`` JSON texts to checked products (see ``contracts.valid``/``quarantine``)."""
    p = F.col("p")
    parsed = _parsed(raw, SHOPIFY_PRODUCT, SHOPIFY_NOT_NULL).withColumn(
        "variants", prices.shopify_variants(p["variants"])
    )
    price, promo = prices.shopify_price(F.col("variants"))
    product_id = F.coalesce(p["id"], F.lit(""))
    earlier = contracts.broken_rules(
        [
            *[(f"{field}_null", ~_null_in_payload(field)) for field in SHOPIFY_NOT_NULL],
            ("amount_unreadable", ~prices.shopify_bad_amount(p["variants"])),
        ]
    )
    mapped = parsed.select(
        *_ORIGIN,
        product_id.alias("product_id"),
        p["title"].alias("name"),
        text.strip_html(F.coalesce(p["body_html"], F.lit(""))).alias("description"),
        text.category_or_unknown(p["product_type"]).alias("category"),
        price.alias("price"),
        promo.alias("promotional_price"),
        impute.imputed_rating(product_id).alias("rating"),
        impute.imputed_review_count(product_id).alias("review_count"),
        prices.stock_status(prices.shopify_in_stock(F.col("variants"))).alias(
            "stock_status"
        ),
        "variants",
        F.lit(True).alias("is_imputed"),
        earlier.alias("mapping_reasons"),
    )
    return _checked(mapped)


def map_woo(raw: DataFrame, minor_unit_digits: int = 2) -> DataFrame:
    """``raw`` JSON texts to checked products."""
    p = F.col("p")
    mixed = F.when(_null_in_payload("variations"), prices.woo_mixed_variants(F.col("raw")))
    parsed = _parsed(raw, WOO_PRODUCT, (*WOO_NOT_NULL, "variations")).withColumn(
        "raw_variants", F.coalesce(p["variations"], mixed)
    )
    price, promo = prices.woo_price(p, minor_unit_digits)
    product_id = F.coalesce(p["id"], F.lit(""))
    rating, reviews = woo_rating(p)
    given_reviews = F.coalesce(p["review_count"], p["rating_count"])
    lacking = (rating == 0.0) | (reviews == 0)
    earlier = contracts.broken_rules(
        [
            *[(f"{field}_null", ~_null_in_payload(field)) for field in WOO_NOT_NULL],
            (
                "variations_null",
                ~(_null_in_payload("variations") & F.col("raw_variants").isNull()),
            ),
            ("amount_unreadable", ~prices.woo_bad_amount(p)),
            (
                "rating_unreadable",
                ~(
                    prices.unreadable(p["average_rating"])
                    | prices.unreadable(given_reviews)
                ),
            ),
        ]
    )
    mapped = parsed.select(
        *_ORIGIN,
        product_id.alias("product_id"),
        p["name"].alias("name"),
        text.strip_html(woo_description(p)).alias("description"),
        woo_category(p).alias("category"),
        price.alias("price"),
        promo.alias("promotional_price"),
        F.when(lacking, impute.imputed_rating(product_id)).otherwise(rating).alias("rating"),
        F.when(lacking, impute.imputed_review_count(product_id))
        .otherwise(reviews)
        .alias("review_count"),
        prices.stock_status(F.coalesce(p["is_in_stock"], F.lit(True))).alias("stock_status"),
        prices.woo_variants(F.col("raw_variants"), minor_unit_digits).alias("variants"),
        lacking.alias("is_imputed"),
        earlier.alias("mapping_reasons"),
    )
    return _checked(mapped)


def woo_description(p: Column) -> Column:
    """The description, or the short one where it is empty."""
    return F.coalesce(
        F.nullif(p["description"], F.lit("")), p["short_description"], F.lit("")
    )


def woo_category(p: Column) -> Column:
    """Name of the first category."""
    return F.coalesce(F.get(p["categories"], F.lit(0))["name"], F.lit("unknown"))


def woo_rating(p: Column) -> tuple[Column, Column]:
    """(rating, review count) as given, zero where missing."""
    rating = F.coalesce(prices.amount(p["average_rating"]), F.lit(0.0))
    given = F.coalesce(p["review_count"], p["rating_count"])
    return rating, F.coalesce(prices.amount(given).try_cast("bigint"), F.lit(0))


def _checked(mapped: DataFrame) -> DataFrame:
    """Apply the contract. The result comes out of a generator: a filter on the reasons
    would otherwise be pushed below the projections and parse every payload twice."""
    checked = contracts.check_products(mapped, F.col("mapping_reasons")).drop(
        "mapping_reasons"
    )
    return checked.select(F.inline(F.array(F.struct(*checked.columns))))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cap_rows(products: DataFrame, limit: int, store_order: DataFrame) -> DataFrame:
    """The first ``limit`` products in (store order, page, position).

    Counts per page are added up to give every page its first global row number, so no
    task sorts the catalogue: products are numbered inside their own page only. Pages
    hold at most a few hundred products; the page table is as long as the number of
    pages before the cap can be reached, because stores are taken in order.

    ``store_order`` has the columns platform, store and store_ord, one row per shop; a
    name may occur on two platforms. Without a platform, the store alone is the key.
    """
    shop = [c for c in ("platform", "store") if c in store_order.columns]
    page_sizes = products.groupBy(*shop, "page").agg(F.count("*").alias("page_rows"))
    # A non-empty page holds at least one row: the first `limit` pages always suffice.
    first_pages = (
        page_sizes.join(store_order, shop)
        .orderBy("store_ord", "page")
        .limit(limit)
        .withColumn(
            "before",
            F.sum("page_rows").over(
                Window.orderBy("store_ord", "page").rowsBetween(
                    Window.unboundedPreceding, -1
                )
            ),
        )
        .select(*shop, "page", "store_ord", F.coalesce("before", F.lit(0)).alias("before"))
        .where(F.col("before") < limit)
    )
    in_page = Window.partitionBy(*shop, "page").orderBy("pos", "product_id")
    return (
        products.join(checked_broadcast(first_pages), [*shop, "page"])
        .withColumn("n", F.row_number().over(in_page))
        .where(F.col("n") <= limit)
        .where(F.col("before") + F.col("n") <= limit)
        .withColumn("row_no", F.col("before") + F.col("n"))
        .drop("before", "n")
    )


def dedupe_products(
    products: DataFrame,
    key: Iterable[str] = ("platform", "store", "product_id"),
    order: Iterable[str] = ("page", "pos"),
) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is applied before the shuffle as well, so a key with very many
    copies sends one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return products.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def ingest_summary(stores: DataFrame, products: DataFrame) -> DataFrame:
    """Stores that gave a product, stores that failed, and the number of products.

    A store fails on an unknown platform or when no valid product came out of it.
    """
    shop = ["platform", "store"]
    counts = products.groupBy(*shop).agg(F.count("*").alias("n"))
    known = F.col("platform").isin(*PLATFORMS)
    joined = stores.join(checked_broadcast(counts), shop, "left").withColumn(
        "ok", F.coalesce(known & (F.col("n") > 0), F.lit(False))
    )
    return joined.agg(
        F.count_if("ok").alias("successful_stores"),
        F.count_if(~F.col("ok")).alias("failed_stores"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias(
            "total_products"
        ),
    )
