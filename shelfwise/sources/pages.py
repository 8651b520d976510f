"""Landed catalogue pages of the two platforms, and their products.

Pages lie at ``<root>/platform=<p>/store=<s>/page=<n>/<file>``, one payload per file, or
in a table with the columns platform, store, page and payload.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.catalog import map_shopify, map_woo, union_all
from shelfwise.session import checked_broadcast

# How long a page may be.
SHOPIFY_PAGE_SIZE = 250
WOO_PAGE_SIZE = 100


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """All landed payload files; platform, store and page come from the path.

    Their types are given, not inferred: a store named 007 keeps its name.
    """
    schema = "value string, platform string, store string, page int"
    found = spark.read.schema(schema).text(root, wholetext=True)
    return found.select("platform", "store", "page", F.col("value").alias("payload"))


def shopify_items(payload: Column) -> Column:
    """Raw product texts of a page object; anything else has none."""
    items = F.from_json(payload, "products array<string>")["products"]
    return F.coalesce(items, F.array().cast("array<string>"))


def woo_items(payload: Column) -> Column:
    """Raw product texts of a page array; anything else has none."""
    is_array = F.ltrim(payload).startswith("[")
    items = F.when(is_array, F.from_json(payload, "array<string>"))
    return F.coalesce(items, F.array().cast("array<string>"))


def page_products(
    pages: DataFrame, items: Column, max_pages: int | None = None
) -> DataFrame:
    """One row per raw product, up to the first empty page of its store.

    All landed pages are read unless ``max_pages`` says otherwise.

    The first empty page is found in a pass of its own over (store, page, length), so
    the payloads themselves never move between tasks.
    """
    wanted = F.col("page") >= 1
    if max_pages is not None:
        wanted = wanted & (F.col("page") <= max_pages)
    read = pages.where(wanted).withColumn("items", items)
    stops = (
        read.where(F.size("items") == 0)
        .groupBy("platform", "store")
        .agg(F.min("page").alias("first_empty"))
    )
    return (
        read.join(checked_broadcast(stops), ["platform", "store"], "left")
        .where(F.col("first_empty").isNull() | (F.col("page") < F.col("first_empty")))
        .select("platform", "store", "page", F.posexplode("items").alias("pos", "raw"))
    )


def shopify_products(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Checked products of Shopify pages."""
    chosen = pages.where(F.col("platform") == "shopify")
    return map_shopify(page_products(chosen, shopify_items(F.col("payload")), max_pages))


def woo_products(
    pages: DataFrame, max_pages: int | None = None, minor_unit_digits: int = 2
) -> DataFrame:
    """Checked products of WooCommerce pages."""
    chosen = pages.where(F.col("platform") == "woocommerce")
    raw = page_products(chosen, woo_items(F.col("payload")), max_pages)
    return map_woo(raw, minor_unit_digits)


def read_shopify_pages(
    spark: SparkSession, root: str, max_pages: int | None = None
) -> DataFrame:
    return shopify_products(read_pages(spark, root), max_pages)


def read_woo_pages(
    spark: SparkSession, root: str, max_pages: int | None = None
) -> DataFrame:
    return woo_products(read_pages(spark, root), max_pages)


def checked_products(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Products of both platforms with the reasons that speak against them."""
    return union_all([shopify_products(pages, max_pages), woo_products(pages, max_pages)])


def stores_table(spark: SparkSession, stores: Iterable[tuple[str, str]]) -> DataFrame:
    """(platform, store) pairs in the order they are read, trailing slashes cut."""
    rows = [(i, platform, store.rstrip("/")) for i, (platform, store) in enumerate(stores)]
    return spark.createDataFrame(rows, "store_ord int, platform string, store string")
