"""From landed pages to the raw product table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import catalog, contracts
from shelfwise.session import checked_broadcast, written
from shelfwise.sources import pages as page_source


@dataclass
class Catalogue:
    products: DataFrame
    quarantine: DataFrame
    summary: DataFrame


def ingest_pages(
    pages: DataFrame,
    stores: DataFrame,
    *,
    max_products: int | None = None,
    max_pages: int | None = None,
    dedupe: bool = False,
) -> Catalogue:
    """Products, set-aside rows and run summary. ``stores`` lists what should be there.

    Payloads are parsed once: the checked products are written as a table, and all three
    results read from it. All pages are read unless ``max_pages`` ends a shop earlier, and
    all products are kept unless ``max_products`` caps them; the summary counts what is kept, and stores after the one that reached the cap count
    neither as good nor as failed.
    """
    wanted = checked_broadcast(stores.select("platform", "store"))
    chosen = pages.join(wanted, ["platform", "store"], "left_semi")
    checked = written(page_source.checked_products(chosen, max_pages), "checked-products")
    products = contracts.valid(checked)
    if dedupe:
        products = catalog.dedupe_products(products)
    if max_products is not None:
        products = catalog.cap_rows(
            products, max_products, stores.select("platform", "store", "store_ord")
        )
        reached = products.agg(F.count("*").alias("kept"), F.max("store_ord").alias("last"))
        stores = (
            stores.join(F.broadcast(reached))  # one row
            .where((F.col("kept") < max_products) | (F.col("store_ord") <= F.col("last")))
            .select(*stores.columns)
        )
    summary = catalog.ingest_summary(stores, products)
    rejected = contracts.quarantine(
        checked, ("platform", "store", "page", "pos", "product_id")
    )
    return Catalogue(products, rejected, summary)


def ingest_catalog(
    spark: SparkSession, root: str, stores: Iterable[tuple[str, str]], **options
) -> Catalogue:
    """The same for pages landed below ``root``; ``stores`` are (platform, store) pairs."""
    return ingest_pages(
        page_source.read_pages(spark, root), page_source.stores_table(spark, stores), **options
    )
