"""Category, summary and tags for products, from their texts or a given function."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import text as texts
from shelfwise.operators import contracts
from shelfwise.operators.skew import join_split_hot
from shelfwise.schemas import ENRICHED, PRODUCT, PRODUCT_KEY, SHOP, TAXONOMY
from shelfwise.session import checked_broadcast, written

# Words that speak for a category.
KEYWORDS = {
    "Electronics": (
        "battery", "bluetooth", "cable", "camera", "charger", "computer", "digital",
        "electronic", "headphone", "keyboard", "laptop", "phone", "screen", "speaker",
        "tablet", "usb", "video", "wireless",
    ),
    "Apparel": (
        "apparel", "boots", "clothing", "coat", "cotton", "dress", "hat", "hoodie",
        "jacket", "jeans", "leggings", "shirt", "shoe", "shoes", "shorts", "socks",
        "sweater", "wool",
    ),
    "Home": (
        "bed", "bowl", "candle", "chair", "cup", "curtain", "decor", "furniture",
        "garden", "home", "kitchen", "lamp", "mug", "pillow", "plate", "sofa", "table",
        "towel",
    ),
    "Health": (
        "beauty", "cream", "diet", "fitness", "health", "hygiene", "lotion", "medical",
        "organic", "protein", "serum", "skin", "soap", "supplement", "vitamin", "wellness",
    ),
}

MIN_TAGS = 3
MAX_TAGS = 5

#: Products of a task that are held as dicts at a time.
HELD_ROWS = 256


def term_counts(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, term, tf) of every text. Repeated words are counted before the shuffle."""
    return (
        df.select(F.col(key), F.explode(texts.words(text)).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )


def add_category(
    df: DataFrame, text: Column, keywords: dict[str, tuple[str, ...]] = KEYWORDS
) -> DataFrame:
    """Add standardized_category: the category with most keyword hits, else Unknown.

    Ties go to the category that comes first in the taxonomy. The score of a row needs
    only its own words, so this is a map: the keyword list is part of the expression.
    """

    def count_of(terms: tuple[str, ...]) -> Column:
        return F.size(F.filter(F.col("tokens"), lambda t: t.isin(*terms)))

    best, most = F.lit("Unknown"), F.lit(0)
    for name in TAXONOMY:
        if name in keywords:
            hits = F.col(f"hits_{name}")
            best = F.when(hits > most, F.lit(name)).otherwise(best)
            most = F.greatest(most, hits)
    hit_columns = {f"hits_{name}": count_of(terms) for name, terms in keywords.items()}
    return (
        df.withColumn("tokens", texts.words(text))
        .withColumns(hit_columns)
        .withColumn("standardized_category", best)
        .drop("tokens", *hit_columns)
    )


def term_weights(tf: DataFrame, key: str, rows: int, hot_share: float = 0.01) -> DataFrame:
    """Add the weight tf * ln((1 + rows) / (1 + texts with the term)).

    Terms in more than ``hot_share`` of the texts are few (their number is at most the
    mean count of distinct terms per text divided by the share), so they are broadcast
    if they pass the size check; all others are joined by shuffle, where no term has
    more than that share of the texts.
    """
    tf = written(tf, "term-counts")
    vocabulary = written(tf.groupBy("term").agg(F.count("*").alias("df")), "vocabulary")
    hot_from = max(1.0, rows * hot_share)
    hot = vocabulary.where(F.col("df") > hot_from)
    cold = vocabulary.where(F.col("df") <= hot_from)
    marked = tf.join(checked_broadcast(hot, 500_000), "term", "left")
    common = marked.where("df is not null")
    rare = marked.where("df is null").drop("df").join(cold, "term")
    weight = F.col("tf") * F.log(F.lit(1.0 + rows) / (F.col("df") + F.lit(1.0)))
    return common.unionByName(rare).withColumn("weight", weight)


def tags(
    df: DataFrame, key: str, text: Column, max_tags: int = MAX_TAGS
) -> DataFrame:
    """(key, rank, tag): the heaviest terms of every text; ties alphabetically."""
    rows = df.count()
    weighted = term_weights(term_counts(df, key, text), key, rows)
    w = Window.partitionBy(key).orderBy(F.desc(F.round("weight", 9)), "term")
    return (
        weighted.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= max_tags)
        .select(key, "rank", F.col("term").alias("tag"))
    )


def product_text() -> Column:
    return F.concat_ws(". ", "name", "category", "description")


def enrich_with_rules(products: DataFrame) -> DataFrame:
    """The three enrichment columns from the product text itself.

    Product ids are unique, or unique per platform and store if ``products`` has these.
    """
    whole = product_text()
    key = F.to_json(F.struct(*[c for c in PRODUCT_KEY if c in products.columns]))
    keyed = products.withColumn("product_key", key)
    found = tags(keyed, "product_key", whole)
    listed = F.array_sort(F.collect_list(F.struct("rank", "tag")))
    grouped = found.groupBy("product_key").agg(
        F.transform(listed, lambda t: t["tag"]).alias("extracted_tags")
    )
    described = F.coalesce(F.nullif(F.col("description"), F.lit("")), F.col("name"))
    return (
        add_category(keyed, whole)
        .withColumn("short_summary", texts.first_sentences(described))
        .join(grouped, "product_key", "left")
        .withColumn(
            "extracted_tags", F.coalesce("extracted_tags", F.array().cast("array<string>"))
        )
        .select(*products.columns, "standardized_category", "short_summary", "extracted_tags")
    )


def enrich_with(
    products: DataFrame,
    function: Callable[[dict], dict],
    *,
    attempts: int = 5,
    wait_seconds: float = 2.0,
    max_wait_seconds: float = 60.0,
    concurrency: int | None = None,
    in_flight: int = 1,
    pause_seconds: float = 0.0,
) -> DataFrame:
    """Call ``function`` per product; a row that keeps failing gets an ``error``.

    The function takes a product as a dict and returns the three enrichment values.
    Platform and store are kept if ``products`` has them.

    A task has up to ``in_flight`` calls open at a time, each in a thread of its own that waits
    ``pause_seconds`` before it; they end in any order. A new call starts when one has ended,
    also across batches, and no further batch is read while all are open, so a slow service
    holds the task back instead of filling its memory. Rows are taken and given back by at
    most ``HELD_ROWS``, in their order. ``concurrency`` bounds the number of tasks: ``concurrency`` x ``in_flight`` calls at most.
    """
    if in_flight < 1:
        raise ValueError("in_flight must be >= 1")
    added = ("standardized_category", "short_summary", "extracted_tags")
    shop = [f for f in SHOP.fields if f.name in products.columns]
    schema = T.StructType([*shop, *ENRICHED.fields, T.StructField("error", T.StringType())])
    names = [f.name for f in (*shop, *PRODUCT.fields)]

    def call(row: dict) -> tuple[dict, str | None]:
        for attempt in range(1, attempts + 1):
            try:
                return function(row), None
            except Exception as problem:
                if attempt == attempts:
                    return {}, str(problem)
                time.sleep(min(max_wait_seconds, wait_seconds * 2 ** (attempt - 1)))
        return {}, "no attempt made"

    def paused(row: dict) -> tuple[dict, str | None]:
        if pause_seconds:
            time.sleep(pause_seconds)
        return call(row)

    def answered(batch: pd.DataFrame, out: list[tuple[dict, str | None]]) -> pd.DataFrame:
        return batch.assign(
            **{c: [values.get(c) for values, _ in out] for c in added},
            error=[problem for _, problem in out],
        )

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), HELD_ROWS):
                yield batch.iloc[start : start + HELD_ROWS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free = threading.Semaphore(in_flight)
        started: deque[tuple[pd.DataFrame, list[Future]]] = deque()
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in slices(batches):
                futures: list[Future] = []
                for row in batch.to_dict("records"):
                    free.acquire()
                    future = pool.submit(paused, row)
                    future.add_done_callback(lambda _: free.release())
                    futures.append(future)
                started.append((batch, futures))
                while started and all(f.done() for f in started[0][1]):
                    batch, futures = started.popleft()
                    yield answered(batch, [f.result() for f in futures])
            for batch, futures in started:
                yield answered(batch, [f.result() for f in futures])

    rows = products.select(*names)
    if concurrency is not None:
        if concurrency < 1:
            raise ValueError("concurrency must be >= 1")
        rows = rows.repartition(concurrency)
    return rows.mapInPandas(run, schema)


def split_results(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid enriched rows, error rows with the reason)."""
    failed = F.col("error").isNotNull() if "error" in enriched.columns else F.lit(False)
    checked = contracts.check_enriched(enriched)
    good = checked.where(~failed & (F.col("reasons") == "")).drop("reasons", "error")
    reason = F.col("reasons")
    if "error" in enriched.columns:
        reason = F.coalesce("error", reason)
    bad = checked.where(failed | (F.col("reasons") != "")).select(
        *[c for c in PRODUCT_KEY if c in checked.columns], reason.alias("error")
    )
    return good, bad


def run_summary(total: int, good: DataFrame, bad: DataFrame) -> DataFrame:
    """Input, enriched and error counts, one row."""
    both = good.select(F.lit(1).alias("ok")).unionByName(bad.select(F.lit(0).alias("ok")))
    return both.agg(
        F.lit(total).cast("bigint").alias("input_count"),
        F.count_if(F.col("ok") == 1).alias("enriched_count"),
        F.count_if(F.col("ok") == 0).alias("error_count"),
    )


def usable_cache(cache: DataFrame) -> DataFrame:
    """Cached rows that still satisfy the contract; the others count as missing."""
    return contracts.valid(contracts.check_enriched(cache))


def product_key(*frames: DataFrame) -> Column:
    """Platform, store and id as one text, of the columns that all ``frames`` have; null-safe."""
    return F.to_json(F.struct(*[c for c in PRODUCT_KEY if all(c in f.columns for f in frames)]))


def split_by_cache(products: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cached records of the products, products still to enrich).

    Shops may share ids: products are told apart by platform, store and id, as far as both
    tables have these.
    """
    key = product_key(products, cache)
    good = usable_cache(cache).withColumn("_key", key)
    keyed = products.withColumn("_key", key)
    hits = good.join(keyed.select("_key").distinct(), "_key", "left_semi")
    misses = join_split_hot(keyed, good.select("_key"), "_key", "left_anti")
    return hits.drop("_key"), misses.drop("_key")
