"""Checks of categories, summaries, tags, the contract, the cache and the lots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import text as texts
from shelfwise.operators import contracts, enrichment
from shelfwise.registry import query
from shelfwise.registry.data import spread_table, table
from shelfwise.schemas import PRODUCT
from shelfwise.session import scratch_path, written
from shelfwise.sources import tables
from shelfwise.streaming import incremental

# The texts are invented prose, so the categories here listen to words that occur in it.
WORDS = {
    "Electronics": ("the", "and", "that"),
    "Apparel": ("les", "des", "que"),
    "Home": ("der", "die", "und"),
    "Health": ("los", "las", "con"),
}


def _words_sql(column: str) -> str:
    return f"list_transform(regexp_extract_all({column}, '[A-Za-z]{{3,}}'), lambda w: lower(w))"


def _hits_sql(name: str) -> str:
    terms = ", ".join(f"'{t}'" for t in WORDS[name])
    return f"len(list_filter(words, lambda w: w in ({terms}))) as h_{name}"


@query(
    "standardized_categories",
    f"""with w as (select doc_id, {_words_sql('text')} as words from documents),
    h as (select doc_id, {', '.join(_hits_sql(n) for n in WORDS)} from w),
    m as (select *, greatest(h_Electronics, h_Apparel, h_Home, h_Health) as best from h)
    select doc_id, case when best = 0 then 'Unknown'
                        when h_Electronics = best then 'Electronics'
                        when h_Apparel = best then 'Apparel'
                        when h_Home = best then 'Home' else 'Health' end
             as standardized_category
    from m""",
)
def standardized_categories(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id", "text")
    return enrichment.add_category(docs, F.col("text"), WORDS).drop("text")


@query(
    "short_summaries",
    r"""with flat as (
      select doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g')) as t
      from documents),
    cut as (
      select doc_id,
             list_aggregate(list_slice(regexp_extract_all(t, '[^.!?]+[.!?]*'), 1, 2),
                            'string_agg', '') as t
      from flat)
    select doc_id, trim(left(trim(coalesce(t, '')), 320)) as short_summary from cut""",
)
def short_summaries(spark, sf):
    return spread_table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", texts.first_sentences(F.col("text")).alias("short_summary")
    )


@query(
    "extracted_tags",
    f"""with words as (select doc_id, unnest({_words_sql('text')}) as term from documents),
    tf as (select doc_id, term, count(*) as tf from words group by 1, 2),
    df as (select term, count(*) as df from tf group by 1),
    n as (select count(*) as n from documents),
    w as (select doc_id, term, round(tf * ln((1 + n) / (df + 1)), 9) as weight
          from tf join df using (term) cross join n),
    r as (select doc_id, term as tag, cast(row_number() over (partition by doc_id
                 order by weight desc, term) as integer) as rank from w)
    select doc_id, rank, tag from r where rank <= 5""",
)
def extracted_tags(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id", "text")
    return enrichment.tags(docs, "doc_id", F.col("text"))


@query(
    "enriched_contract",
    """select doc_id as product_id,
           concat_ws(',',
             case when lang = 'fr' then 'category_not_in_taxonomy' end,
             case when length(text) > 320 then 'summary_length' end,
             case when n_chars % 7 < 3 or n_chars % 7 > 5 then 'tag_count' end) as reasons
    from documents""",
)
def enriched_contract(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "fr", "Toys").otherwise("Home").alias("standardized_category"),
        F.col("text").alias("short_summary"),
        F.array_repeat("source", (F.col("n_chars") % 7).cast("int")).alias("extracted_tags"),
    )
    checked = contracts.check(rows, contracts.enrichment_rules())
    return checked.select(F.col("doc_id").alias("product_id"), "reasons")


def text_products(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as products with a description."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("product_id"),
        F.concat_ws(" ", "lang", "source").alias("name"),
        F.col("text").alias("description"),
        F.col("source").alias("category"),
        F.col("n_chars").cast("double").alias("price"),
        F.lit(None).cast("double").alias("promotional_price"),
        F.lit(4.0).alias("rating"),
        F.lit(1).cast("bigint").alias("review_count"),
        F.lit("in_stock").alias("stock_status"),
        F.array().cast(PRODUCT["variants"].dataType).alias("variants"),
    )


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the documents are cached; some entries break the contract."""
    key = F.col("product_id").cast("bigint")
    return text_products(spark, sf).where(key % 3 != 0).select(
        "*",
        F.when(key % 5 == 0, "Toys").otherwise("Home").alias("standardized_category"),
        F.lit("A summary.").alias("short_summary"),
        F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("extracted_tags"),
    )


@query(
    "cache_hits",
    """select cast(doc_id as varchar) as product_id, 'Home' as standardized_category
    from documents where doc_id % 3 <> 0 and doc_id % 5 <> 0""",
)
def cache_hits(spark, sf):
    hits, _ = enrichment.split_by_cache(text_products(spark, sf), _cache(spark, sf))
    return hits.select("product_id", "standardized_category")


@query(
    "cache_misses",
    """select cast(doc_id as varchar) as product_id, n_chars::double as price
    from documents where doc_id % 3 = 0 or doc_id % 5 = 0""",
)
def cache_misses(spark, sf):
    _, misses = enrichment.split_by_cache(text_products(spark, sf), _cache(spark, sf))
    return misses.select("product_id", "price")


def _by_length(row: dict) -> dict:
    """A stand-in for an outside service that refuses long texts."""
    if row["price"] > 3000:
        raise ValueError("text too long")
    return {
        "standardized_category": "Home",
        "short_summary": row["name"],
        "extracted_tags": [row["category"], "b", "c"],
    }


@query(
    "service_enrichment",
    """select cast(doc_id as varchar) as product_id,
           case when n_chars <= 3000 then lang || ' ' || source end as short_summary,
           case when n_chars <= 3000 then null else 'text too long' end as error
    from documents""",
)
def service_enrichment(spark, sf):
    return enrichment.enrich_with(
        text_products(spark, sf), _by_length, attempts=2, wait_seconds=0.0, concurrency=8
    ).select("product_id", "short_summary", "error")


@query(
    "enrichment_summary",
    """select count(*) as input_count, count(*) filter (where n_chars <= 3000) as enriched_count,
              count(*) filter (where n_chars > 3000) as error_count
    from documents""",
)
def enrichment_summary(spark, sf):
    products = text_products(spark, sf)
    results = enrichment.enrich_with(products, _by_length, attempts=1, wait_seconds=0.0)
    # Read twice below: written once, so that the service is asked once per product.
    results = written(results, "results")
    return enrichment.run_summary(products.count(), *enrichment.split_results(results))


@query(
    "incremental_enrichment",
    """select cast(doc_id as varchar) as product_id, n_chars::double as price from documents""",
)
def incremental_enrichment(spark, sf):
    """Product files enriched lot by lot; a second run finds nothing new."""
    root = scratch_path(spark, "incremental")
    products = text_products(spark, sf)
    # Three lots at any size; a lot has as many files as keep one file at a split's size.
    files = max(1, -(-products.rdd.getNumPartitions() // 3))
    tables.write_json(products.repartition(3 * files), f"{root}/products")
    store = incremental.Store(f"{root}/out")

    def enrich(products: DataFrame) -> DataFrame:
        return enrichment.enrich_with(products, _short, attempts=1)

    incremental.enrich_incremental(spark, f"{root}/products", store, enrich, files_per_lot=files)
    found = incremental.enrich_incremental(spark, f"{root}/products", store, enrich)
    return found.select("product_id", "price")


def _short(row: dict) -> dict:
    return {
        "standardized_category": "Unknown",
        "short_summary": row["name"],
        "extracted_tags": ["a", "b", "c"],
    }


@query(
    "enriched_round_trip",
    """select cast(doc_id as varchar) as product_id, text as description, 3 as n_tags
    from documents where doc_id % 3 <> 0""",
)
def enriched_round_trip(spark, sf):
    path = scratch_path(spark, "enriched")
    tables.write_json(_cache(spark, sf), path)
    return tables.read_enriched(spark, path).select(
        "product_id", "description", F.size("extracted_tags").alias("n_tags")
    )
