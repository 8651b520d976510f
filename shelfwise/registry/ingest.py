"""Checks of the ingest job: every part is one landed page of a shop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import catalog, contracts
from shelfwise.plans import ingest
from shelfwise.registry import query
from shelfwise.registry.data import spread_table, table
from shelfwise.registry.payloads import hash_sql
from shelfwise.session import scratch_path, written
from shelfwise.sources import pages as page_source
from shelfwise.sources import tables

# Twenty parts make one shop, one part one page of three products. Every third shop runs
# Shopify; every eleventh an unknown platform; the rest WooCommerce. Page 18 is empty in
# every fifth shop.


def _shop() -> Column:
    return F.floor(F.col("p_partkey") / 20)


def _platform() -> Column:
    return (
        F.when(_shop() % 11 == 10, "magento")
        .when(_shop() % 3 == 0, "shopify")
        .otherwise("woocommerce")
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part", "p_partkey")
        .select(
            _shop().cast("int").alias("store_ord"),
            _platform().alias("platform"),
            F.concat(F.lit("shop-"), _shop().cast("string")).alias("store"),
        )
        .distinct()
    )


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """A table of page payloads, written and read like landed data."""
    key, size = F.col("p_partkey"), F.col("p_size")
    cents = F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint")

    def shopify(i: Column) -> Column:
        price = F.col("p_retailprice") + i
        return F.struct(
            (key * 10 + i).alias("id"),
            F.when((key + i) % 29 == 0, "  ")
            .otherwise(F.concat_ws(" ", "p_name", i.cast("string")))
            .alias("title"),
            F.concat(F.lit("<p>"), "p_brand", F.lit("</p>")).alias("body_html"),
            F.col("p_type").alias("product_type"),
            F.array(
                F.struct(
                    key.alias("id"),
                    price.cast("string").alias("price"),
                    F.when(key % 4 == 0, (price * 1.25).cast("string")).alias(
                        "compare_at_price"
                    ),
                    (size % 3 != 0).alias("available"),
                )
            ).alias("variants"),
        )

    def woo(i: Column) -> Column:
        return F.struct(
            (key * 10 + i).alias("id"),
            F.concat_ws(" ", "p_name", i.cast("string")).alias("name"),
            F.lit("").alias("description"),
            F.concat(F.lit("Short <i>"), "p_brand", F.lit("</i>")).alias("short_description"),
            F.struct(
                cents.cast("string").alias("price"),
                (cents + 100).cast("string").alias("regular_price"),
                (cents - i * 50).cast("string").alias("sale_price"),
            ).alias("prices"),
            F.array(F.struct(F.col("p_type").alias("name"))).alias("categories"),
            (size % 3 != 0).alias("is_in_stock"),
            ((key % 52) / 10).cast("string").alias("average_rating"),
            (key % 9 + 1).alias("review_count"),
        )

    three = F.array(F.lit(0), F.lit(1), F.lit(2))
    is_empty = (_shop() % 5 == 4) & (key % 20 == 17)
    products = F.when(is_empty, F.array()).otherwise(F.transform(three, shopify))
    shopify_page = F.to_json(F.struct(products.alias("products")))
    woo_page = F.when(is_empty, "[]").otherwise(F.to_json(F.transform(three, woo)))
    pages = spread_table(spark, sf, "part").select(
        _platform().alias("platform"),
        F.concat(F.lit("shop-"), _shop().cast("string")).alias("store"),
        (key % 20 + 1).cast("int").alias("page"),
        F.when(_platform() == "shopify", shopify_page).otherwise(woo_page).alias("payload"),
    )
    return written(pages, "landed-pages")


LANDED = f"""
raw as (
  select *, cast(floor(p_partkey / 20) as integer) as store_ord, p_partkey % 20 + 1 as page,
         unnest(range(0, 3)) as pos,
         cast(floor(p_retailprice * 100 + 0.5::double) as bigint) as cents
  from part
),
placed as (
  select *, 'shop-' || store_ord as store,
         case when store_ord % 11 = 10 then 'magento' when store_ord % 3 = 0 then 'shopify'
              else 'woocommerce' end as platform,
         cast(p_partkey * 10 + pos as varchar) as product_id
  from raw
  where not (store_ord % 5 = 4 and page >= 18)
),
mapped as (
  select platform, store, store_ord, page, pos, product_id,
         case when platform = 'shopify' and (p_partkey + pos) % 29 = 0 then ''
              else p_name || ' ' || pos end as name,
         case when platform = 'shopify' then p_brand else 'Short  ' || p_brand end
           as description,
         p_type as category,
         case when platform <> 'shopify' then (cents + 100) / 100.0::double
              when p_partkey % 4 = 0 then (p_retailprice + pos) * 1.25::double
              else p_retailprice + pos end as price,
         case when platform <> 'shopify' then (cents - pos * 50) / 100.0::double
              when p_partkey % 4 = 0 then p_retailprice + pos end as promotional_price,
         case when platform = 'shopify' or p_partkey % 52 = 0
              then (30 + {hash_sql('product_id')} % 21) / 10.0::double
              else cast(p_partkey % 52 as double) / 10 end as rating,
         case when platform = 'shopify' or p_partkey % 52 = 0
              then {hash_sql('product_id')} % 851
              else p_partkey % 9 + 1 end as review_count,
         case when p_size % 3 <> 0 then 'in_stock' else 'out_of_stock' end as stock_status
  from placed where platform <> 'magento'
),
good as (select * from mapped where name <> '' and rating <= 5)"""

_OUT = (
    "platform",
    "store",
    "page",
    "pos",
    "product_id",
    "name",
    "description",
    "category",
    "price",
    "promotional_price",
    "rating",
    "review_count",
    "stock_status",
)


def _shown(products: DataFrame) -> DataFrame:
    return products.select(
        *[F.col(c).cast("bigint") if c in ("page", "pos") else F.col(c) for c in _OUT]
    )


@query("ingest_products", f"with {LANDED} select {', '.join(_OUT)} from good")
def ingest_products(spark, sf):
    found = ingest.ingest_pages(landed(spark, sf), stores(spark, sf), max_products=None)
    return _shown(found.products)


@query(
    "ingest_shopify_pages",
    f"with {LANDED} select {', '.join(_OUT)} from good where platform = 'shopify'",
)
def ingest_shopify_pages(spark, sf):
    return _shown(contracts.valid(page_source.shopify_products(landed(spark, sf))))


@query(
    "ingest_woo_pages",
    f"with {LANDED} select {', '.join(_OUT)} from good where platform = 'woocommerce'",
)
def ingest_woo_pages(spark, sf):
    return _shown(contracts.valid(page_source.woo_products(landed(spark, sf))))


@query(
    "ingest_quarantine",
    f"""with {LANDED}
    select platform, store, product_id,
           case when name = '' then 'name_empty' else 'rating_out_of_range' end as reasons
    from mapped where name = '' or rating > 5""",
)
def ingest_quarantine(spark, sf):
    found = ingest.ingest_pages(landed(spark, sf), stores(spark, sf), max_products=None)
    return found.quarantine.select(
        "platform", "store", "product_id", F.array_join("reasons", ",").alias("reasons")
    )


@query(
    "ingest_summary",
    f"""with {LANDED},
    stores as (
      select distinct cast(floor(p_partkey / 20) as integer) as store_ord from part),
    counted as (
      select s.store_ord, count(g.product_id) as n
      from stores s left join good g using (store_ord) group by s.store_ord)
    select count(*) filter (where n > 0) as successful_stores,
           count(*) filter (where n = 0) as failed_stores,
           cast(sum(n) as bigint) as total_products
    from counted""",
)
def ingest_summary(spark, sf):
    return ingest.ingest_pages(landed(spark, sf), stores(spark, sf)).summary


@query(
    "catalog_cap",
    f"""with {LANDED}
    select {', '.join(_OUT)}, row_no from (
      select *, row_number() over (order by store_ord, page, pos) as row_no from good)
    where row_no <= 3000""",
)
def catalog_cap(spark, sf):
    found = ingest.ingest_pages(landed(spark, sf), stores(spark, sf), max_products=3000)
    capped = found.products.select(*_OUT, "row_no")
    return capped.withColumns({c: F.col(c).cast("bigint") for c in ("page", "pos")})


@query(
    "dedupe_products",
    """select l_suppkey % 10 as store, l_partkey as product_id,
              min(l_orderkey * 100 + l_linenumber) as first_seen
    from lineitem group by 1, 2""",
)
def dedupe_products(spark, sf):
    copies = table(spark, sf, "lineitem").select(
        F.lit("shopify").alias("platform"),
        (F.col("l_suppkey") % 10).alias("store"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("first_seen"),
    )
    return catalog.dedupe_products(copies, order=("first_seen",)).drop("platform")


@query(
    "product_contract",
    """select cast(l_orderkey as varchar) as product_id,
           concat_ws(',',
             case when l_quantity - 3 < 0 then 'price_negative' end,
             case when l_discount > 0.08::double and l_tax - 0.02::double < 0
                  then 'promotional_price_negative' end,
             case when l_quantity / 9 > 5 then 'rating_out_of_range' end,
             case when l_linenumber - 2 < 0 then 'review_count_negative' end,
             case when l_returnflag = 'N' then 'stock_status_empty' end) as reasons
    from lineitem""",
)
def product_contract(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("product_id"),
        F.lit(" x ").alias("name"),
        F.lit("").alias("description"),
        F.lit("unknown").alias("category"),
        (F.col("l_quantity") - 3).alias("price"),
        F.when(F.col("l_discount") > 0.08, F.col("l_tax") - 0.02).alias("promotional_price"),
        (F.col("l_quantity") / 9).alias("rating"),
        (F.col("l_linenumber") - 2).cast("bigint").alias("review_count"),
        F.when(F.col("l_returnflag") == "N", "  ").otherwise("in_stock").alias("stock_status"),
    )
    return contracts.check_products(rows).select("product_id", "reasons")


@query(
    "product_json_round_trip",
    f"with {LANDED} select {', '.join(_OUT[4:])} from good",
)
def product_json_round_trip(spark, sf):
    found = ingest.ingest_pages(landed(spark, sf), stores(spark, sf), max_products=None)
    path = scratch_path(spark, "products")
    tables.write_json(found.products.select(*contracts.PRODUCT_COLUMNS), path)
    return contracts.valid(tables.read_products(spark, path)).select(*_OUT[4:])
