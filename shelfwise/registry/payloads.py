"""Checks of the payload expressions: every line item is one shop listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import impute, prices, text
from shelfwise.operators import catalog, contracts
from shelfwise.registry import query
from shelfwise.registry.data import spread_table, table
from shelfwise.schemas import SHOPIFY_PRODUCT, WOO_PRODUCT

# A listing carries as many variants as its line number modulo 4.


def _variants(make) -> Column:
    numbers = F.array(F.lit(0), F.lit(1), F.lit(2))
    return F.transform(F.filter(numbers, lambda i: i < F.col("l_linenumber") % 4), make)


def _listing_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def shopify_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw Shopify products as JSON texts (null fields are left out)."""

    def variant(i: Column) -> Column:
        price = F.col("l_extendedprice") * (i + 10) / 10
        return F.struct(
            (F.col("l_partkey") * 10 + i).alias("id"),
            F.concat(F.lit("V"), i.cast("string")).alias("title"),
            F.when(
                (F.col("l_suppkey") + i) % 5 != 0,
                F.concat(F.lit("S"), F.col("l_suppkey").cast("string")),
            ).alias("sku"),
            F.when((F.col("l_suppkey") + i) % 7 == 0, F.lit(""))
            .when((F.col("l_partkey") + i) % 11 != 0, price.cast("string"))
            .alias("price"),
            F.when(F.col("l_discount") == 0, None)
            .when((F.col("l_partkey") + i) % 5 == 0, F.lit(""))
            .otherwise((price / (1 - F.col("l_discount"))).cast("string"))
            .alias("compare_at_price"),
            F.when(
                (F.col("l_orderkey") + i) % 3 != 0, F.col("l_quantity").cast("int") + i
            ).alias("inventory_quantity"),
            F.when(
                i < 2, (F.col("l_linestatus") == "O") & ((F.col("l_suppkey") + i) % 2 == 0)
            ).alias("available"),
        )

    product = F.struct(
        _listing_id().alias("id"),
        F.when(
            F.col("l_suppkey") % 17 != 0,
            F.concat(F.lit(" Item "), F.col("l_partkey").cast("string"), F.lit("\t")),
        ).alias("title"),
        F.concat(
            F.lit("<p class='x'>Lot <b>"), F.col("l_orderkey").cast("string"), F.lit("</b>\n</p>")
        ).alias("body_html"),
        F.when(F.col("l_returnflag") == "A", " Tools ")
        .when(F.col("l_returnflag") == "N", "")
        .otherwise(F.col("l_returnflag"))
        .alias("product_type"),
        _variants(variant).alias("variants"),
    )
    return spread_table(spark, sf, "lineitem").select(
        F.lit("shopify").alias("platform"),
        (F.col("l_suppkey") % 10).cast("string").alias("store"),
        F.lit(1).alias("page"),
        F.col("l_linenumber").alias("pos"),
        F.to_json(product).alias("raw"),
    )


SHOPIFY = """
listing as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as product_id,
         case when l_suppkey % 17 <> 0 then 'Item ' || l_partkey end as name,
         'Lot  ' || l_orderkey as description,
         case l_returnflag when 'A' then 'Tools' when 'N' then 'unknown'
              else l_returnflag end as category,
         list_transform(range(0, l_linenumber % 4), lambda i: struct_pack(
           ord := i,
           variant_id := cast(l_partkey * 10 + i as varchar),
           title := 'V' || i,
           sku := case when (l_suppkey + i) % 5 <> 0 then 'S' || l_suppkey else '' end,
           price := case when (l_suppkey + i) % 7 = 0 or (l_partkey + i) % 11 = 0 then 0.0
                         else l_extendedprice * (i + 10) / 10 end,
           compare_at_price := case when l_discount = 0 or (l_partkey + i) % 5 = 0 then null
                else l_extendedprice * (i + 10) / 10 / (1 - l_discount) end,
           inventory_quantity := cast(case when (l_orderkey + i) % 3 <> 0
                then cast(l_quantity as bigint) + i else 0 end as integer),
           available := i < 2 and l_linestatus = 'O' and (l_suppkey + i) % 2 = 0)) as variants
  from lineitem
),
priced as (
  select *, coalesce(list_min(list_transform(variants, lambda v: v.price)), 0.0) as cur,
         list_min(list_transform(variants, lambda v: v.compare_at_price)) as cmp,
         len(list_filter(variants, lambda v: v.available)) > 0 as any_available
  from listing
)"""


def _shopify_parsed(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    return shopify_listings(spark, sf).select(
        F.from_json("raw", SHOPIFY_PRODUCT).alias("p")
    ).select(
        p["id"].alias("product_id"),
        p["body_html"].alias("body_html"),
        p["product_type"].alias("product_type"),
        prices.shopify_variants(p["variants"]).alias("variants"),
    )


def _exploded(df: DataFrame) -> DataFrame:
    """One row per variant. A plain generator would first filter on the size of its array,
    below the projections, and so make and parse every payload twice."""
    return (
        df.select("product_id", F.posexplode_outer("variants").alias("ord", "v"))
        .where("ord is not null")
        .select("product_id", F.col("ord").cast("bigint").alias("ord"), "v.*")
    )


@query(
    "shopify_variants",
    f"""with {SHOPIFY}, v as (select product_id, unnest(variants) as v from listing)
    select product_id, v.ord as ord, v.variant_id as variant_id, v.title as title,
           v.sku as sku, v.price as price, v.compare_at_price as compare_at_price,
           v.inventory_quantity as inventory_quantity, v.available as available
    from v""",
)
def shopify_variants(spark, sf):
    return _exploded(_shopify_parsed(spark, sf))


@query(
    "shopify_price",
    f"""with {SHOPIFY}
    select product_id, case when cmp > cur then cmp else cur end as price,
           case when cmp > cur then cur end as promotional_price
    from priced""",
)
def shopify_price(spark, sf):
    price, promo = prices.shopify_price(F.col("variants"))
    return _shopify_parsed(spark, sf).select(
        "product_id", price.alias("price"), promo.alias("promotional_price")
    )


@query(
    "shopify_stock_status",
    f"""with {SHOPIFY}
    select product_id,
           case when any_available then 'in_stock' else 'out_of_stock' end as stock_status
    from priced""",
)
def shopify_stock(spark, sf):
    status = prices.stock_status(prices.shopify_in_stock(F.col("variants")))
    return _shopify_parsed(spark, sf).select("product_id", status.alias("stock_status"))


@query("category_default", f"with {SHOPIFY} select product_id, category from listing")
def category_default(spark, sf):
    return _shopify_parsed(spark, sf).select(
        "product_id", text.category_or_unknown(F.col("product_type")).alias("category")
    )


PRODUCT_OUT = (
    "product_id",
    "name",
    "description",
    "category",
    "price",
    "promotional_price",
    "rating",
    "review_count",
    "stock_status",
    "is_imputed",
)

_HASH = "cast(('0x' || substr(md5({0}), 1, 8)) as bigint)"


def hash_sql(expression: str) -> str:
    return _HASH.format(expression)


SHOPIFY_ROWS = f"""select product_id, name, description, category,
       case when cmp > cur then cmp else cur end as price,
       case when cmp > cur then cur end as promotional_price,
       (30 + {hash_sql('product_id')} % 21) / 10.0::double as rating,
       {hash_sql('product_id')} % 851 as review_count,
       case when any_available then 'in_stock' else 'out_of_stock' end as stock_status,
       true as is_imputed
from priced"""


@query("shopify_products", f"with {SHOPIFY} {SHOPIFY_ROWS} where name is not null")
def shopify_products(spark, sf):
    mapped = catalog.map_shopify(shopify_listings(spark, sf))
    return contracts.valid(mapped).select(*PRODUCT_OUT)


@query(
    "shopify_quarantine",
    f"""with {SHOPIFY}
    select product_id, 'name_empty' as reasons from listing where name is null""",
)
def shopify_quarantine(spark, sf):
    mapped = catalog.map_shopify(shopify_listings(spark, sf))
    return contracts.quarantine(mapped).withColumn("reasons", F.array_join("reasons", ","))


def woo_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw WooCommerce products as JSON texts; amounts in cents."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint")
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")

    def variant(i: Column) -> Column:
        own = cents + i * 100
        return F.struct(
            (part * 10 + i).alias("id"),
            F.concat(F.lit("V"), i.cast("string")).alias("name"),
            F.when((supp + i) % 3 != 0, own.cast("string")).alias("price"),
            F.when((part + i) % 4 != 0, (own + (supp % 3) * 50).cast("string")).alias(
                "regular_price"
            ),
            F.when(
                (supp + i) % 2 == 0,
                F.struct(
                    (own + 1).cast("string").alias("price"),
                    (own + 7).cast("string").alias("regular_price"),
                ),
            ).alias("prices"),
            F.when(i == 1, F.col("l_linestatus") == "O").alias("is_in_stock"),
        )

    product = F.struct(
        _listing_id().alias("id"),
        F.concat(F.lit("Item "), part.cast("string")).alias("name"),
        F.when(line % 2 == 0, F.lit("")).otherwise(F.lit("<i>Long</i> text")).alias("description"),
        F.concat(F.lit("<b>Short</b> "), part.cast("string")).alias("short_description"),
        F.when(line % 3 != 0, cents.cast("string")).alias("price"),
        F.when(supp % 2 == 0, (cents + 200).cast("string")).otherwise("").alias("regular_price"),
        F.when(part % 4 == 0, (cents - 100 * (supp % 3)).cast("string")).alias("sale_price"),
        F.when(
            line % 2 == 0,
            F.struct(
                (cents + 10).cast("string").alias("price"),
                F.when(part % 3 == 0, (cents + 500).cast("string")).alias("regular_price"),
                F.when(part % 5 == 0, (cents - 300).cast("string")).alias("sale_price"),
            ),
        ).alias("prices"),
        F.when(
            part % 6 != 0, F.array(F.struct(F.col("l_returnflag").alias("name")))
        ).otherwise(F.array().cast("array<struct<name:string>>")).alias("categories"),
        F.when(supp % 4 != 0, F.col("l_linestatus") == "O").alias("is_in_stock"),
        F.when(part % 7 != 0, ((part % 60) / 10).cast("string")).alias("average_rating"),
        F.when(supp % 5 != 0, supp % 9).alias("review_count"),
        (part % 4).alias("rating_count"),
        _variants(variant).alias("variations"),
    )
    return spread_table(spark, sf, "lineitem").select(
        F.lit("woocommerce").alias("platform"),
        (supp % 10).cast("string").alias("store"),
        F.lit(1).alias("page"),
        line.alias("pos"),
        F.to_json(product).alias("raw"),
    )


WOO = f"""
base as (
  select *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as product_id,
         cast(floor(l_extendedprice * 100 + 0.5::double) as bigint) as cents
  from lineitem
),
listing as (
  select *,
         case when l_linenumber % 2 = 0 then cents + 10
              when l_linenumber % 3 <> 0 then cents end as raw_price,
         case when l_linenumber % 2 = 0 and l_partkey % 3 = 0 then cents + 500
              when l_suppkey % 2 = 0 then cents + 200 end as raw_regular,
         case when l_linenumber % 2 = 0 and l_partkey % 5 = 0 then cents - 300
              when l_partkey % 4 = 0 then cents - 100 * (l_suppkey % 3) end as raw_sale,
         case when l_partkey % 7 <> 0 then cast(l_partkey % 60 as double) / 10
              else 0.0 end as given_rating,
         case when l_suppkey % 5 <> 0 then l_suppkey % 9 else l_partkey % 4 end as given_reviews,
         list_transform(range(0, l_linenumber % 4), lambda i: struct_pack(
           ord := i,
           variant_id := cast(l_partkey * 10 + i as varchar),
           title := 'V' || i,
           cost := case when (l_suppkey + i) % 3 <> 0 then cents + i * 100
                        when (l_suppkey + i) % 2 = 0 then cents + i * 100 + 1 end,
           reg := case when (l_partkey + i) % 4 <> 0 then cents + i * 100 + (l_suppkey % 3) * 50
                       when (l_suppkey + i) % 2 = 0 then cents + i * 100 + 7 end,
           available := case when i = 1 then l_linestatus = 'O' else true end)) as variants
  from base
),
priced as (
  select *, coalesce(raw_regular / 100.0::double, raw_price / 100.0::double, 0.0) as price,
         raw_sale / 100.0::double as sale,
         given_rating = 0 or given_reviews = 0 as lacking
  from listing
),
woo_rows as (
  select product_id, 'Item ' || l_partkey as name,
         case when l_linenumber % 2 = 0 then 'Short  ' || l_partkey else 'Long  text' end
           as description,
         case when l_partkey % 6 <> 0 then l_returnflag else 'unknown' end as category,
         price, case when sale > 0 and sale < price then sale end as promotional_price,
         case when lacking then (30 + {hash_sql('product_id')} % 21) / 10.0::double
              else given_rating end as rating,
         case when lacking then {hash_sql('product_id')} % 851 else given_reviews end
           as review_count,
         case when l_suppkey % 4 = 0 or l_linestatus = 'O' then 'in_stock'
              else 'out_of_stock' end as stock_status,
         lacking as is_imputed
  from priced
)"""


def _woo_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return woo_listings(spark, sf).select(F.from_json("raw", WOO_PRODUCT).alias("p"))


@query(
    "woo_variants",
    f"""with {WOO}, v as (select product_id, unnest(variants) as v from listing),
    amounts as (
      select product_id, v, coalesce(v.cost / 100.0::double, 0.0) as price,
             coalesce(v.reg / 100.0::double, v.cost / 100.0::double, 0.0) as reg from v)
    select product_id, v.ord as ord, v.variant_id as variant_id, v.title as title, price,
           case when reg > price then reg end as compare_at_price, v.available as available
    from amounts""",
)
def woo_variants(spark, sf):
    p = F.col("p")
    parsed = _woo_parsed(spark, sf).select(
        p["id"].alias("product_id"),
        prices.woo_variants(p["variations"]).alias("variants"),
    )
    return _exploded(parsed).drop("sku", "inventory_quantity")


@query(
    "woo_price",
    f"with {WOO} select product_id, price, promotional_price from woo_rows",
)
def woo_price(spark, sf):
    price, promo = prices.woo_price(F.col("p"))
    return _woo_parsed(spark, sf).select(
        F.col("p.id").alias("product_id"), price.alias("price"), promo.alias("promotional_price")
    )


@query("woo_products", f"with {WOO} select * from woo_rows where rating <= 5")
def woo_products(spark, sf):
    mapped = catalog.map_woo(woo_listings(spark, sf))
    return contracts.valid(mapped).select(*PRODUCT_OUT)


@query(
    "woo_quarantine",
    f"""with {WOO} select product_id, 'rating_out_of_range' as reasons
    from woo_rows where rating > 5""",
)
def woo_quarantine(spark, sf):
    mapped = catalog.map_woo(woo_listings(spark, sf))
    return contracts.quarantine(mapped).withColumn("reasons", F.array_join("reasons", ","))


_EDGE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)


@query(
    "strip_html_pages",
    rf"""select page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
           '^{_EDGE}|{_EDGE}$', '', 'g') as description
    from pages""",
)
def strip_html_pages(spark, sf):
    return spread_table(spark, sf, "pages", "page_id", "html").select(
        "page_id", text.strip_html(F.col("html")).alias("description")
    )


@query(
    "imputed_ratings",
    f"""select cast(o_orderkey as varchar) as product_id,
           (30 + {hash_sql('cast(o_orderkey as varchar)')} % 21) / 10.0::double as rating,
           {hash_sql('cast(o_orderkey as varchar)')} % 851 as review_count
    from orders""",
)
def imputed_ratings(spark, sf):
    product_id = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders", "o_orderkey").select(
        product_id.alias("product_id"),
        impute.imputed_rating(product_id).alias("rating"),
        impute.imputed_review_count(product_id).alias("review_count"),
    )
