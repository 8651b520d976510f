"""Catalogue-shaped views over the given tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import features, models, scoring
from shelfwise.session import spread, written


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread_table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """The same for queries that work hard on every row."""
    return spread(table(spark, sf, name, *columns))


# Part types as categories of the taxonomy; SMALL stays without one.
CATEGORY_OF_TYPE = {
    "PROMO": "Electronics",
    "STANDARD": "Apparel",
    "ECONOMY": "Home",
    "MEDIUM": "Health",
    "LARGE": "Unknown",
}


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as products; line items per part are their review counts."""
    key = F.col("p_partkey")
    reviews = (
        table(spark, sf, "lineitem", "l_partkey")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("n"))
    )
    category = F.lit(None).cast("string")
    for kind, name in CATEGORY_OF_TYPE.items():
        category = F.when(F.col("p_type") == kind, name).otherwise(category)
    return (
        table(spark, sf, "part")
        .join(reviews, F.col("l_partkey") == key, "left")
        .select(
            key.cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("vendor"),
            F.col("p_retailprice").alias("price"),
            F.when(
                key % 3 != 0, F.col("p_retailprice") * (100 - F.col("p_size")) / 100
            ).alias("promotional_price"),
            F.when(key % 11 != 0, ((key * 7) % 41).cast("double") / 10 + 1).alias("rating"),
            F.coalesce("n", F.lit(0)).alias("review_count"),
            F.when(key % 13 == 0, None)
            .when(F.col("p_size") % 5 == 0, "out_of_stock")
            .otherwise("in_stock")
            .alias("stock_status"),
            category.alias("standardized_category"),
        )
    )


def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same, written once, for jobs that read it several times."""
    return written(catalog(spark, sf), "catalog")


CATALOG = """
catalog as (
  select cast(p_partkey as varchar) as product_id, p_name as name, p_type as category,
         p_brand as vendor, p_retailprice as price,
         case when p_partkey % 3 = 0 then null
              else p_retailprice * (100 - p_size) / 100 end as promotional_price,
         case when p_partkey % 11 = 0 then null
              else cast((p_partkey * 7) % 41 as double) / 10 + 1 end as rating,
         coalesce(n, 0) as review_count,
         case when p_partkey % 13 = 0 then null
              when p_size % 5 = 0 then 'out_of_stock' else 'in_stock' end as stock_status,
         case p_type when 'PROMO' then 'Electronics' when 'STANDARD' then 'Apparel'
              when 'ECONOMY' then 'Home' when 'MEDIUM' then 'Health'
              when 'LARGE' then 'Unknown' end as standardized_category
  from part left join
       (select l_partkey, count(*) as n from lineitem group by l_partkey) s
    on l_partkey = p_partkey
)"""

FILLED = (
    CATALOG
    + """,
medians as (select median(rating) as rm, median(price) as pm from catalog),
filled as (
  select product_id, name, category, vendor,
         coalesce(price, pm) as price,
         coalesce(promotional_price, price, pm) as promotional_price,
         coalesce(rating, rm) as rating, review_count,
         coalesce(stock_status, 'unknown') as stock_status,
         coalesce(standardized_category, 'Unknown') as standardized_category,
         case when lower(stock_status) = 'in_stock' then 1 else 0 end as is_in_stock
  from catalog cross join medians
),
discounted as (
  select *, case when price = 0 then 0.0
                 else least(1.0, greatest(0.0, (price - promotional_price) / price))
            end as discount_ratio
  from filled
),
cuts as (
  select greatest(3.5, quantile_cont(rating, 0.7)) as rating_cut,
         greatest(1.0, quantile_cont(cast(review_count as double), 0.7)) as review_cut,
         greatest(0.10, quantile_cont(discount_ratio, 0.7)) as discount_cut
  from discounted
),
labelled as (
  select d.*, cast(case when is_in_stock = 1
                   and ((rating >= rating_cut and review_count >= review_cut)
                        or discount_ratio >= discount_cut)
              then 1 else 0 end as integer) as is_top_product
  from discounted d cross join cuts
)"""
)


def prepared(
    spark: SparkSession, sf: str, products: DataFrame | None = None
) -> tuple[DataFrame, features.FeatureModel]:
    """(filled and labelled products with their text columns, the fitted model).

    ``products`` is the catalogue, if the caller has written it already.
    """
    df = catalog_table(spark, sf) if products is None else products
    model = features.fit(df)
    return model.prepare(df), model


# A segmenter and a probability that need no fit.
SCALER = models.Scaler(("price", "rating", "reviews"), (1000.0, 3.0, 30.0), (200.0, 1.25, 6.0))
CENTRES = [[-0.4, 0.5, 0.25], [0.75, -1.0, -0.5], [1.5, 0.75, 1.0]]
LOADINGS = [[0.8, 0.36, 0.48], [-0.6, 0.48, 0.64]]
SEGMENTER = models.Segmenter(SCALER, CENTRES, LOADINGS, 1.0)


def fixed_probability() -> Column:
    return ((F.col("product_id").cast("bigint") * 37) % 101).cast("double") / 100


def assigned(spark: SparkSession, sf: str, products: DataFrame | None = None) -> DataFrame:
    """Prepared products with probability, cluster and projection from fixed constants."""
    df, _ = prepared(spark, sf, products)
    rows = features.add_reviews(df).withColumn("top_product_probability", fixed_probability())
    return SEGMENTER.assign(rows)


def scored(spark: SparkSession, sf: str, products: DataFrame | None = None) -> DataFrame:
    rows = assigned(spark, sf, products).withColumn(
        "stock_in_stock", (F.col("stock_status") == "in_stock").cast("int")
    )
    return scoring.add_final_score(scoring.add_cluster_quality(rows))


def _distance(centre: list[float]) -> str:
    return " + ".join(
        f"(x{i} - ({c}::double)) * (x{i} - ({c}::double))" for i, c in enumerate(centre)
    )


def _projection(loading: list[float]) -> str:
    return " + ".join(f"x{i} * ({w}::double)" for i, w in enumerate(loading))


ASSIGNED = (
    FILLED
    + f""",
scaled as (
  select *, cast(review_count as double) as reviews,
         cast((cast(product_id as bigint) * 37) % 101 as double) / 100
           as top_product_probability,
         (price - 1000.0::double) / 200.0::double as x0,
         (rating - 3.0::double) / 1.25::double as x1,
         (cast(review_count as double) - 30.0::double) / 6.0::double as x2
  from labelled
),
distances as (
  select *, {_distance(CENTRES[0])} as d0, {_distance(CENTRES[1])} as d1,
         {_distance(CENTRES[2])} as d2
  from scaled
),
assigned as (
  select *, cast(case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end
                 as integer) as cluster_id,
         {_projection(LOADINGS[0])} as pca_1, {_projection(LOADINGS[1])} as pca_2
  from distances
)"""
)

SCORED = (
    ASSIGNED
    + """,
quality as (
  select cluster_id, avg(rating) * 0.7::double + avg(reviews) * 0.3::double as cluster_score
  from assigned group by cluster_id
),
scored as (
  select a.*, q.cluster_score as cluster_quality_score,
         top_product_probability * 0.60::double + q.cluster_score * 0.15::double
         + rating * 0.15::double + reviews * 0.05::double
         + case when stock_status = 'in_stock' then 1.0 else 0.0 end * 0.05::double
           as final_score
  from assigned a join quality q using (cluster_id)
)"""
)
