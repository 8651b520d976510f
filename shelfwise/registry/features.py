"""Checks of the feature columns, the label and the hold-out split."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise.operators import features, quantiles, sparse, split
from shelfwise.registry import query
from shelfwise.registry.data import CATALOG, FILLED, catalog, catalog_table, prepared, table
from shelfwise.schemas import TAXONOMY
from shelfwise.session import scratch_path, written
from shelfwise.sources import tables


@query(
    "numeric_coercion",
    """select event_id, try_cast(raw as double) as number,
              coalesce(try_cast(raw as double), 0.0::double) as filled
    from (select event_id, case event_type when 'view' then 'n/a' when 'click' then ''
                 else cast(value as varchar) end as raw from events)""",
)
def numeric_coercion(spark, sf):
    raw = (
        F.when(F.col("event_type") == "view", "n/a")
        .when(F.col("event_type") == "click", "")
        .otherwise(F.col("value").cast("string"))
    )
    number = raw.try_cast("double")
    return table(spark, sf, "events", "event_id", "event_type", "value").select(
        "event_id", number.alias("number"), F.coalesce(number, F.lit(0.0)).alias("filled")
    )


@query(
    "medians",
    f"with {CATALOG} select median(rating) as rating, median(price) as price from catalog",
)
def medians(spark, sf):
    m = features.fit_medians(features.coerce_numbers(catalog(spark, sf)))
    return spark.createDataFrame([(m.rating, m.price)], "rating double, price double")


@query(
    "exact_quantiles",
    """select round(quantile_cont(l_extendedprice, 0.5), 6) as price_median,
              round(quantile_cont(l_extendedprice, 0.7), 6) as price_cut,
              round(quantile_cont(l_discount, 0.7), 6) as discount_cut,
              quantile_cont(cast(l_suppkey as double), 0.99) as supplier_cut
    from lineitem""",
)
def exact_quantiles(spark, sf):
    """By narrowing down ranks."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    q = quantiles.exact_quantiles(
        table(spark, sf, "lineitem", "l_extendedprice", "l_discount", "l_suppkey"),
        {
            "price_median": (price, 0.5),
            "price_cut": (price, 0.7),
            "discount_cut": (discount, 0.7),
            "supplier_cut": (F.col("l_suppkey"), 0.99),
        },
    )
    row = [tuple(round(v, 6) for v in q.values())]
    return spark.createDataFrame(row, ", ".join(f"{n} double" for n in q))


@query(
    "label_cuts",
    f"""with {FILLED}
    select round(rating_cut, 9) as rating, round(review_cut, 9) as reviews,
           round(discount_cut, 9) as discount
    from cuts""",
)
def label_cuts(spark, sf):
    df = catalog_table(spark, sf)
    filled = features.fill(df, features.fit_medians(features.coerce_numbers(df)))
    c = features.fit_cuts(filled)
    row = [(round(c.rating, 9), round(c.reviews, 9), round(c.discount, 9))]
    return spark.createDataFrame(row, "rating double, reviews double, discount double")


@query(
    "filled_features",
    f"""with {FILLED}
    select product_id, price, promotional_price, rating, review_count, stock_status,
           standardized_category, is_in_stock, discount_ratio
    from discounted""",
)
def filled_features(spark, sf):
    df = catalog_table(spark, sf)
    filled = features.fill(df, features.fit_medians(features.coerce_numbers(df)))
    return filled.select(
        "product_id",
        "price",
        "promotional_price",
        "rating",
        "review_count",
        "stock_status",
        "standardized_category",
        "is_in_stock",
        "discount_ratio",
    )


@query(
    "top_product_labels",
    f"with {FILLED} select product_id, is_top_product from labelled",
)
def top_product_labels(spark, sf):
    return prepared(spark, sf)[0].select("product_id", "is_top_product")


@query(
    "top_product_label_counts",
    f"""with {FILLED}
    select standardized_category, count(*) as products,
           cast(sum(is_top_product) as bigint) as positive,
           round(avg(price), 6) as avg_price
    from labelled group by 1""",
)
def top_product_label_counts(spark, sf):
    return prepared(spark, sf)[0].groupBy("standardized_category").agg(
        F.count("*").alias("products"),
        F.sum("is_top_product").alias("positive"),
        F.round(F.avg("price"), 6).alias("avg_price"),
    )


_FALLBACK = """
scores as (
  select product_id, discount_ratio * 0.5::double + rating * 0.3::double
         + is_in_stock * 0.2::double as score,
         cast(('0x' || substr(md5(product_id), 1, 13)) as bigint) as tie
  from discounted where stock_status <> 'in_stock'
),
ranked as (
  select *, row_number() over (order by score desc, tie) as n, count(*) over () as rows
  from scores
)"""


@query(
    "fallback_labels",
    f"""with {FILLED}, {_FALLBACK}
    select product_id,
           cast(case when n <= least(greatest(case when rows >= 4 then 2 else 1 end,
                                              round_even(rows * 0.2, 0)), rows - 1)
                then 1 else 0 end as integer) as is_top_product
    from ranked""",
)
def fallback_labels(spark, sf):
    """Only products that are not in stock: the rule gives them all the same label."""
    df = catalog_table(spark, sf)
    filled = features.fill(df, features.fit_medians(features.coerce_numbers(df)))
    cuts = features.fit_cuts(filled)
    rest = filled.where("stock_status <> 'in_stock'")
    fallback = features.fit_fallback(rest, cuts)
    return features.add_label(rest, cuts, fallback).select("product_id", "is_top_product")


_CAT_SQL = ", ".join(
    f"case when standardized_category = '{c}' then 1 else 0 end as \"cat_{c}\""
    for c in sorted(TAXONOMY)
)
_STOCK_SQL = ", ".join(
    f"case when stock_status = '{s}' then 1 else 0 end as \"stock_{s}\""
    for s in ("in_stock", "out_of_stock", "unknown")
)


@query(
    "one_hot_features",
    f"""with {FILLED}
    select product_id, {_CAT_SQL}, {_STOCK_SQL},
           cast(review_count as double) as reviews
    from labelled""",
)
def one_hot_features(spark, sf):
    df, model = prepared(spark, sf)
    encoded = features.add_reviews(features.one_hot(df, model.vocabulary))
    hot = [c for c in encoded.columns if c.startswith(("cat_", "stock_"))]
    return encoded.select("product_id", *hot, "reviews")


_MATRIX_SQL = ", ".join(
    f"cast({c} as double) as {c}"
    for c in ("price", "promotional_price", "rating", "review_count", "is_in_stock",
              "discount_ratio")
) + ", " + ", ".join(
    f"cast(case when {column} = '{v}' then 1 else 0 end as double) as \"{prefix}_{v}\""
    for column, prefix, values in (
        ("standardized_category", "cat", sorted(TAXONOMY)),
        ("stock_status", "stock", ("in_stock", "out_of_stock", "unknown")),
    )
    for v in values
)


@query(
    "feature_matrix",
    f"with {FILLED} select {_MATRIX_SQL}, cast(review_count as double) as reviews from labelled",
)
def feature_matrix(spark, sf):
    df = catalog_table(spark, sf)
    return features.feature_matrix(features.fit(df).transform(df))


@query(
    "feature_table_round_trip",
    f"""with {FILLED}
    select product_id, price, rating, discount_ratio, is_top_product,
           cast(review_count as double) as reviews
    from labelled""",
)
def feature_table_round_trip(spark, sf):
    df = catalog_table(spark, sf)
    path = scratch_path(spark, "features")
    tables.write_features(features.fit(df).transform(df), path)
    required = ("product_id", "is_top_product", "price", "rating", "reviews")
    return tables.read_features(spark, path, required).select(
        "product_id", "price", "rating", "discount_ratio", "is_top_product", "reviews"
    )


@query(
    "class_profile",
    """select count(*) as class_count, min(n) as min_class_count
    from (select quality, count(*) as n from labels group by quality)""",
)
def class_profile(spark, sf):
    return split.class_profile(table(spark, sf, "labels"), "quality")


_SPLIT = """
sizes as (
  select is_top_product, count(*) as n, ceil(sum(count(*)) over () * 0.2) as wanted,
         sum(count(*)) over () as rows
  from labelled group by is_top_product
),
shares as (
  select *, floor(wanted * n / rows) as base,
         wanted * n / rows - floor(wanted * n / rows) as fraction
  from sizes
),
allotted as (
  select is_top_product,
         base + case when row_number() over (order by fraction desc, is_top_product)
                          <= wanted - sum(base) over () then 1 else 0 end as test_rows
  from shares
),
dealt as (
  select product_id, is_top_product,
         row_number() over (partition by is_top_product order by
           cast(('0x' || substr(md5(product_id), 1, 13)) as bigint)) as n
  from labelled
)"""


@query(
    "stratified_split",
    f"""with {FILLED}, {_SPLIT}
    select product_id, is_top_product, n <= test_rows as is_test
    from dealt join allotted using (is_top_product)""",
)
def stratified_split(spark, sf):
    rows = written(prepared(spark, sf)[0].select("product_id", "is_top_product"), "labels")
    return split.with_test_flag(rows, "is_top_product")


@query(
    "sparse_one_hot",
    """with v as (
      select lower(value) as value, row_number() over (order by lower(value)) - 1 as n
      from (select distinct lower(p_name) as value from part))
    select cast(p_partkey as varchar) as product_id, lower(p_name) as name, n as active_index,
           (select count(*) from v) as vector_size
    from part join v on v.value = lower(p_name)""",
)
def sparse_one_hot(spark, sf):
    products = table(spark, sf, "part", "p_partkey", "p_name").withColumn("name", F.col("p_name"))
    vocabulary = sparse.fit_vocabulary(products, ["p_name"])
    entries = vector_to_array("p_name_vector")
    return sparse.one_hot_vectors(products, vocabulary, ["p_name"]).select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.lower("name").alias("name"),
        (F.array_position(entries, 1.0) - 1).alias("active_index"),
        F.size(entries).cast("bigint").alias("vector_size"),
    )
