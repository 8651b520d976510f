"""Row schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

VARIANT = T.StructType(
    [
        T.StructField("variant_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("compare_at_price", T.DoubleType()),
        T.StructField("inventory_quantity", T.IntegerType()),
        T.StructField("available", T.BooleanType()),
    ]
)

PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("promotional_price", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("stock_status", T.StringType()),
        T.StructField("variants", T.ArrayType(VARIANT)),
    ]
)

# What tells products apart: shops may share an id.
SHOP = T.StructType(
    [T.StructField("platform", T.StringType()), T.StructField("store", T.StringType())]
)
PRODUCT_KEY = (*SHOP.fieldNames(), "product_id")

# The five categories of the taxonomy.
TAXONOMY = ("Electronics", "Apparel", "Home", "Health", "Unknown")

ENRICHMENT = T.StructType(
    [
        T.StructField("standardized_category", T.StringType()),
        T.StructField("short_summary", T.StringType()),
        T.StructField("extracted_tags", T.ArrayType(T.StringType())),
    ]
)

ENRICHED = T.StructType(PRODUCT.fields + ENRICHMENT.fields)

SCORES = T.StructType(
    [
        T.StructField("top_product_probability", T.DoubleType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("cluster_quality_score", T.DoubleType()),
        T.StructField("final_score", T.DoubleType()),
        T.StructField("pca_1", T.DoubleType()),
        T.StructField("pca_2", T.DoubleType()),
    ]
)

SCORED = T.StructType(ENRICHED.fields + SCORES.fields)

RULE = T.StructType(
    [
        T.StructField("antecedents", T.ArrayType(T.StringType())),
        T.StructField("consequents", T.ArrayType(T.StringType())),
        T.StructField("antecedents_names", T.ArrayType(T.StringType())),
        T.StructField("consequents_names", T.ArrayType(T.StringType())),
        T.StructField("support", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("lift", T.DoubleType()),
    ]
)

# Payload shapes of the two platforms. Amounts arrive as text; identifiers as numbers.
SHOPIFY_VARIANT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("compare_at_price", T.StringType()),
        T.StructField("inventory_quantity", T.StringType()),
        T.StructField("available", T.BooleanType()),
    ]
)

SHOPIFY_PRODUCT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body_html", T.StringType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("variants", T.ArrayType(SHOPIFY_VARIANT)),
    ]
)

WOO_VARIANT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("regular_price", T.StringType()),
        T.StructField(
            "prices",
            T.StructType(
                [
                    T.StructField("price", T.StringType()),
                    T.StructField("regular_price", T.StringType()),
                ]
            ),
        ),
        T.StructField("is_in_stock", T.BooleanType()),
    ]
)

WOO_PRODUCT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("short_description", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("regular_price", T.StringType()),
        T.StructField("sale_price", T.StringType()),
        T.StructField(
            "prices",
            T.StructType(
                [
                    T.StructField("price", T.StringType()),
                    T.StructField("regular_price", T.StringType()),
                    T.StructField("sale_price", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "categories",
            T.ArrayType(T.StructType([T.StructField("name", T.StringType())])),
        ),
        T.StructField("is_in_stock", T.BooleanType()),
        T.StructField("average_rating", T.StringType()),
        T.StructField("review_count", T.StringType()),
        T.StructField("rating_count", T.StringType()),
        T.StructField("variations", T.ArrayType(WOO_VARIANT)),
    ]
)

# Columns a feature job needs.
FEATURE_INPUTS = (
    "product_id",
    "price",
    "promotional_price",
    "rating",
    "review_count",
    "stock_status",
    "standardized_category",
)

# Columns that never enter the feature matrix.
NON_FEATURES = (
    "is_top_product",
    "product_id",
    "name",
    "description",
    "category",
    "short_summary",
    "extracted_tags",
    "variants",
)

# The three columns that are clustered and projected.
CLUSTER_INPUTS = ("price", "rating", "reviews")
