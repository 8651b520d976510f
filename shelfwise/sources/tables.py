"""Tables between the stages: JSON at the edges, Parquet inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import contracts
from shelfwise.operators.baskets import KEPT_RULES, top_rules
from shelfwise.operators.report import SHOWN_RULES, shown_rules
from shelfwise.schemas import ENRICHED, PRODUCT, RULE, SCORED
from shelfwise.sources.json_arrays import read_elements

# Columns read as numbers from a result file.
NUMERIC_RESULTS = (
    "price",
    "promotional_price",
    "rating",
    "review_count",
    "final_score",
    "pca_1",
    "pca_2",
)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one record per line."""
    df.write.mode("overwrite").json(path)


def _records(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Raw JSON text per record, from JSON lines or from files holding one array."""
    if layout == "lines":
        return spark.read.text(path).select(F.col("value").alias("raw"))
    if layout != "array":
        raise ValueError(f"unknown layout {layout!r}")
    return read_elements(spark, path)


def _objects(records: DataFrame) -> DataFrame:
    return records.where(F.ltrim("raw").startswith("{"))


def _typed(records: DataFrame, schema: T.StructType) -> DataFrame:
    parsed = records.withColumn("p", F.from_json("raw", schema))
    return parsed.select("raw", "p.*")


def _with_defaults(df: DataFrame) -> DataFrame:
    """Values of keys a record may leave out."""
    return df.withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "category": F.coalesce("category", F.lit("unknown")),
            "review_count": F.coalesce("review_count", F.lit(0).cast("bigint")),
        }
    )


def read_products(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Raw products with the reasons that speak against a record.

    Records with unknown keys or broken rules are kept apart, not lost: use
    ``contracts.valid`` and ``contracts.quarantine``.
    """
    typed = _with_defaults(_typed(_records(spark, path, layout), PRODUCT))
    rules = contracts.product_rules() + contracts.unknown_key_rules(
        F.col("raw"), PRODUCT.fieldNames()
    )
    return contracts.check(typed, rules).drop("raw")


def read_enriched(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Enriched records; entries that are no objects are dropped, an empty table fails."""
    out = _typed(_objects(_records(spark, path, layout)), ENRICHED).drop("raw")
    contracts.require_rows(out, f"enriched table {path}")
    return out


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_features(
    spark: SparkSession, path: str, required: tuple[str, ...] = ("product_id",)
) -> DataFrame:
    """The model-ready table; fails without rows or without a required column."""
    df = spark.read.parquet(path)
    contracts.require_columns(df, required)
    contracts.require_rows(df, f"feature table {path}")
    return df


def write_topk(df: DataFrame, path: str) -> None:
    write_json(df, path)


def typed_results(df: DataFrame) -> DataFrame:
    """Read the result columns as numbers; what is no number becomes null."""
    columns = {
        c: F.col(c).try_cast("bigint" if c == "review_count" else "double")
        for c in NUMERIC_RESULTS
        if c in df.columns
    }
    if "cluster_id" in df.columns:
        columns["cluster_id"] = F.col("cluster_id").try_cast("int")
    return df.withColumns(columns)


def _read_json(spark: SparkSession, path: str, schema: T.StructType, layout: str) -> DataFrame:
    """Typed records from JSON lines or from files holding one array."""
    return spark.read.schema(schema).json(path, multiLine=layout == "array")


def read_topk(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    as_text = T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if f.name in (*NUMERIC_RESULTS, "cluster_id") else f.dataType,
            )
            for f in SCORED
        ]
    )
    return typed_results(_read_json(spark, path, as_text, layout))


def write_rules(rules: DataFrame, path: str, limit: int = KEPT_RULES) -> None:
    write_json(top_rules(rules, limit), path)


def read_rules(
    spark: SparkSession, path: str, limit: int = SHOWN_RULES, layout: str = "lines"
) -> DataFrame:
    return shown_rules(_read_json(spark, path, RULE, layout), limit)
