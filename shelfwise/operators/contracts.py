"""Row contracts: every row gets the list of rules it breaks, then is kept or set aside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import strip_text
from shelfwise.schemas import FEATURE_INPUTS, PRODUCT, TAXONOMY

# Text columns whose ends are stripped before the rules apply.
STRIPPED = ("product_id", "name", "description", "category", "stock_status")


def broken_rules(rules: Iterable[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition is not true, separated by commas."""
    return F.concat_ws(
        ",",
        *[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules],
    )


def _not_negative(name: str) -> Column:
    value = F.col(name)
    return (value >= 0) & ~F.isnan(value)


def product_rules() -> list[tuple[str, Column]]:
    rating = F.col("rating")
    return [
        ("product_id_empty", F.length("product_id") >= 1),
        ("name_empty", F.length("name") >= 1),
        ("description_missing", F.col("description").isNotNull()),
        ("category_missing", F.col("category").isNotNull()),
        ("price_negative", _not_negative("price")),
        (
            "promotional_price_negative",
            F.col("promotional_price").isNull() | _not_negative("promotional_price"),
        ),
        (
            "rating_out_of_range",
            rating.isNull() | (rating.between(0.0, 5.0) & ~F.isnan(rating)),
        ),
        ("review_count_negative", F.col("review_count") >= 0),
        ("stock_status_empty", F.length("stock_status") >= 1),
    ]


def enrichment_rules() -> list[tuple[str, Column]]:
    return [
        ("category_not_in_taxonomy", F.col("standardized_category").isin(*TAXONOMY)),
        ("summary_length", F.length("short_summary").between(1, 320)),
        ("tag_count", F.size("extracted_tags").between(3, 5)),
        (
            "tag_missing",
            ~F.exists(F.col("extracted_tags"), lambda tag: tag.isNull()),
        ),
    ]


def unknown_key_rules(raw_json: Column, allowed: Iterable[str]) -> list[tuple[str, Column]]:
    """Forbid keys outside ``allowed`` in the raw JSON text of a record."""
    known = F.array(*[F.lit(name) for name in allowed])
    extra = F.array_except(F.json_object_keys(raw_json), known)
    return [("unknown_key", F.size(extra) == 0)]


def strip_texts(df: DataFrame, columns: Iterable[str] = STRIPPED) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: strip_text(F.col(c)) for c in present})


def check(
    df: DataFrame,
    rules: list[tuple[str, Column]],
    earlier: Column | None = None,
) -> DataFrame:
    """Strip the text columns and add ``reasons`` (empty for a good row); ``earlier`` holds
    reasons already found."""
    found = broken_rules(rules)
    if earlier is not None:
        found = F.concat_ws(
            ",", F.nullif(earlier, F.lit("")), F.nullif(found, F.lit(""))
        )
    return strip_texts(df).withColumn("reasons", found)


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reasons") == "").drop("reasons")


def quarantine(checked: DataFrame, keep: Iterable[str] = ("product_id",)) -> DataFrame:
    """Rows that break a rule: what identifies them, and the list of reasons."""
    broken = checked.where(F.col("reasons") != "")
    return broken.select(*keep, F.split("reasons", ",").alias("reasons"))


def check_products(df: DataFrame, earlier: Column | None = None) -> DataFrame:
    return check(df, product_rules(), earlier)


def check_enriched(df: DataFrame, earlier: Column | None = None) -> DataFrame:
    return check(df, product_rules() + enrichment_rules(), earlier)


def require_columns(df: DataFrame, required: Iterable[str] = FEATURE_INPUTS) -> None:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")


PRODUCT_COLUMNS = tuple(PRODUCT.fieldNames())
