"""Cleaning, imputation, discount, label and one-hot columns.

Fitting reads the data and returns a small set of plain numbers and category lists;
applying it is a map over the rows with no shuffle. The same fitted object serves
training and scoring, so both see the same columns.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.impute import id_hash
from shelfwise.operators import contracts
from shelfwise.operators.quantiles import exact_quantiles, kth_values
from shelfwise.schemas import NON_FEATURES

# The quantile of the label cuts and the floor of each cut.
LABEL_QUANTILE = 0.70
RATING_FLOOR = 3.5
REVIEW_FLOOR = 1.0
DISCOUNT_FLOOR = 0.10

# Weights of the fallback label score.
FALLBACK_WEIGHTS = {"discount_ratio": 0.5, "rating": 0.3, "is_in_stock": 0.2}


@dataclass(frozen=True)
class Medians:
    rating: float
    price: float


@dataclass(frozen=True)
class Cuts:
    rating: float
    reviews: float
    discount: float


@dataclass(frozen=True)
class Vocabulary:
    categories: tuple[str, ...]
    stock: tuple[str, ...]


@dataclass(frozen=True)
class Fallback:
    """Positive labels are the ``score``s above the cut, plus tied rows up to ``tie``."""

    score: float
    tie: float


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Read the numeric columns as numbers; what is no number becomes null."""

    def number(name: str) -> Column:
        return F.nullif(F.col(name).try_cast("double"), F.lit(float("nan")))

    return df.withColumns(
        {
            "price": number("price"),
            "promotional_price": number("promotional_price"),
            "rating": number("rating"),
            "review_count": F.coalesce(number("review_count"), F.lit(0.0)).cast("bigint"),
        }
    )


def fit_medians(df: DataFrame) -> Medians:
    """Medians of rating and price over coerced rows; zero if a column is empty."""
    q = exact_quantiles(
        df,
        {"rating": (F.col("rating"), 0.5), "price": (F.col("price"), 0.5)},
    )
    return Medians(q["rating"] or 0.0, q["price"] or 0.0)


def fill_missing(df: DataFrame, medians: Medians) -> DataFrame:
    """Medians for rating and price, the price for a missing promotion, default texts."""
    price = F.coalesce("price", F.lit(medians.price))
    return df.withColumns(
        {
            "rating": F.coalesce("rating", F.lit(medians.rating)),
            "price": price,
            "promotional_price": F.coalesce(F.col("promotional_price"), price),
            "standardized_category": F.coalesce("standardized_category", F.lit("Unknown")),
            "stock_status": F.coalesce("stock_status", F.lit("unknown")),
        }
    )


def add_stock_flag(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "is_in_stock", (F.lower("stock_status") == "in_stock").cast("int")
    )


def discount_ratio(price: Column, promo: Column) -> Column:
    """Share taken off the price, between 0 and 1; 0 for a zero price."""
    ratio = F.try_divide(price - promo, price)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(ratio, F.lit(0.0))))


def add_discount(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "discount_ratio", discount_ratio(F.col("price"), F.col("promotional_price"))
    )


def fit_cuts(df: DataFrame) -> Cuts:
    """The 70 % quantiles of the filled columns, never below their floors."""
    q = exact_quantiles(
        df,
        {
            "rating": (F.col("rating"), LABEL_QUANTILE),
            "reviews": (F.col("review_count"), LABEL_QUANTILE),
            "discount": (F.col("discount_ratio"), LABEL_QUANTILE),
        },
    )
    return Cuts(
        max(RATING_FLOOR, q["rating"] or 0.0),
        max(REVIEW_FLOOR, q["reviews"] or 0.0),
        max(DISCOUNT_FLOOR, q["discount"] or 0.0),
    )


def top_product_rule(cuts: Cuts) -> Column:
    """In stock and either well rated by many or strongly reduced."""
    in_stock = F.col("is_in_stock") == 1
    liked = (F.col("rating") >= cuts.rating) & (F.col("review_count") >= cuts.reviews)
    reduced = F.col("discount_ratio") >= cuts.discount
    return in_stock & (liked | reduced)


def fallback_score() -> Column:
    """Weighted sum used only when the rule labels all rows alike."""
    w = FALLBACK_WEIGHTS
    return (
        F.col("discount_ratio") * w["discount_ratio"]
        + F.col("rating") * w["rating"]
        + F.col("is_in_stock") * w["is_in_stock"]
    )


def _tie_key() -> Column:
    return id_hash(F.col("product_id"), 13).cast("double")


def fallback_size(rows: int) -> int:
    """How many rows become positive: a fifth (half to even), at least 2 (1 below 4 rows)."""
    at_least = 2 if rows >= 4 else 1
    return min(max(at_least, round(rows * 0.2)), rows - 1)


def fit_fallback(df: DataFrame, cuts: Cuts, rows: int | None = None) -> Fallback | None:
    """Cut-off of the fallback label, or None when the rule already gives two classes.

    The wanted rows are a fifth of the table, so the cut-off is found by rank and the
    rows are labelled by comparing with it; nothing is sorted or gathered. Ties are
    ordered by a hash of the product id.
    """
    n = df.count() if rows is None else rows
    positive = df.agg(F.count_if(top_product_rule(cuts))).first()[0]
    if n <= 1 or 0 < positive < n:
        return None
    wanted = fallback_size(n)
    score = fallback_score()
    cut = kth_values(df, {"score": (score, n - wanted)})["score"]
    tied = df.where(score == cut)
    above = df.where(score > cut).count()
    tie = kth_values(tied, {"tie": (_tie_key(), wanted - above - 1)})["tie"]
    return Fallback(cut, tie)


def add_label(df: DataFrame, cuts: Cuts, fallback: Fallback | None = None) -> DataFrame:
    if fallback is None:
        positive = top_product_rule(cuts)
    else:
        score = fallback_score()
        positive = (score > fallback.score) | (
            (score == fallback.score) & (_tie_key() <= fallback.tie)
        )
    return df.withColumn("is_top_product", positive.cast("int"))


def fit_vocabulary(df: DataFrame, max_values: int | None = None) -> Vocabulary:
    """Sorted distinct values of both columns, all of them unless ``max_values`` is given.

    More than ``max_values`` are an error, for callers that want no wider a table.

    Column names do not tell upper from lower case, so values that differ only in case
    share a column, named after the lower-case spelling where there is one.
    """
    names = ("standardized_category", "stock_status")
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
    found = df.select(F.explode(cells).alias("c")).select("c.*").distinct()
    rows = found.collect() if max_values is None else found.take(max_values + 1)
    if max_values is not None and len(rows) > max_values:
        raise ValueError(f"more than {max_values} categories and stock states")

    def spellings(name: str) -> tuple[str, ...]:
        values = sorted(r["value"] for r in rows if r["name"] == name)
        return tuple(sorted({v.lower(): v for v in values}.values()))

    return Vocabulary(*[spellings(n) for n in names])


def one_hot(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A 0/1 column per known value; the source columns go."""
    columns = {
        f"cat_{v}": (F.lower("standardized_category") == v.lower()).cast("int")
        for v in vocabulary.categories
    }
    columns |= {
        f"stock_{v}": (F.lower("stock_status") == v.lower()).cast("int")
        for v in vocabulary.stock
    }
    return df.withColumns(columns).drop("standardized_category", "stock_status")


def add_reviews(df: DataFrame) -> DataFrame:
    return df.withColumn("reviews", F.col("review_count").cast("double"))


@dataclass(frozen=True)
class FeatureModel:
    medians: Medians
    cuts: Cuts
    vocabulary: Vocabulary
    fallback: Fallback | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Filled columns, stock flag, discount and label; text columns still present."""
        return add_label(fill(df, self.medians), self.cuts, self.fallback)

    def transform(self, df: DataFrame) -> DataFrame:
        """The model-ready table."""
        return add_reviews(one_hot(self.prepare(df), self.vocabulary))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureModel:
        d = json.loads(text)
        return FeatureModel(
            Medians(**d["medians"]),
            Cuts(**d["cuts"]),
            Vocabulary(**{k: tuple(v) for k, v in d["vocabulary"].items()}),
            Fallback(**d["fallback"]) if d["fallback"] else None,
        )


def fill(df: DataFrame, medians: Medians) -> DataFrame:
    return add_discount(add_stock_flag(fill_missing(coerce_numbers(df), medians)))


def fit(df: DataFrame) -> FeatureModel:
    """Read ``df`` a few times, one small result each: give it as a table, not as a long
    plan (see ``session.written``)."""
    contracts.require_columns(df)
    rows = df.count()
    medians = fit_medians(coerce_numbers(df))
    filled = fill(df, medians)
    cuts = fit_cuts(filled)
    return FeatureModel(
        medians, cuts, fit_vocabulary(filled), fit_fallback(filled, cuts, rows)
    )


def matrix_columns(df: DataFrame, exclude_leaky: bool = False) -> list[str]:
    """Names of the numeric and boolean columns a model may use."""
    dropped = set(NON_FEATURES)
    if exclude_leaky:
        # The label is computed from these.
        dropped |= {
            "rating", "review_count", "reviews", "discount_ratio", "is_in_stock",
            "promotional_price",
        } | {c for c in df.columns if c.startswith("stock_")}
    usable = (T.NumericType, T.BooleanType)
    return [
        f.name for f in df.schema if f.name not in dropped and isinstance(f.dataType, usable)
    ]


def feature_matrix(df: DataFrame, exclude_leaky: bool = False) -> DataFrame:
    """Only usable columns, as doubles, null as 0."""
    return df.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c)
            for c in matrix_columns(df, exclude_leaky)
        ]
    )
