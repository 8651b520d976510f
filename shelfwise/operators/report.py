"""Tables behind the report: filters, figures, charts, display rows and chat context."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import capitalise

# Rows and rules shown, rows and messages given to the chat.
SHOWN_ROWS = 50
SHOWN_RULES = 15
CONTEXT_ROWS = 100
CONTEXT_MESSAGES = 6
MISSING = "N/A"

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def category_column(df: DataFrame) -> str | None:
    for name in ("standardized_category", "category"):
        if name in df.columns:
            return name
    return None


def filter_products(
    df: DataFrame, categories: Iterable[str] = (), stock_status: Iterable[str] = ()
) -> DataFrame:
    """Keep the chosen categories and stock states; an empty choice keeps all."""
    categories, stock_status = list(categories), list(stock_status)
    name = category_column(df)
    if categories and name:
        df = df.where(F.col(name).isin(categories))
    if stock_status and "stock_status" in df.columns:
        df = df.where(F.col("stock_status").isin(stock_status))
    return df


def filter_options(df: DataFrame) -> DataFrame:
    """Sorted distinct values per filter, as rows (filter, option)."""
    parts = []
    for label, name in (("categories", category_column(df)), ("stock_status", "stock_status")):
        if name in df.columns:
            parts.append(F.struct(F.lit(label).alias("filter"), F.col(name).alias("option")))
    pairs = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    return pairs.where("option is not null").distinct().orderBy("filter", "option")


def kpis(df: DataFrame) -> DataFrame:
    """Rows, mean price and mean score; the means are 0 over no rows."""
    return df.agg(
        F.count("*").alias("total_products"),
        F.coalesce(F.avg("price"), F.lit(0.0)).alias("avg_price"),
        F.coalesce(F.avg("final_score"), F.lit(0.0)).alias("avg_score"),
    )


def display_columns(df: DataFrame) -> DataFrame:
    """Without nested columns, everything as text, null as N/A."""
    return df.select(
        *[
            F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit(MISSING)).alias(f.name)
            for f in df.schema
            if not isinstance(f.dataType, _NESTED)
        ]
    )


def price_score_chart(df: DataFrame) -> DataFrame:
    return df.where("price is not null and final_score is not null").select(
        "price", "final_score", "name", "cluster_id"
    )


def projection_chart(df: DataFrame) -> DataFrame:
    return df.where("pca_1 is not null and pca_2 is not null").select(
        "pca_1", "pca_2", "name", "cluster_id"
    )


def best_first(df: DataFrame) -> list[Column]:
    """Order of a shortlist."""
    if "final_score" in df.columns:
        return [F.desc("final_score"), F.col("product_id")]
    return [F.col("product_id")]


def display_table(df: DataFrame, rows: int = SHOWN_ROWS) -> DataFrame:
    """First rows with readable headings and two decimals; index columns are hidden."""
    shown = df.orderBy(*best_first(df)).limit(rows)
    out = []
    for f in df.schema:
        if f.name.startswith("Unnamed"):
            continue
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(value == F.floor(value), value).otherwise(F.round(value, 2))
        out.append(value.alias(f.name.replace("_", " ")))
    return shown.select(*out)


def rule_texts(rules: DataFrame) -> DataFrame:
    """``[a, b] -> [c]`` with confidence in percent and lift; ids stand in for names."""

    def side(name: str) -> Column:
        items = F.coalesce(F.col(f"{name}_names"), F.col(name), F.array().cast("array<string>"))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

    return rules.select(
        F.concat(side("antecedents"), F.lit(" -> "), side("consequents")).alias("rule"),
        F.format_string(
            "%.1f%%", F.coalesce("confidence", F.lit(0.0)) * 100
        ).alias("confidence"),
        F.format_string("%.2f", F.coalesce("lift", F.lit(0.0))).alias("lift"),
    )


def shown_rules(rules: DataFrame, limit: int = SHOWN_RULES) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedents", "consequents").limit(limit)


def context_rows(df: DataFrame, limit: int = CONTEXT_ROWS) -> DataFrame:
    """First rows with nested columns as JSON text."""
    shown = df.orderBy(*best_first(df)).limit(limit)
    return shown.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name)
            if isinstance(f.dataType, _NESTED)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def numbered_back(messages: DataFrame, limit: int) -> DataFrame:
    """The last ``limit`` messages per conversation, ``back`` = 1 for the newest.

    The rank filter also runs before the shuffle, so a very long conversation sends
    ``limit`` rows per task.
    """
    last = Window.partitionBy("conv_id").orderBy(F.desc("turn"), F.desc("text"))
    return messages.withColumn("back", F.row_number().over(last)).where(F.col("back") <= limit)


def _joined_lines(kept: Column) -> Column:
    line = F.concat(capitalise(F.col("role")), F.lit(": "), F.col("text"))
    lines = F.collect_list(F.when(kept, F.struct((-F.col("back")).alias("o"), line.alias("l"))))
    return F.array_join(F.transform(F.array_sort(lines), lambda m: m["l"]), "\n")


def history_context(messages: DataFrame, limit: int = CONTEXT_MESSAGES) -> DataFrame:
    """Per conversation the last messages as ``Role: text`` lines, in turn order."""
    return (
        numbered_back(messages, limit)
        .groupBy("conv_id")
        .agg(_joined_lines(F.lit(True)).alias("history_context"))
    )


def data_summary(products: DataFrame) -> str:
    """The context rows as one JSON array."""
    rows = context_rows(products).toJSON().take(CONTEXT_ROWS)
    return "[" + ", ".join(rows) + "]"


def chat_context(products: DataFrame, messages: DataFrame) -> DataFrame:
    """Per conversation: its newest message as the question, up to six messages before
    it as history, and the shown product rows as one JSON text."""
    newest = F.col("back") == 1
    return (
        numbered_back(messages, CONTEXT_MESSAGES + 1)
        .groupBy("conv_id")
        .agg(
            F.max(F.when(newest, F.col("text"))).alias("question"),
            _joined_lines(~newest).alias("history_context"),
        )
        .withColumn("data_summary", F.lit(data_summary(products)))
    )


def bundle(
    scored: DataFrame,
    rules: DataFrame,
    categories: Iterable[str] = (),
    stock_status: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Everything one report view needs. Options are read before the filter applies."""
    chosen = filter_products(scored, categories, stock_status)
    return {
        "kpis": kpis(chosen),
        "filter_options": filter_options(scored),
        "rows": display_columns(chosen),
        "price_score_chart": price_score_chart(chosen),
        "projection_chart": projection_chart(chosen),
        "association_rules": shown_rules(rules),
    }
