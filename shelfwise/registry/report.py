"""Checks of the report tables and the chat context."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import report
from shelfwise.registry import query
from shelfwise.registry.baskets import named_rules, rules_sql
from shelfwise.registry.data import CATALOG, FILLED, catalog, prepared, table
from shelfwise.registry.scoring import RECORDS, records
from shelfwise.session import written

CATEGORIES = ("Electronics", "Home", "Unknown")
STOCK = ("in_stock",)

_CHOSEN = """standardized_category in ('Electronics', 'Home', 'Unknown')
      and stock_status in ('in_stock')"""


@query(
    "filtered_products",
    f"""with {CATALOG}
    select product_id, category, stock_status, price from catalog where {_CHOSEN}""",
)
def filtered_products(spark, sf):
    return report.filter_products(catalog(spark, sf), CATEGORIES, STOCK).select(
        "product_id", "category", "stock_status", "price"
    )


@query(
    "filtered_by_plain_category",
    f"""with {CATALOG}
    select product_id, category, price from catalog where category in ('PROMO', 'SMALL')""",
)
def filtered_by_plain_category(spark, sf):
    """Without the standardized column the plain category is used; no stock choice."""
    df = catalog(spark, sf).drop("standardized_category")
    return report.filter_products(df, ("PROMO", "SMALL")).select(
        "product_id", "category", "price"
    )


@query(
    "filter_options",
    f"""with {CATALOG}
    select distinct 'categories' as filter, standardized_category as option from catalog
    where standardized_category is not null
    union all
    select distinct 'stock_status', stock_status from catalog where stock_status is not null""",
)
def filter_options(spark, sf):
    return report.filter_options(catalog(spark, sf))


@query(
    "kpis",
    f"""with {RECORDS}
    select count(*) as total_products, round(coalesce(avg(price), 0.0), 6) as avg_price,
           round(coalesce(avg(final_score), 0.0), 6) as avg_score
    from records where {_CHOSEN}""",
)
def kpis(spark, sf):
    chosen = report.filter_products(records(spark, sf), CATEGORIES, STOCK)
    return report.kpis(chosen).select(
        "total_products",
        F.round("avg_price", 6).alias("avg_price"),
        F.round("avg_score", 6).alias("avg_score"),
    )


@query(
    "kpis_of_nothing",
    f"""with {CATALOG}
    select count(*) as total_products, coalesce(avg(price), 0.0) as avg_price,
           coalesce(avg(rating), 0.0) as avg_score
    from catalog where standardized_category in ('No such category')""",
)
def kpis_of_nothing(spark, sf):
    rows = records(spark, sf)
    return report.kpis(report.filter_products(rows, ("No such category",)))


@query(
    "display_columns",
    f"""with {CATALOG}
    select product_id, name, category, vendor, cast(review_count as varchar) as review_count,
           coalesce(stock_status, 'N/A') as stock_status,
           coalesce(standardized_category, 'N/A') as standardized_category
    from catalog""",
)
def display_columns(spark, sf):
    """The array column goes; numbers with a fraction are left out of the comparison,
    the engines write them differently."""
    df = catalog(spark, sf).drop("price", "promotional_price", "rating")
    return report.display_columns(df.withColumn("tags", F.array("vendor")))


@query(
    "price_score_chart",
    f"""with {RECORDS}
    select price, round(final_score, 6) as final_score, name, cluster_id
    from records where price is not null and final_score is not null""",
)
def price_score_chart(spark, sf):
    return report.price_score_chart(records(spark, sf)).withColumn(
        "final_score", F.round("final_score", 6)
    )


@query(
    "projection_chart",
    f"""with {RECORDS}
    select round(pca_1, 9) + 0.0 as pca_1, round(pca_2, 9) + 0.0 as pca_2, name, cluster_id
    from records where pca_1 is not null and pca_2 is not null""",
)
def projection_chart(spark, sf):
    return report.projection_chart(records(spark, sf)).withColumns(
        {c: F.round(c, 9) + 0.0 for c in ("pca_1", "pca_2")}
    )


@query(
    "display_table",
    f"""with {FILLED}
    select product_id as "product id", name, review_count as "review count",
           case when rating = floor(rating) then rating else round(rating, 2) end as rating
    from labelled order by product_id limit 50""",
)
def display_table(spark, sf):
    df = prepared(spark, sf)[0].select("product_id", "name", "review_count", "rating")
    return report.display_table(df.withColumn("Unnamed: 0", F.lit(0)))


@query(
    "context_rows",
    f"""with {CATALOG}
    select product_id, name, '["' || vendor || '","' || category || '"]' as labels,
           '{{"reviews":' || review_count || '}}' as counts
    from catalog order by product_id limit 100""",
)
def context_rows(spark, sf):
    df = catalog(spark, sf).select(
        "product_id",
        "name",
        F.array("vendor", "category").alias("labels"),
        F.struct(F.col("review_count").alias("reviews")).alias("counts"),
    )
    return report.context_rows(df)


_LINES = """
numbered as (
  select conv_id, text, upper(substr(role, 1, 1)) || lower(substr(role, 2)) || ': ' || text
           as line,
         row_number() over (partition by conv_id order by turn desc, text desc) as back
  from conversations
)"""


@query(
    "history_context",
    f"""with {_LINES}
    select conv_id, string_agg(line, chr(10) order by back desc) as history_context
    from numbered where back <= 6 group by conv_id""",
)
def history_context(spark, sf):
    return report.history_context(table(spark, sf, "conversations"))


@query(
    "chat_context",
    f"""with {CATALOG}, {_LINES},
    rows as (
      select product_id, '{{"product_id":"' || product_id || '","name":"' || name
               || '","review_count":' || review_count || '}}' as j
      from catalog order by product_id limit 100),
    summary as (
      select '[' || string_agg(j, ', ' order by product_id) || ']' as data_summary from rows)
    select conv_id, max(case when back = 1 then text end) as question,
           coalesce(string_agg(case when back > 1 then line end, chr(10) order by back desc), '')
             as history_context,
           any_value(data_summary) as data_summary
    from numbered cross join summary where back <= 7 group by conv_id""",
)
def chat_context(spark, sf):
    products = catalog(spark, sf).select("product_id", "name", "review_count")
    return report.chat_context(products, table(spark, sf, "conversations"))


@query(
    "report_bundle",
    f"""with {RECORDS}, {rules_sql('p_brand', 0.005, 0.2, 'where lift > 1.1')},
    chosen as (select * from records where {_CHOSEN})
    select 'kpis' as part, cast(1 as bigint) as rows
    union all
    select 'filter_options', count(distinct standardized_category) + count(distinct stock_status)
    from records
    union all select 'rows', count(*) from chosen
    union all select 'price_score_chart', count(*) from chosen
      where price is not null and final_score is not null
    union all select 'projection_chart', count(*) from chosen
      where pca_1 is not null and pca_2 is not null
    union all select 'association_rules', least(15, count(*)) from kept""",
)
def report_bundle(spark, sf):
    """Sizes of all tables of one report view."""
    scored = written(records(spark, sf), "records")
    rules = written(named_rules(spark, sf), "named-rules")
    bundle = report.bundle(scored, rules, CATEGORIES, STOCK)
    sizes = None
    for name, df in bundle.items():
        size = df.agg(F.lit(name).alias("part"), F.count("*").alias("rows"))
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes
