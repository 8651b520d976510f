"""Checks of the composite score, the shortlist and the two lookup tools."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import scoring
from shelfwise.registry import query
from shelfwise.registry.data import ASSIGNED, SCORED, assigned, catalog, catalog_table, scored, table
from shelfwise.session import scratch_path
from shelfwise.sources import tables


@query(
    "cluster_quality",
    f"""with {ASSIGNED}
    select cluster_id, round(avg(rating), 6) as avg_rating,
           round(avg(reviews), 6) as avg_reviews,
           round(avg(rating) * 0.7::double + avg(reviews) * 0.3::double, 6) as cluster_score
    from assigned group by cluster_id""",
)
def cluster_quality(spark, sf):
    return scoring.cluster_quality(assigned(spark, sf)).select(
        "cluster_id",
        *[F.round(c, 6).alias(c) for c in ("avg_rating", "avg_reviews", "cluster_score")],
    )


@query(
    "final_scores",
    f"""with {SCORED}
    select product_id, cluster_id, round(cluster_quality_score, 6) as cluster_quality_score,
           round(final_score, 6) as final_score
    from scored""",
)
def final_scores(spark, sf):
    return scored(spark, sf).select(
        "product_id",
        "cluster_id",
        F.round("cluster_quality_score", 6).alias("cluster_quality_score"),
        F.round("final_score", 6).alias("final_score"),
    )


@query(
    "final_scores_minmax",
    f"""with {SCORED},
    signals as (
      select *, case when stock_status = 'in_stock' then 1.0::double else 0.0::double end as flag
      from scored),
    bounds as (
      select min(top_product_probability) as p0, max(top_product_probability) as p1,
             min(cluster_quality_score) as c0, max(cluster_quality_score) as c1,
             min(rating) as r0, max(rating) as r1, min(reviews) as v0, max(reviews) as v1,
             min(flag) as f0, max(flag) as f1
      from signals)
    select product_id,
           round((top_product_probability - p0) / (p1 - p0) * 0.60::double
             + (cluster_quality_score - c0) / (c1 - c0) * 0.15::double
             + (rating - r0) / (r1 - r0) * 0.15::double
             + (reviews - v0) / (v1 - v0) * 0.05::double
             + (flag - f0) / (f1 - f0) * 0.05::double, 6) as final_score
    from signals cross join bounds""",
)
def final_scores_minmax(spark, sf):
    rows = scored(spark, sf).withColumn(
        "stock_in_stock", (F.col("stock_status") == "in_stock").cast("int")
    )
    return scoring.add_final_score(rows, normalize="minmax").select(
        "product_id", F.round("final_score", 6).alias("final_score")
    )


_RANKED = f"""{SCORED},
ranked as (select * from scored order by final_score desc, product_id limit 50)"""

_SHORTLIST = f"""with {_RANKED}
select r.product_id, c.name, c.price, c.rating, c.stock_status,
       r.top_product_probability, r.cluster_id,
       round(r.final_score, 6) as final_score, round(r.pca_1, 6) as pca_1
from ranked r left join catalog c using (product_id)"""


def shortlist_rows(spark, sf):
    ranked = scoring.top_k(scored(spark, sf))
    return scoring.attach_products(ranked, catalog(spark, sf))


@query("shortlist", _SHORTLIST)
def shortlist(spark, sf):
    """Price and rating are those of the record, nulls included."""
    return shortlist_rows(spark, sf).select(
        "product_id",
        "name",
        "price",
        "rating",
        "stock_status",
        "top_product_probability",
        "cluster_id",
        F.round("final_score", 6).alias("final_score"),
        F.round("pca_1", 6).alias("pca_1"),
    )


@query(
    "shortlist_round_trip",
    f"""with {_RANKED}
    select r.product_id, c.name, c.price, c.rating, c.review_count, r.cluster_id,
           round(r.final_score, 6) as final_score, round(r.pca_2, 6) as pca_2
    from ranked r left join catalog c using (product_id)""",
)
def shortlist_round_trip(spark, sf):
    path = scratch_path(spark, "shortlist")
    tables.write_topk(shortlist_rows(spark, sf), path)
    return tables.read_topk(spark, path).select(
        "product_id",
        "name",
        "price",
        "rating",
        "review_count",
        "cluster_id",
        F.round("final_score", 6).alias("final_score"),
        F.round("pca_2", 6).alias("pca_2"),
    )


@query(
    "top_products",
    """select cast(o_orderkey as varchar) as product_id, raw as final_score
    from (select o_orderkey, case when o_orderstatus = 'P' then 'none'
                 else cast(o_totalprice as varchar) end as raw from orders)
    order by coalesce(try_cast(raw as double), 0.0) desc, cast(o_orderkey as varchar)
    limit 200""",
)
def top_products(spark, sf):
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice").select(
        F.col("o_orderkey").cast("string").alias("product_id"),
        F.when(F.col("o_orderstatus") == "P", "none")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("final_score"),
    )
    return scoring.top_products(rows, 200)


_SUMMARY = """select cluster_id, count(*) as product_count,
       round(avg(price), 4) as avg_price, round(avg(rating), 4) as avg_rating,
       count(price) as price_samples, count(rating) as rating_samples"""

_RECORDS = f"""{SCORED},
records as (
  select c.*, s.cluster_id, s.final_score, s.pca_1, s.pca_2
  from scored s join catalog c using (product_id))"""


def records(spark, sf):
    """All products with their own price and rating beside the scores."""
    products = catalog_table(spark, sf)
    scores = scored(spark, sf, products).select(
        "product_id", "cluster_id", "final_score", "pca_1", "pca_2"
    )
    return products.join(scores, "product_id")


RECORDS = _RECORDS


@query(
    "cluster_summaries",
    f"with {_RECORDS} {_SUMMARY} from records group by cluster_id",
)
def cluster_summaries(spark, sf):
    return scoring.cluster_summaries(records(spark, sf))


@query(
    "cluster_summary",
    f"with {_RECORDS} {_SUMMARY} from records where cluster_id = 1 group by cluster_id",
)
def cluster_summary(spark, sf):
    return scoring.cluster_summary(records(spark, sf), 1)
