"""Checks of shop ranking, trends and stock reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import density, history, linkage
from shelfwise.operators.skew import join_split_hot
from shelfwise.registry import query
from shelfwise.registry.data import CATALOG, catalog, table
from shelfwise.session import dealt, scratch_path
from shelfwise.streaming import emerging, trends


@query(
    "shop_ranking",
    """with totals as (
      select l_suppkey, l_partkey, cast(round(sum(l_extendedprice) * 100) as bigint)
               as revenue
      from lineitem group by 1, 2),
    shops as (
      select s_name as store, n_name as country, p_name, revenue,
             cast(l_partkey as varchar) as product_id
      from totals join supplier on s_suppkey = l_suppkey
           join nation on n_nationkey = s_nationkey join part on p_partkey = l_partkey),
    ranked as (
      select *, row_number() over (partition by store order by revenue desc, product_id desc)
               as n from shops)
    select store, country, count(*) as product_count, avg(revenue) as avg_score,
           max(case when n = 1 then p_name end) as flagship
    from ranked group by 1, 2""",
)
def shop_ranking(spark, sf):
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_extendedprice")
    # The sums and the join with the parts both run on these partitions.
    revenue = (
        dealt(lines, "l_partkey")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.round(F.sum("l_extendedprice") * 100).cast("bigint").alias("final_score"))
    )
    supplier = table(spark, sf, "supplier")
    shops = supplier.withColumnRenamed("s_suppkey", "l_suppkey")
    products = (
        join_split_hot(revenue, shops, "l_suppkey", "inner")
        .join(table(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.col("s_name").alias("store"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            "final_score",
        )
    )
    countries = supplier.join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey")
    ).select(F.col("s_name").alias("store"), F.col("n_name").alias("country"))
    return history.shop_ranking(products, countries)


@query(
    "price_trend",
    """with t as (
      select event_id, user_id, value,
             lag(value) over (partition by user_id order by ts) as previous from events)
    select event_id, user_id, previous, value - previous as change,
           case when value - previous > 0 then 'up' when value - previous < 0 then 'down'
                when value - previous = 0 then 'flat' end as direction
    from t""",
)
def price_trend(spark, sf):
    snapshots = table(spark, sf, "events", "event_id", "user_id", "ts", "value")
    return history.trend(snapshots, "user_id", "ts", "value").select(
        "event_id", "user_id", "previous", "change", "direction"
    )


@query(
    "low_stock",
    """select cast(l_partkey as varchar) as product_id,
              cast(sum(cast(l_quantity as integer)) as bigint) as pieces
    from lineitem group by 1 having sum(cast(l_quantity as integer)) <= 500""",
)
def low_stock(spark, sf):
    variants = table(spark, sf, "lineitem", "l_partkey", "l_quantity").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("inventory_quantity"),
    )
    return history.low_stock(variants, 500)


@query(
    "promotions",
    f"""with {CATALOG}
    select product_id, price, promotional_price,
           (price - promotional_price) / price as discount_ratio
    from catalog where promotional_price < price""",
)
def promotions(spark, sf):
    return history.promotions(catalog(spark, sf)).select(
        "product_id", "price", "promotional_price", "discount_ratio"
    )


@query(
    "weekly_activity",
    """with w as (
      select event_type, time_bucket(interval 7 days, ts, timestamp '1970-01-01') as week,
             value, max(ts) over () as newest from events)
    select strftime(week, '%Y-%m-%d') as week_start, event_type, count(*) as records,
           cast(sum(cast(round(value * 100) as bigint)) as bigint) as value_cents
    from w where week + interval 7 days <= newest - interval 1 day
    group by 1, 2""",
)
def weekly_activity(spark, sf):
    """Weeks still open a day before the newest event are left out."""
    return trends.closed_weeks(table(spark, sf, "events"), "event_type", "ts", "value")


SLICES = 6


@query(
    "emerging_products",
    f"""with w as (
      select cast(user_id as varchar) as product, cast(floor(epoch(ts) / 604800) as bigint) as week,
             count(*) as records, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
      from events group by 1, 2),
    bounds as (
      select max(week) as newest, cast(ceil((max(week) - min(week) + 1) / {SLICES}.0) as bigint) as span
      from w),
    grown as (
      select w.*, coalesce(p.records, 0) as previous, w.records - coalesce(p.records, 0) as growth
      from w left join w p on p.product = w.product and p.week = w.week - 1),
    ranked as (
      select *, row_number() over (partition by week order by growth desc, records desc, product)
               as rank
      from grown where growth > 0)
    select strftime(date '1970-01-01' + cast(week * 7 as integer), '%Y-%m-%d') as week_start,
           product, records, cents, previous, growth, cast(rank as integer) as rank,
           (week + 1) * 7 > newest * 7 - 14 * span as is_open
    from ranked, bounds where rank <= 5""",
)
def emerging_products(spark, sf):
    """All events as a stream of files by time, every second pair of files the later one first."""
    events = table(spark, sf, "events", "user_id", "ts", "value")
    week = emerging.week_number(F.col("ts"))
    first, newest = events.agg(F.min(week), F.max(week)).first()
    span = -(-(newest - first + 1) // SLICES) if newest is not None else 1
    folder = scratch_path(spark, "event-files")
    for i in range(SLICES):
        begin = (first or 0) + span * (i ^ 1)
        days = [F.date_from_unix_date(F.lit(7 * w)).cast("timestamp") for w in (begin, begin + span)]
        part = events.where((F.col("ts") >= days[0]) & (F.col("ts") < days[1]))
        part.write.mode("append").parquet(folder)
    found = emerging.run_emerging(
        spark, folder, events.schema, "user_id", "ts", "value", late_days=14 * span
    )
    return found.top.select(
        emerging.week_start(F.col("week")).alias("week_start"),
        "product", "records", "cents", "previous", "growth", "rank", "is_open",
    )


@query(
    "price_outliers",
    """with c as (
      select event_type, cast(round(value * 100) as bigint) as cents, count(*) as rows
      from events group by 1, 2),
    d as (
      select *, cast(sum(rows) over near as bigint) as neighbours from c
      window near as (partition by event_type order by cents
                      range between 10 preceding and 10 following)),
    r as (
      select *, sum(case when neighbours >= 4 then 1 else 0 end) over near as dense_near
      from d
      window near as (partition by event_type order by cents
                      range between 10 preceding and 10 following))
    select event_type, cents, rows, neighbours from r where dense_near = 0""",
)
def price_outliers(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    rows = table(spark, sf, "events", "event_type", "value").withColumn("cents", cents)
    return history.density_outliers(rows, "event_type", "cents", 10, 4)


#: Products as points: price in steps of 40, rating in half steps, reviews in steps of 4.
POINT = ("price / 40", "rating * 2", "review_count / 4.0")
EPS, MIN_POINTS = 0.5, 6


@query(
    "density_clusters",
    f"""with recursive {CATALOG},
    points as materialized (
      select product_id, {POINT[0]} as x, {POINT[1]} as y, {POINT[2]} as z from catalog
      where price is not null and rating is not null and review_count is not null),
    near as materialized (
      select a.product_id as a, b.product_id as b from points a join points b
        on (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)
           <= {EPS}::double * {EPS}::double),
    core as materialized (select a from near group by a having count(*) >= {MIN_POINTS}),
    edges as materialized (
      select a, b from near where a in (select a from core) and b in (select a from core)),
    reach as (
      select a, a as name, 0 as step from core
      union all
      select e.a, min(r.name), r.step + 1 from reach r join edges e on e.b = r.a
      where r.step < 80 group by e.a, r.step),
    named as materialized (select a, name from reach where step = 80),
    border as (
      select n.a, min(c.name) as name from near n join named c on c.a = n.b
      where n.a not in (select a from core) group by n.a)
    select product_id,
           case when x is null then null when c.a is not null then 'core'
                when b.a is not null then 'border' else 'noise' end as role,
           coalesce(c.name, b.name) as cluster
    from catalog left join points using (product_id)
         left join named c on c.a = product_id left join border b on b.a = product_id""",
)
def density_clusters(spark, sf):
    products = catalog(spark, sf).withColumns(
        {f"point_{i}": F.expr(p).cast("double") for i, p in enumerate(POINT)}
    )
    found = density.density_clusters(
        products, "product_id", ["point_0", "point_1", "point_2"], EPS, MIN_POINTS
    )
    return found.select("product_id", "role", "cluster")


LINKED = 5


@query(
    "single_linkage",
    f"""with recursive {CATALOG},
    points as materialized (
      select product_id, {POINT[0]} as x, {POINT[1]} as y, {POINT[2]} as z from catalog
      where price is not null and rating is not null and review_count is not null),
    places as materialized (
      select min(product_id) as p, x, y, z from points group by x, y, z),
    -- The tree grows by the place nearest to it, one a step.
    grown as (
      select 0 as step, p, x, y, z, cast('inf' as double) as d, '' as q, p = (select min(p) from places) as new
      from places
      union all
      select step + 1, p, x, y, z, d, q,
             row_number() over (order by d, least(p, q), greatest(p, q)) = 1 as new
      from (
        select r.step, r.p, r.x, r.y, r.z,
               case when (r.x - n.x) * (r.x - n.x) + (r.y - n.y) * (r.y - n.y)
                         + (r.z - n.z) * (r.z - n.z) < r.d
                      or r.q = ''
                      or ((r.x - n.x) * (r.x - n.x) + (r.y - n.y) * (r.y - n.y)
                          + (r.z - n.z) * (r.z - n.z) = r.d
                          and (least(r.p, n.p), greatest(r.p, n.p)) < (least(r.p, r.q), greatest(r.p, r.q)))
                    then n.p else r.q end as q,
               least(r.d, (r.x - n.x) * (r.x - n.x) + (r.y - n.y) * (r.y - n.y)
                          + (r.z - n.z) * (r.z - n.z)) as d
        from grown r join grown n on n.new where not r.new)),
    edges as materialized (select p, q, d from grown where new and q <> ''),
    kept as materialized (
      select p, q from (
        select p, q, row_number() over (order by d desc, least(p, q) desc, greatest(p, q) desc) as n
        from edges) where n >= {LINKED}),
    two_ways as materialized (select p, q from kept union all select q, p from kept),
    -- Every cluster is walked from its smallest place; others stop at places met before.
    reach as (
      select p, p as name from places
      union
      select b.p, min(r.name) from reach r join two_ways b on b.q = r.p group by b.p),
    named as (select p, min(name) as name from reach group by p)
    select product_id, n.name as cluster
    from catalog left join points using (product_id)
         left join places l on l.x = points.x and l.y = points.y and l.z = points.z
         left join named n on n.p = l.p""",
)
def single_linkage(spark, sf):
    products = catalog(spark, sf).withColumns(
        {f"point_{i}": F.expr(p).cast("double") for i, p in enumerate(POINT)}
    )
    found = linkage.single_linkage(
        products, "product_id", ["point_0", "point_1", "point_2"], LINKED
    )
    return found.select("product_id", "cluster")
