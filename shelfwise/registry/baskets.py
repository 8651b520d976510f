"""Checks of baskets, item sets and rules: orders are baskets of brands or types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import baskets, report
from shelfwise.operators.skew import join_split_hot
from shelfwise.registry import query
from shelfwise.registry.data import CATALOG, catalog, table
from shelfwise.session import scratch_path
from shelfwise.sources import tables


def order_items(spark: SparkSession, sf: str, item: str) -> DataFrame:
    parts = table(spark, sf, "part", "p_partkey", item).withColumnRenamed(
        "p_partkey", "l_partkey"
    )
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    lines = join_split_hot(lines, parts, "l_partkey", "inner")
    return baskets.basket_items(lines, "l_orderkey", item)


# The check grows sets up to this size: all six types, and more than any set of brands.
MAX_SIZE = 6


def items_sql(item: str) -> str:
    return f"""
items as materialized (
  select distinct cast(l_orderkey as varchar) as basket_id, {item} as item
  from lineitem join part on l_partkey = p_partkey
),
total as (select count(distinct basket_id) as n from items)"""


def itemsets_sql(item: str, min_support: float) -> str:
    """Frequent sets of up to six items, each size grown from the one before."""
    need = f"count(*) >= (select ceil({min_support} * n) from total)"
    levels = [
        f"""l1 as materialized (select list_value(item) as items, count(*) as freq from items
            group by item having {need}),
        m1 as materialized (select basket_id, list_value(item) as items, item as top from items
               where list_value(item) in (select items from l1))"""
    ]
    for k in range(2, MAX_SIZE + 1):
        levels.append(
            f"""l{k} as materialized (
              select list_append(m.items, i.item) as items, count(*) as freq
              from m{k - 1} m join items i on i.basket_id = m.basket_id and i.item > m.top
              group by 1 having {need}),
            m{k} as materialized (
              select m.basket_id, list_append(m.items, i.item) as items, i.item as top
              from m{k - 1} m join items i on i.basket_id = m.basket_id and i.item > m.top
              where list_append(m.items, i.item) in (select items from l{k}))"""
        )
    union = " union all ".join(f"select * from l{k}" for k in range(1, MAX_SIZE + 1))
    return f"{items_sql(item)}, {', '.join(levels)}, itemsets as materialized ({union})"


def rules_sql(item: str, min_support: float, min_confidence: float, lift: str) -> str:
    return f"""{itemsets_sql(item, min_support)},
named_sets as materialized (
  select items, freq, list_aggregate(items, 'string_agg', '|') as name from itemsets
),
confident as materialized (
  select a.items as antecedents, list_filter(s.items, lambda x: not list_contains(a.items, x)) as consequents,
         s.freq, s.freq / a.freq as confidence
  from named_sets s join named_sets a
       on len(a.items) < len(s.items) and list_has_all(s.items, a.items)
  where s.freq >= {min_confidence} * a.freq
),
with_name as materialized (
  select *, list_aggregate(consequents, 'string_agg', '|') as name from confident
),
rules as materialized (
  select r.antecedents, r.consequents, r.freq / (select n from total) as support, r.confidence,
         r.confidence / (c.freq / (select n from total)) as lift
  from with_name r join named_sets c on c.name = r.name
  where r.confidence >= {min_confidence}
),
kept as (select * from rules {lift})"""


_FLAT = """select list_aggregate(antecedents, 'string_agg', '|') as antecedents,
       list_aggregate(consequents, 'string_agg', '|') as consequents,
       round(support, 9) as support, round(confidence, 9) as confidence,
       round(lift, 9) as lift"""


def _flat(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.array_join("antecedents", "|").alias("antecedents"),
        F.array_join("consequents", "|").alias("consequents"),
        *[F.round(c, 9).alias(c) for c in ("support", "confidence", "lift")],
    )


@query(
    "baskets",
    f"""with {items_sql('p_brand')}
    select basket_id, string_agg(item, '|' order by item) as items, count(*) as n_items
    from items group by basket_id""",
)
def basket_arrays(spark, sf):
    return baskets.baskets(order_items(spark, sf, "p_brand")).select(
        "basket_id",
        F.array_join("items", "|").alias("items"),
        F.size("items").cast("bigint").alias("n_items"),
    )


@query(
    "item_support",
    f"with {items_sql('p_name')} select item, count(*) as freq from items group by item",
)
def item_support(spark, sf):
    return baskets.item_support(order_items(spark, sf, "p_name"))


@query(
    "frequent_itemsets",
    f"""with {itemsets_sql('p_brand', 0.005)}
    select list_aggregate(items, 'string_agg', '|') as items, freq from itemsets""",
)
def frequent_itemsets(spark, sf):
    sets, _ = baskets.frequent_itemsets(order_items(spark, sf, "p_brand"))
    return sets.select(F.array_join("items", "|").alias("items"), "freq")


@query(
    "association_rules",
    f"with {rules_sql('p_brand', 0.005, 0.2, 'where lift > 1.1')} {_FLAT} from kept",
)
def association_rules(spark, sf):
    return _flat(baskets.rules(*baskets.frequent_itemsets(order_items(spark, sf, "p_brand"))))


@query(
    "association_rules_any_lift",
    f"with {rules_sql('p_type', 0.005, 0.2, '')} {_FLAT} from kept",
)
def association_rules_any_lift(spark, sf):
    """Rules over few items: consequents of more than one item occur."""
    sets, n = baskets.frequent_itemsets(order_items(spark, sf, "p_type"))
    return _flat(baskets.rules(sets, n, min_lift=None))


_TOP = "order by lift desc, antecedents, consequents limit {0}"


@query(
    "top_rules",
    f"""with {rules_sql('p_type', 0.005, 0.2, '')},
    top as (select * from kept {_TOP.format(50)})
    {_FLAT} from top""",
)
def top_rules(spark, sf):
    sets, n = baskets.frequent_itemsets(order_items(spark, sf, "p_type"))
    return _flat(baskets.top_rules(baskets.rules(sets, n, min_lift=None)))


def _brand_names(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as products; only those with an even number have a name."""
    number = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    return (
        table(spark, sf, "part", "p_brand")
        .where(number % 2 == 0)
        .select(
            F.col("p_brand").alias("product_id"),
            F.concat(F.lit("Maker "), number.cast("string")).alias("name"),
        )
        .distinct()
    )


def _named_sql(side: str) -> str:
    return f"""list_transform({side}, lambda x: case
        when cast(split_part(x, '#', 2) as integer) % 2 = 0
        then 'Maker ' || split_part(x, '#', 2) else x end)"""


_NAMED = f"""{rules_sql('p_brand', 0.005, 0.2, 'where lift > 1.1')},
top as (select * from kept {_TOP.format(50)}),
named as (select *, {_named_sql('antecedents')} as antecedents_names,
                 {_named_sql('consequents')} as consequents_names from top)"""


def named_rules(spark, sf):
    return baskets.mine(order_items(spark, sf, "p_brand"), _brand_names(spark, sf))


@query(
    "named_rules",
    f"""with {_NAMED}
    select list_aggregate(antecedents, 'string_agg', '|') as antecedents,
           list_aggregate(antecedents_names, 'string_agg', '|') as antecedents_names,
           list_aggregate(consequents_names, 'string_agg', '|') as consequents_names,
           round(lift, 9) as lift
    from named""",
)
def named_rules_query(spark, sf):
    return named_rules(spark, sf).select(
        F.array_join("antecedents", "|").alias("antecedents"),
        F.array_join("antecedents_names", "|").alias("antecedents_names"),
        F.array_join("consequents_names", "|").alias("consequents_names"),
        F.round("lift", 9).alias("lift"),
    )


@query(
    "rule_texts",
    f"""with {_NAMED}
    select '[' || list_aggregate(antecedents_names, 'string_agg', ', ') || '] -> ['
             || list_aggregate(consequents_names, 'string_agg', ', ') || ']' as rule,
           printf('%.1f%%', confidence * 100) as confidence, printf('%.2f', lift) as lift
    from named""",
)
def rule_texts(spark, sf):
    return report.rule_texts(named_rules(spark, sf))


@query(
    "rules_round_trip",
    f"""with {rules_sql('p_type', 0.005, 0.2, '')},
    top as (select * from kept {_TOP.format(15)})
    {_FLAT} from top""",
)
def rules_round_trip(spark, sf):
    sets, n = baskets.frequent_itemsets(order_items(spark, sf, "p_type"))
    best = baskets.top_rules(baskets.rules(sets, n, min_lift=None))
    path = scratch_path(spark, "rules")
    no_names = spark.createDataFrame([], "product_id string, name string")
    tables.write_rules(baskets.name_rules(best, no_names), path)
    return _flat(tables.read_rules(spark, path))


@query(
    "best_seller_pool",
    f"""with {CATALOG}
    select category, product_id, n as pool_rank from (
      select *, cast(row_number() over (partition by category order by product_id)
                     as integer) as n from catalog)
    where n <= 8""",
)
def best_seller_pool(spark, sf):
    return baskets.best_seller_pool(catalog(spark, sf)).select(
        "category", "product_id", "pool_rank"
    )


@query(
    "distinct_categories",
    f"""with {CATALOG}
    select distinct standardized_category as category from catalog
    where standardized_category is not null""",
)
def distinct_categories(spark, sf):
    df = catalog(spark, sf).where("standardized_category is not null")
    return df.select(F.col("standardized_category").alias("category")).distinct()
