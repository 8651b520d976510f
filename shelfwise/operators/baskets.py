"""Baskets, frequent item sets and association rules."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import checked_broadcast, written

# Thresholds of the rule job.
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.2
MIN_LIFT = 1.1
KEPT_RULES = 50
POOL_SIZE = 8


def best_seller_pool(
    products: DataFrame, size: int = POOL_SIZE, category: str = "category"
) -> DataFrame:
    """The first products of every category (the filter also runs before the shuffle)."""
    w = Window.partitionBy(category).orderBy("product_id")
    return products.withColumn("pool_rank", F.row_number().over(w)).where(
        F.col("pool_rank") <= size
    )


def basket_items(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket_id, item) pairs."""
    return (
        lines.select(
            F.col(basket).cast("string").alias("basket_id"),
            F.col(item).cast("string").alias("item"),
        )
        .where("item is not null")
        .distinct()
    )


def baskets(items: DataFrame) -> DataFrame:
    """One sorted array of items per basket; ``items`` has distinct (basket_id, item)."""
    return items.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))


def item_support(items: DataFrame) -> DataFrame:
    """Number of baskets per item."""
    return items.groupBy("item").agg(F.count("*").alias("freq"))


def _least_count(min_support: float, baskets_: int) -> int:
    """The smallest count whose share of the baskets is not below the support."""
    count = max(1, math.ceil(min_support * baskets_))
    while count > 1 and (count - 1) / baskets_ >= min_support:
        count -= 1
    return count


def frequent_itemsets(
    items: DataFrame, min_support: float = MIN_SUPPORT
) -> tuple[DataFrame, int]:
    """(item sets with their basket counts, number of baskets).

    Items below the support cannot be in a frequent set, so they are dropped before
    baskets are built: the number of frequent items is at most the average basket
    length divided by the support, which bounds every array, also that of a basket
    holding most of the rows.
    """
    items = written(items, "basket-items")
    n = items.agg(F.count_distinct("basket_id")).first()[0]
    schema = "items array<string>, freq bigint"
    if n == 0:
        return items.sparkSession.createDataFrame([], schema), 0
    min_count = _least_count(min_support, n)
    frequent = item_support(items).where(F.col("freq") >= min_count).select("item")
    kept = baskets(items.join(checked_broadcast(frequent), "item", "left_semi"))
    equal = kept.groupBy("items").agg(F.count("*").alias("freq"))
    return written(grown_itemsets(equal, min_count), "itemsets"), n


def grown_itemsets(weighted: DataFrame, min_count: int) -> DataFrame:
    """FP-growth over different baskets, sorted arrays ``items`` that occur ``freq`` times.

    Every frequent set has its conditional base: what stands before its first item in the
    baskets that hold it. Equal ones are one row with their count, as in one branch of the
    tree. Each round counts all sets that are one item longer, keeps the frequent ones and
    makes their bases; a round is an aggregate, its rows are not more than the different
    bases.
    """
    bases = written(
        weighted.select(
            F.array().cast("array<string>").alias("items"), F.col("items").alias("before"), "freq"
        ),
        "bases",
    )
    found = []
    while True:
        longer = bases.select(
            F.explode(
                F.transform("before", lambda x: F.concat(F.array(x), F.col("items")))
            ).alias("items"),
            "freq",
        )
        sets = written(
            longer.groupBy("items").agg(F.sum("freq").alias("freq")).where(F.col("freq") >= min_count),
            "frequent-sets",
        )
        found.append(sets)
        if sets.isEmpty():
            break
        # The first item of a basket has nothing before it and grows no further.
        later = bases.where(F.size("before") > 1).select(
            "items", "freq", "before", F.explode(F.sequence(F.lit(1), F.size("before") - 1)).alias("i")
        )
        grown = later.select(
            F.concat(F.array(F.get("before", "i")), F.col("items")).alias("items"),
            F.slice("before", 1, F.col("i")).alias("before"),
            "freq",
        )
        bases = written(
            grown.join(checked_broadcast(sets.select("items")), "items", "left_semi")
            .groupBy("items", "before")
            .agg(F.sum("freq").alias("freq")),
            "bases",
        )
    return reduce(DataFrame.union, found)


def rules(
    itemsets: DataFrame,
    basket_count: int,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float | None = MIN_LIFT,
) -> DataFrame:
    """Every split of every item set into antecedent and consequent that is confident.

    A larger consequent leaves a smaller antecedent and so a lower confidence: consequents
    grow item by item, in the order of the set, from those that reached the confidence.
    Supports of both parts are looked up by equality on the sorted arrays (all parts of a
    frequent set are frequent, so both lookups always hit).
    """
    n = F.lit(float(basket_count))
    left = itemsets.select(
        F.col("items").alias("antecedents"), F.col("freq").alias("ant_freq")
    )
    right = itemsets.select(
        F.col("items").alias("consequents"), F.col("freq").alias("con_freq")
    )
    grown = itemsets.where(F.size("items") >= 2).select(
        "items", "freq", F.explode(F.transform("items", lambda x: F.array(x))).alias("consequents")
    )
    found = []
    while True:
        confident = written(
            grown.where(F.size("consequents") < F.size("items"))
            .withColumn("antecedents", F.array_except("items", "consequents"))
            .join(left, "antecedents")
            .withColumn("confidence", F.col("freq") / F.col("ant_freq"))
            .where(F.col("confidence") >= min_confidence),
            "confident",
        )
        found.append(confident)
        if confident.isEmpty():
            break
        later = F.filter("items", lambda x: x > F.element_at("consequents", -1))
        grown = confident.select("items", "freq", "consequents", F.explode(later).alias("x")).select(
            "items", "freq", F.concat("consequents", F.array("x")).alias("consequents")
        )
    out = (
        reduce(DataFrame.union, found)
        .join(right, "consequents")
        .withColumn("support", F.col("freq") / n)
        .withColumn("lift", F.col("confidence") / (F.col("con_freq") / n))
    )
    if min_lift is not None:
        out = out.where(F.col("lift") > min_lift)
    return out.select("antecedents", "consequents", "support", "confidence", "lift")


def top_rules(found: DataFrame, limit: int = KEPT_RULES) -> DataFrame:
    """The strongest rules by lift; ties by antecedent, then consequent."""
    return found.orderBy(F.desc("lift"), "antecedents", "consequents").limit(limit)


def name_rules(found: DataFrame, products: DataFrame) -> DataFrame:
    """Add the names of the items on both sides; an item without a name keeps its id.

    ``found`` is a short list (see ``top_rules``). The product table is first reduced to
    the items that occur, so the large side never moves.
    """
    rule = ["antecedents", "consequents"]
    item_rows = reduce(
        DataFrame.unionByName,
        [
            found.select(*rule, F.lit(side).alias("side"), F.posexplode(side).alias("i", "item"))
            for side in rule
        ],
    )
    wanted = checked_broadcast(item_rows.select("item").distinct())
    names = (
        products.select(F.col("product_id").alias("item"), "name")
        .join(wanted, "item", "left_semi")
        .groupBy("item")
        .agg(F.min("name").alias("name"))
    )
    named = (
        item_rows.join(checked_broadcast(names), "item", "left")
        .groupBy(*rule)
        .agg(
            *[
                F.transform(
                    F.array_sort(
                        F.collect_list(
                            F.when(
                                F.col("side") == side,
                                F.struct("i", F.coalesce("name", "item").alias("name")),
                            )
                        )
                    ),
                    lambda r: r["name"],
                ).alias(f"{side}_names")
                for side in rule
            ]
        )
    )
    return found.join(named, rule).select(
        "antecedents",
        "consequents",
        "antecedents_names",
        "consequents_names",
        "support",
        "confidence",
        "lift",
    )


def mine(
    items: DataFrame,
    products: DataFrame | None = None,
    *,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float | None = MIN_LIFT,
    limit: int = KEPT_RULES,
) -> DataFrame:
    """Baskets to the strongest named rules."""
    sets, n = frequent_itemsets(items, min_support)
    best = top_rules(rules(sets, n, min_confidence, min_lift), limit)
    if products is None:
        products = items.sparkSession.createDataFrame([], "product_id string, name string")
    return name_rules(written(best, "rules"), products)
