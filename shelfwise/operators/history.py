"""Reports over repeated snapshots, shops and stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shop_ranking(products: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Shops by mean score, each with its flagship product and country."""
    best = F.struct(F.col("final_score"), F.col("product_id"))
    shops = products.groupBy("store").agg(
        F.count("*").alias("product_count"),
        F.avg("final_score").alias("avg_score"),
        F.max_by("name", best).alias("flagship"),
    )
    if countries is not None:
        shops = shops.join(countries.select("store", "country"), "store", "left")
    return shops


def trend(
    snapshots: DataFrame,
    key: str,
    at: str,
    value: str,
    unit: str = "day",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Each snapshot beside the one before: previous value, change and direction.

    The neighbour is looked up inside (key, day); the first row of a day takes the last
    value of the latest earlier day that has one. So a product with very many snapshots
    is spread over its days. Equal times are ordered by the columns ``ties``. Rows whose key
    or time is null stay; a null time comes before all others.
    """
    dated = snapshots.withColumn("slot", F.date_trunc(unit, F.col(at)))
    by_slot = Window.partitionBy(key).orderBy("slot")
    carried = (
        dated.groupBy(key, "slot")
        .agg(F.max_by(F.col(value), F.struct(at, *ties)).alias("last_value"))
        .withColumn("carried", F.lag("last_value").over(by_slot))
        .select(F.col(key).alias("_key"), F.col("slot").alias("_slot"), "carried")
    )
    inside = Window.partitionBy(key, "slot").orderBy(at, *ties)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("slot").eqNullSafe(F.col("_slot"))
    previous = F.when(F.row_number().over(inside) == 1, F.col("carried")).otherwise(
        F.lag(value).over(inside)
    )
    change = F.col(value) - F.col("previous")
    return (
        dated.join(carried, same, "left")
        .withColumn("previous", previous)
        .withColumn("change", change)
        .withColumn(
            "direction",
            F.when(change > 0, "up").when(change < 0, "down").when(change == 0, "flat"),
        )
        .drop("slot", "carried", "_key", "_slot")
    )


def low_stock(variants: DataFrame, threshold: int) -> DataFrame:
    """Products whose variants together hold at most ``threshold`` pieces."""
    stock = variants.groupBy("product_id").agg(F.sum("inventory_quantity").alias("pieces"))
    return stock.where(F.col("pieces") <= threshold)


def promotions(products: DataFrame) -> DataFrame:
    """Products sold below their price, with the share taken off."""
    return products.where("promotional_price < price").withColumn(
        "discount_ratio", (F.col("price") - F.col("promotional_price")) / F.col("price")
    )


def density_outliers(
    df: DataFrame, group: str, value: str, eps: float, min_points: int
) -> DataFrame:
    """Values with few others near them, as rows (group, value, rows, neighbours).

    A value is dense if at least ``min_points`` rows of its group lie within ``eps`` of
    it; an outlier is neither dense nor within ``eps`` of a dense value. Equal values
    are counted first, then every value is compared inside cells of width ``eps`` with
    those of the two cells beside it, so no task sees more than three cells.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(
        F.count("*").alias("rows")
    )
    home = F.floor(F.col(value) / eps)
    dense = _near(counted.withColumn("home", home), group, value, eps, "rows", "neighbours")
    flagged = dense.withColumn("dense", (F.col("neighbours") >= min_points).cast("int"))
    reached = _near(flagged, group, value, eps, "dense", "dense_near")
    return reached.where("dense_near = 0").select(group, value, "rows", "neighbours")


def _near(
    cells: DataFrame, group: str, value: str, eps: float, weight: str, out: str
) -> DataFrame:
    """Add the sum of ``weight`` within ``eps``; ``home`` is the cell of the value."""
    around = F.explode(F.sequence(F.col("home") - 1, F.col("home") + 1))
    distance = f"{eps}D" if isinstance(eps, float) else str(eps)
    near = F.expr(
        f"sum(`{weight}`) over (partition by `{group}`, cell order by `{value}`"
        f" range between {distance} preceding and {distance} following)"
    )
    return (
        cells.withColumn("cell", around)
        .withColumn(out, near)
        .where(F.col("cell") == F.col("home"))
        .drop("cell")
    )
