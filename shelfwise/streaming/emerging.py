"""Products whose activity grows, week by week, from a stream of dated records.

Every product and week is an entry of a streaming aggregate. A week is closed by the
watermark, once a record of a week has come that begins ``late`` days or more after its end;
its counts are then final and go to the table of closed weeks. Weeks still open are read
from the state itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import scratch_path, written

TOP = 5
LATE_DAYS = 14
_DAY_US = 86_400_000_000


def week_number(at: Column) -> Column:
    """Weeks of seven days, counted from 1970-01-01."""
    return F.floor(F.unix_date(at.cast("date")) / 7).cast("bigint")


def week_start(week: Column) -> Column:
    return F.date_format(F.date_from_unix_date((week * 7).cast("int")), "yyyy-MM-dd")


def partial_counts(records: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(``product``, ``week``, ``week_end``, ``records``, ``cents``), added up before any shuffle.

    Each batch of rows is counted where it is read, so a product with a third of all
    records sends few rows. A record without a time is in no week and left out.
    """
    rows = records.where(F.col(at).isNotNull()).select(
        F.col(key).cast("string").alias("product"),
        week_number(F.col(at)).alias("week"),
        F.coalesce(F.round(F.col(value) * 100).cast("bigint"), F.lit(0)).alias("cents"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.table(batch).group_by(["product", "week"]).aggregate([([], "count_all"), ("cents", "sum")])
            ends = pc.multiply(pc.add(sums["week"], 1), 7 * _DAY_US)
            yield from pa.table(
                {
                    "product": sums["product"],
                    "week": sums["week"],
                    "week_end": ends.cast(pa.timestamp("us", "UTC")),
                    "records": sums["count_all"],
                    "cents": sums["cents_sum"],
                }
            ).to_batches()

    return rows.mapInArrow(
        count, "product string, week bigint, week_end timestamp, records bigint, cents bigint"
    )


def closed_weeks(partial: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """A stream of (``product``, ``week_end``, ``records``, ``cents``), each once, when it is final.

    Every product and week is one entry of the state, added up without a call per product.
    Counts of a week that is closed are late and dropped.
    """
    return (
        partial.withWatermark("week_end", f"{late_days + 7} days")
        .groupBy("product", "week_end")
        .agg(F.sum("records").alias("records"), F.sum("cents").alias("cents"))
    )


def open_weeks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The same columns for the weeks that the state of a stream still holds open."""
    state = spark.read.format("statestore").load(checkpoint)
    # Both sums have the same name in the state: they are told apart by their places.
    sums = F.col("value").cast("struct<records: bigint, cents: bigint>").alias("sums")
    return state.select("key.product", "key.week_end", sums).select("product", "week_end", "sums.*")


def with_previous(weeks: DataFrame) -> DataFrame:
    """Add ``previous``, the product's records in the week before, 0 without any."""
    before = Window.partitionBy("product").orderBy("week")
    follows = F.lag("week").over(before) == F.col("week") - 1
    return weeks.withColumn(
        "previous", F.when(follows, F.lag("records").over(before)).otherwise(F.lit(0))
    )


@dataclass
class Emerging:
    """``weeks``: every product and week counted; ``top``: the fastest growing of each week;
    ``late``: records that came after their week was closed."""

    weeks: DataFrame
    top: DataFrame
    late: int


def top_growing(weeks: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` products of each week that grew most against the week before.

    Ties go to more records, then to the smaller product. The rank filter runs before the
    shuffle too, so a week sends ``top`` rows a task.
    """
    growth = F.col("records") - F.col("previous")
    order = Window.partitionBy("week").orderBy(F.desc("growth"), F.desc("records"), "product")
    return (
        weeks.withColumn("growth", growth)
        .where("growth > 0")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )


def run_emerging(
    spark: SparkSession,
    source: str,
    schema: Any,
    key: str,
    at: str,
    value: str,
    late_days: int = LATE_DAYS,
    files_per_batch: int = 1,
    top: int = TOP,
    path: str | None = None,
) -> Emerging:
    """Take up all files below ``source`` that are new since the last run with the same ``path``.

    ``source`` holds Parquet files of records with the columns ``key``, ``at`` and ``value``. Closed
    weeks are appended to a table below ``path`` by the stream's own commit log, so a run that
    is broken off goes on where it stopped. Null products are one product; null values count
    as zero; repeated records count each; without files there are no weeks.
    """
    path = path or scratch_path(spark, "emerging")
    records = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    closed = closed_weeks(partial_counts(records, key, at, value), late_days)
    query = (
        closed.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{path}/closed")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done = spark.read.schema(closed.schema).parquet(f"{path}/closed")
    is_open = F.lit(True).alias("is_open")
    both = done.withColumn("is_open", F.lit(False)).union(
        open_weeks(spark, f"{path}/checkpoint").select("*", is_open)
    )
    week = (week_number(F.col("week_end")) - 1).alias("week")
    weeks = with_previous(both.select("product", week, "records", "cents", "is_open")).select(
        "product", "week", "records", "cents", "previous", "is_open"
    )
    weeks = written(weeks, "product-weeks")
    counted = weeks.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    dated = spark.read.schema(schema).parquet(source).where(F.col(at).isNotNull())
    return Emerging(weeks, top_growing(weeks, top), dated.count() - counted)
