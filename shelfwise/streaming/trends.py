"""Counts per week over dated records, as a table or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import scratch_path


def weekly_activity(
    records: DataFrame, key: str, at: str, value: str, late: str = "1 day"
) -> DataFrame:
    """Records and summed value (in hundredths) per key and week; late rows are dropped."""
    stamped = records.withColumn("at", F.col(at).cast("timestamp")).withWatermark("at", late)
    return _per_week(stamped, key, value)


def closed_weeks(
    records: DataFrame, key: str, at: str, value: str, late: str = "1 day"
) -> DataFrame:
    """The same over a finished table: every record of the weeks that ended ``late`` or more
    before the newest record, whatever the order of the files."""
    stamped = records.withColumn("at", F.col(at).cast("timestamp"))
    newest = stamped.agg(F.max("at").alias("newest"))
    ends = F.window("at", "7 days")["end"]
    closed = F.expr(f"newest - interval {late}")
    rows = stamped.withColumn("week_end", ends).crossJoin(F.broadcast(newest))
    return _per_week(rows.where(F.col("week_end") <= closed), key, value)


def _per_week(stamped: DataFrame, key: str, value: str) -> DataFrame:
    return (
        stamped.groupBy(F.window("at", "7 days"), F.col(key))
        .agg(
            F.count("*").alias("records"),
            F.sum(F.round(F.col(value) * 100).cast("bigint")).alias("value_cents"),
        )
        .select(
            F.date_format("window.start", "yyyy-MM-dd").alias("week_start"),
            key,
            "records",
            "value_cents",
        )
    )


def run_weekly_activity(
    spark: SparkSession, source: str, file_pattern: str, schema, key: str, at: str, value: str
) -> DataFrame:
    """Closed weeks of the files below ``source``, written as a table and read back."""
    records = (
        spark.readStream.schema(schema).option("pathGlobFilter", file_pattern).parquet(source)
    )
    weekly = weekly_activity(records, key, at, value)
    out = scratch_path(spark, "weekly")
    query = (
        weekly.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(weekly.schema).parquet(f"{out}/rows")
