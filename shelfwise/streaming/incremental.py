"""Enrichment in lots: new product files are enriched once, results are kept per lot."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import contracts, enrichment
from shelfwise.operators.catalog import dedupe_products
from shelfwise.schemas import ENRICHED, PRODUCT, PRODUCT_KEY, SHOP
from shelfwise.session import written

LOGGER = logging.getLogger(__name__)

LANDED = T.StructType([*SHOP.fields, *PRODUCT.fields])
NOTE = "lot bigint, error string"


@dataclass(frozen=True)
class Store:
    """Folders of one incremental run."""

    root: str

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"

    @property
    def failed_lots(self) -> str:
        return f"{self.root}/failed_lots"

    @property
    def failed_products(self) -> str:
        return f"{self.root}/failed_products"

    @property
    def waiting(self) -> str:
        """Products whose call failed, by lot; the next run offers them again."""
        return f"{self.root}/waiting"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_cache(spark: SparkSession, store: Store) -> DataFrame:
    """Everything enriched so far."""
    schema = T.StructType([*SHOP.fields, *ENRICHED.fields, T.StructField("lot", T.LongType())])
    return _read_or_empty(spark, store.enriched, schema)


def enrich_lot(
    batch: DataFrame,
    lot: int,
    store: Store,
    enrich: Callable[[DataFrame], DataFrame],
) -> None:
    """Enrich the products of one lot that are not in the table yet.

    Every product is then in the table, or waiting because its call failed, or, with its
    reasons, among the errors: it breaks the contract, or what came back for it does. A lot
    writes only its own folders and replaces them, so a repeated lot changes nothing.
    """
    spark = batch.sparkSession
    checked = written(contracts.check_products(batch), "checked")
    broken = checked.where(F.col("reasons") != "").select(
        *PRODUCT_KEY, F.col("reasons").alias("error")
    )
    products = dedupe_products(
        contracts.valid(checked), PRODUCT_KEY, order=("name", "price", "description")
    )
    # Only rows that passed the contract are in the table, so their keys are enough; the
    # scan reads these columns alone.
    earlier = read_cache(spark, store).where(F.col("lot") != lot).select(
        *[F.col(c).alias(f"earlier_{c}") for c in PRODUCT_KEY]
    )
    same = [F.col(c).eqNullSafe(F.col(f"earlier_{c}")) for c in PRODUCT_KEY]
    misses = products.join(earlier, same, "left_anti")
    misses = written(misses, "misses")
    found = enrich(misses)
    contracts.require_columns(found, PRODUCT_KEY)
    found = written(found, "lot-results")
    if "error" in found.columns:
        # A failed call says nothing of the product: it waits for the next run.
        failed = found.where("error is not null").select(
            *[F.col(c).alias(f"failed_{c}") for c in PRODUCT_KEY], F.col("error")
        )
        same = [F.col(c).eqNullSafe(F.col(f"failed_{c}")) for c in PRODUCT_KEY]
        waiting = misses.join(failed, same).select(*LANDED.names, "error")
        waiting.write.mode("overwrite").parquet(f"{store.waiting}/lot={lot}")
        found = found.where("error is null")
    good, bad = enrichment.split_results(found)
    good.write.mode("overwrite").parquet(f"{store.enriched}/lot={lot}")
    bad.unionByName(broken).write.mode("overwrite").parquet(f"{store.errors}/lot={lot}")


def _note(spark: SparkSession, lot: int, store: Store, error: str | None) -> None:
    """Note a failed lot; without an error, its note is emptied."""
    rows = [] if error is None else [(lot, error)]
    note = spark.createDataFrame(rows, NOTE)
    note.write.mode("overwrite").parquet(f"{store.failed_lots}/id={lot}")


def retry_failed(
    spark: SparkSession, store: Store, enrich: Callable[[DataFrame], DataFrame]
) -> None:
    """Take up the lots that failed before, the oldest first."""
    notes = _read_or_empty(spark, store.failed_lots, T.StructType.fromDDL(NOTE))
    for lot in sorted(row["lot"] for row in notes.select("lot").collect()):
        kept = f"{store.failed_products}/id={lot}"
        try:
            enrich_lot(spark.read.schema(LANDED).parquet(kept), lot, store, enrich)
        except Exception as problem:
            LOGGER.exception("lot %s failed again", lot)
            _note(spark, lot, store, str(problem))
        else:
            _note(spark, lot, store, None)
            spark.createDataFrame([], LANDED).write.mode("overwrite").parquet(kept)


def read_waiting(spark: SparkSession, store: Store) -> DataFrame:
    """Products whose call failed, with the error and the lot."""
    schema = T.StructType([*LANDED.fields, *T.StructType.fromDDL("error string, lot bigint").fields])
    return _read_or_empty(spark, store.waiting, schema)


def retry_waiting(
    spark: SparkSession, store: Store, enrich: Callable[[DataFrame], DataFrame]
) -> None:
    """Offer the products whose call failed once more, as a lot of their own.

    Such lots count down from -1, apart from those of the stream. The earlier lots' waiting
    products are let go only when the new lot is written; a run that is broken off in
    between offers them again, and what is in the table by then is not enriched twice.
    """
    waiting = read_waiting(spark, store)
    lots = sorted(row["lot"] for row in waiting.select("lot").distinct().collect())
    if not lots:
        return
    taken = read_cache(spark, store).agg(F.min("lot")).first()[0]
    lot = min(0, lots[0], taken if taken is not None else 0) - 1
    products = written(waiting.select(*LANDED.names), "waiting")
    try:
        enrich_lot(products, lot, store, enrich)
    except Exception:
        LOGGER.exception("products that wait failed again")
        return
    for done in lots:
        spark.createDataFrame([], T.StructType([*LANDED.fields, *T.StructType.fromDDL("error string").fields])).write.mode(
            "overwrite"
        ).parquet(f"{store.waiting}/lot={done}")


def enrich_incremental(
    spark: SparkSession,
    source: str,
    store: Store,
    enrich: Callable[[DataFrame], DataFrame] = enrichment.enrich_with_rules,
    files_per_lot: int = 1000,
) -> DataFrame:
    """Run over all product files not seen before; gives the whole enriched table back.

    A lot is the products of up to ``files_per_lot`` files. One that fails is noted under
    ``failed_lots``, its products are kept, and the next run takes it up first. A lot whose
    products can't be kept ends the run, and the next run reads its files again. A product
    whose call failed in a lot that went through waits and is offered once more at the
    start of every run.
    """

    def handle(batch: DataFrame, lot: int) -> None:
        try:
            enrich_lot(batch, lot, store, enrich)
        except Exception as problem:
            LOGGER.exception("lot %s failed", lot)
            kept = f"{store.failed_products}/id={lot}"
            batch.write.mode("overwrite").parquet(kept)
            _note(batch.sparkSession, lot, store, str(problem))

    retry_failed(spark, store, enrich)
    retry_waiting(spark, store, enrich)
    query = (
        spark.readStream.schema(LANDED)
        .option("maxFilesPerTrigger", files_per_lot)
        .json(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", store.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_cache(spark, store)
