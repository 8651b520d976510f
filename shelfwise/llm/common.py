"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import scratch_path, written

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch of rows that goes to Python, but for one longer row.
BATCH_BYTES = "4m"

__all__ = [
    "WORD",
    "bucketed",
    "buckets_of",
    "documents",
    "key_parts",
    "map_batches",
    "numbered",
    "prefix_sums",
    "schema_of",
    "scratch_path",
    "squeezed",
    "squeezed_keys",
    "stashed",
    "unsqueezed",
    "unsqueezed_keys",
    "written",
]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def numbered(df: DataFrame, name: str, *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of ``df`` as a written table, with a unique ``rid`` per row.

    Rows may repeat and ids may be null, so later steps refer to rows by ``rid``. It is
    read from a written table and hence never dealt out twice.
    """
    return written(df.select(*keep, F.monotonically_increasing_id().alias("rid")), name)


def stashed(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with only the columns ``used`` under their names, and how to get all back.

    The others travel in one struct, so that their names cannot clash with those that an
    operator adds.
    """
    names = list(dict.fromkeys(used))
    others = [c for c in docs.columns if c not in names]
    kept = [F.col(f"`{c}`") for c in names]
    if others:
        kept.append(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_others"))
    back = [
        (F.col(f"`{c}`") if c in names else F.col("_others").getField(c)).alias(c)
        for c in docs.columns
    ]
    return docs.select(*kept), back


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` over batches of ``BATCH_BYTES``, for rows that hold whole texts.

    Spark's batches of 64 MB exist several times at once, in the JVM's Arrow buffers and
    in the worker, and both keep that memory for the next task. The smaller bound stays set
    in the session, as Spark reads it when the plan runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def schema_of(df: DataFrame, columns: Sequence[str]) -> str:
    """The schema text of some columns, for functions over Arrow batches."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by a column.

    Groups by that column are then read without a shuffle of the table. There are as many
    buckets as shuffle partitions.
    """
    path = scratch_path(df.sparkSession, name)
    table = "chunks_" + path.rsplit("-", 1)[1]
    (
        df.write.bucketBy(buckets_of(df.sparkSession), by)
        .format("parquet")
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def squeezed(values: np.ndarray) -> bytes:
    """An array of whole numbers as compressed bytes, like bytes beside each other."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(-1, raw.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, compressed as steps."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unsqueezed_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(data, np.uint64), dtype=np.uint64)


def key_parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ends of ``parts`` equal ranges of 64-bit keys in sorted ``keys``, led by 0."""
    bounds = [(i << 64) // parts for i in range(1, parts)]
    inner = np.searchsorted(keys, np.array(bounds, dtype=np.uint64))
    return np.concatenate(([0], inner, [len(keys)])).astype(np.int64)


def prefix_sums(
    df: DataFrame,
    key: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    size: Column,
    into: str,
) -> DataFrame:
    """Add ``into``: the sum of ``size`` over the rows before this one within ``key``.

    Rows are ordered by ``bucket`` and then by ``order``. Sums per bucket are added up
    first, so no task sees more than one bucket of rows or one key's bucket sums; a key
    with a third of all rows is spread over its buckets. ``df`` must be a written table,
    as it is read twice.
    """
    sums = df.groupBy(*key, bucket).agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *(F.col(k).alias(f"_{k}") for k in key),
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    inside = (
        Window.partitionBy(*key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    met = same[0]
    for more in same[1:]:
        met = met & more
    return (
        df.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(starts, met & F.col(bucket).eqNullSafe(F.col("_bucket")))
        .withColumn(into, F.col("_start") + F.col("_inside"))
        .drop("_inside", "_start", "_bucket", *(f"_{k}" for k in key))
    )
