"""Session set-up, the shared working folder and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app_name: str = "shelfwise", cores: str | None = None) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
        )
    spark = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_test_folders: dict[str, str] = {}


def configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is used only when the setting is missing and the session is
    local, that is in tests.
    """
    configured = configured_dir(spark)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    run = spark.sparkContext.applicationId
    if run not in _test_folders:
        _test_folders[run] = tempfile.mkdtemp(prefix="shelfwise-")
    return _test_folders[run]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/shelfwise/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage before a table is read several times (model fits); the files
    survive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evenly_written(df: DataFrame, name: str, least_rows: int = 100_000) -> DataFrame:
    """``written`` with as many files as cores and as many rows in one as in any other.

    For a table that a fit reads hundreds of times: the files of a join are as uneven as
    its partitions, and cores that got less wait at the end of every pass. A table below
    ``least_rows`` is written as it is.
    """
    if df.count() >= least_rows:
        df = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return written(df, name)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan to all cores if it has fewer splits than there are cores.

    For costly work on a small input (one file of one row group is read by one task). A
    large input has more splits than cores and stays as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def dealt(df: DataFrame, *keys: str, rows: int = 1_000_000) -> DataFrame:
    """``df`` shuffled by ``keys`` into as many partitions as hold ``rows`` rows each.

    The session's number of shuffle partitions is the same at every size, so what a task
    holds would grow with the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)), *keys)


def pinned(df: DataFrame, max_rows: int = 100_000) -> DataFrame | None:
    """``df`` as a table of constants if it has at most ``max_rows`` rows, else None.

    Reads no more than ``max_rows + 1`` rows. A pinned table is not computed again by
    the plans that use it.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows.

    A larger table comes back unchanged, so the join shuffles both sides instead.
    """
    small = pinned(df, max_rows)
    return df if small is None else F.broadcast(small)
