import pytest
from pyspark.sql import functions as F

from shelfwise import session


def test_written_table_keeps_rows_and_types(spark):
    df = spark.range(5).select("id", F.array(F.col("id").cast("int")).alias("a"))
    back = session.written(df, "t")
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())
    assert session.written(df, "t").inputFiles() != back.inputFiles()


def test_own_folder_only_where_none_is_named(spark, monkeypatch):
    monkeypatch.setattr(session, "configured_dir", lambda _: "/somewhere/shared/")
    assert session.shared_dir(spark) == "/somewhere/shared"
    monkeypatch.setattr(session, "configured_dir", lambda _: None)
    assert session.shared_dir(spark) == session.shared_dir(spark)

    class OnCluster:
        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(OnCluster)


def test_only_small_tables_are_broadcast(spark):
    big = spark.range(1000)
    assert session.pinned(big, 999) is None
    assert session.pinned(big, 1000).count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            big.join(session.checked_broadcast(spark.range(10), n), "id")._jdf.queryExecution().toString()
            for n in (10, 9)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
