import datetime
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry


def test_files_in_any_time_order(spark, tmp_path):
    """An events table of several files, the newest file first."""
    rng = random.Random(1)
    start = datetime.datetime(2024, 1, 1)
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    for i, month in enumerate([3, 0, 2, 1]):
        at = [start + datetime.timedelta(days=30 * month, minutes=rng.randrange(43_200)) for _ in range(200)]
        rows = {"event_id": range(200), "ts": pa.array(at, pa.timestamp("us"))}
        rows |= {"event_type": [rng.choice("ab") for _ in at], "value": [rng.randrange(999) / 100 for _ in at]}
        pq.write_table(pa.table(rows), folder / f"part-{i}.parquet")
    got = entry.queries()["weekly_activity"](spark, str(tmp_path)).collect()
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{folder}/*.parquet'")
    want = db.sql(entry.oracle_sql()["weekly_activity"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 20
