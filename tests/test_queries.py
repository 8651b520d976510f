"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of, types_of  # noqa: E402

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, db, name):
    got = QUERIES[name](spark, sf).toArrow()
    want = db.sql(ORACLE[name]).to_arrow_table()
    assert types_of(got) == types_of(want)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
