import hashlib

import duckdb
import helpers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import licenses, queries

MIT = licenses.KNOWN[0][1]


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name):
    sf = f"/root/testdata/{name}"
    got = queries.QUERIES["op4_license_scan"](spark, sf).collect()
    duckdb.sql(f"create or replace view documents as from read_parquet('{sf}/documents.parquet')")
    want = duckdb.sql(queries.ORACLE["op4_license_scan"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r.n_license_lines for r in got)


def texts(spark, *rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_entire_texts_match_by_their_canonical_form(spark):
    shouted = MIT.upper().replace("LICENSE", "Licence").replace(",", " ;\t")
    held = MIT.replace("Copyright (c) <year> <copyright holders>", "(C) 2019 Some One\nCopyright 2020 X")
    flowed = " ".join(x for x in held.split("\n") if "2019" not in x and "2020" not in x)
    got = texts(spark, MIT, shouted, held, flowed, MIT + " No.", MIT[:-30], "Licensed under CC BY-NC 4.0")
    assert [got[i].license for i in range(7)] == ["MIT"] * 4 + [None] * 2 + ["CC-BY-NC-4.0"]


def test_lines(spark):
    got = texts(
        spark,
        "Some text.\nReleased under the MIT licence.\nMore.\n  LICENSED under the Apache Licence, v2.0",
        "We are not Released under the MIT License. Or so.",
        "Released under the MIT License.\r\nReleased under the MIT License.",
    )
    assert got[0].line_licenses == ["Apache-2.0", "MIT"] and got[0].n_license_lines == 2
    assert got[1].line_licenses == [] and got[1].license is None
    assert got[2].line_licenses == ["MIT"] and got[2].n_license_lines == 2


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], helpers.DOCS + ", license string")
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows) and all(r.license is None for r in got)
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r.digest == empty for r in got) == 4
    assert licenses.scan(spark.createDataFrame([], helpers.DOCS)).count() == 0


def test_known_texts_may_be_a_table(spark):
    known = spark.createDataFrame([("Own", "My own terms.")], "license string, text string")
    docs = spark.createDataFrame([(1, "MY OWN TERMS"), (2, MIT)], "doc_id long, text string")
    got = licenses.scan(docs, known).where(F.col("license").isNotNull()).collect()
    assert [(r.doc_id, r.license) for r in got] == [(1, "Own")]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
