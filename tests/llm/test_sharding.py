import zlib
from collections import Counter

import helpers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import queries, sharding
from shelfwise.llm.common import written


def check(rows, got, near):
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert {r.law for r in got} <= {"bytes"} and all(r.grown_shard is None for r in got)
    load = Counter()
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    for r in got:
        load[r.shard] += r.size
    mean = sum(load.values()) / 8
    assert all(abs(load[s] - mean) <= near * mean for s in range(8))


@pytest.mark.parametrize(("name", "near"), [("sf0.001", 0.01), ("sf0.01", 0.001)])
def test_query_deals_bytes_evenly(spark, name, near):
    sf = f"/root/testdata/{name}"
    got = queries.QUERIES["op10_shard"](spark, sf).collect()
    rows = helpers.table(sf, "documents", "doc_id, text")
    check(rows, got, near)
    shards = {}
    for r in got:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame([(*r, 9) for r in rows], helpers.DOCS + ", shard int")
    check([r[:2] for r in rows], sharding.sharded(docs).collect(), 10)
    assert sharding.sharded(spark.createDataFrame([], helpers.DOCS)).count() == 0


def test_a_heavy_text_is_split(spark):
    rows = [(i, "the same text again " * 5) for i in range(2000)]
    rows += [(i, f"text {i} " * 12) for i in range(2000, 4000)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got, 0.02)


def test_rebalancing_edits_the_map(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "x" * (i % 97)) for i in range(3000)], "doc_id long, text string")
    rows = written(sharding.with_slots(sharding.sized(docs), 8, 256), "rows")
    first = sharding.slot_map(rows, 8, 256)
    second = sharding.rebalanced(first, rows, 9, 256)
    old, new = ({r.slot: r for r in m.collect()} for m in (first, second))
    assert {r.version for r in new.values()} == {2} and len(new) == 256
    moved = {s for s in new if new[s].shard != old[s].shard}
    assert moved and all(new[s].shard == 8 for s in moved)
    load = Counter()
    for r in new.values():
        load[r.shard] += r.bytes
    assert max(load.values()) <= 1.05 * min(load.values())
    same = sharding.rebalanced(second, rows, 9, 256)
    assert {r.slot: r.shard for r in same.collect()} == {s: r.shard for s, r in new.items()}
    third = sharding.rebalanced(second, rows.where(F.col("vslot") < 200), 7, 256)
    assert {r.shard for r in third.collect()} == set(range(7))
