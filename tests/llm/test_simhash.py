import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
import helpers
from pyspark.sql import functions as F

from shelfwise.llm import queries, simhash
from shelfwise.llm.common import numbered
from shelfwise.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = helpers.WORD.findall((text or "").translate(LOWER))
    width = min(3, len(words)) or 1
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    found = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [
        (i, j)
        for i, j in combinations(range(len(rows)), 2)
        if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    root = helpers.groups_of(links, range(len(rows)))
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root[i]] = min(low.get(root[i], doc_id), doc_id)
    return sorted(
        ((d, f"{prints[i]:016x}", low.get(root[i])) for i, (d, _) in enumerate(rows)), key=str
    )


def test_query_equals_brute_force(spark, sf):
    got = queries.QUERIES["op1_simhash_near_dedup"](spark, sf).collect()
    rows = helpers.table(sf, "documents", "doc_id, text")
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_awkward_rows(spark):
    rows = [r[:2] for r in helpers.awkward_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(numbered(docs, "d", "*"))
    got = got.select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    empty = spark.createDataFrame([], "doc_id long, text string, fp long")
    assert simhash.near_duplicates(numbered(empty, "d", "*")).count() == 0
    assert simhash.one_per_group(empty).columns == ["doc_id", "text", "fp"]


def test_one_per_group_keeps_the_smallest(spark):
    docs = spark.createDataFrame(helpers.awkward_rows(), helpers.DOCS)
    kept = simhash.one_per_group(docs.withColumn("root", F.lit("x")).withColumn("rid_", F.lit(1)))
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 not in ids


@pytest.mark.parametrize("chosen", [(0, 1, 2, 3, 4), (1, 3, 4, 6, 7)])
def test_long_lists_give_the_same_roots(monkeypatch, chosen):
    rng = random.Random(7)
    free = [8 * p + b for p in range(8) if p not in chosen for b in range(8)]
    values = {0}
    for _ in range(400):
        value = rng.choice(sorted(values))
        for bit in rng.sample(free, rng.randint(1, 4)):
            value ^= 1 << bit
        values.add(value)
    values = np.array(sorted(values), dtype=np.uint64)
    pairwise = simhash._list_roots(values, chosen, 3)
    monkeypatch.setattr(simhash, "PAIRWISE", 1)
    assert np.array_equal(simhash._list_roots(values, chosen, 3), pairwise)


def test_links_join_a_chain(spark):
    values = [0, 0b111, 0b111111, 0b111111 << 30, -1, -1 ^ 7]
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    found = components(simhash.near_links(prints)).collect()
    assert {(r.node, r.root) for r in found} == {(0, 0), (7, 0), (63, 0), (-1, -8), (-8, -8)}


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, x) for x in range(1001, 1300)]
    random.Random(1).shuffle(links)
    links += [(5, 5), (None, 3), (links[0][1], links[0][0])]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    whole = [(a, b) for a, b in links if a is not None and a != b]
    want = helpers.groups_of(whole, {x for pair in whole for x in pair})
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_runs_of_other_than_ascii_space():
    text = "A\x1cb c d e f"
    assert [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)] == text.encode().split()
