import hashlib
import math
import random
import re
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest

from shelfwise.llm import queries, resampling
from shelfwise.llm.common import written

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def features(text, max_run=1):
    words = WORD.findall((text or "").translate(SMALL))
    runs = [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(rows, target, max_run=1, buckets=10_000, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of every row, as the definition has it."""
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    own = [features(text, max_run) for _, text in rows]
    s = Counter(bucket(r) for _, runs in own for r in runs)
    t = Counter(bucket(r) for text in target for r in features(text, max_run)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)
    }
    out = []
    for (doc_id, _), (n, runs) in zip(rows, own, strict=True):
        weight = sum(gain[bucket(r)] for r in runs) // len(runs) if runs else 0
        key = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(runs), weight, score, None, n])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(order[: percent * len(order) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in out]


def test_query_equals_definition(spark, sf):
    got = Counter(tuple(r) for r in queries.QUERIES["op13_importance_resampling"](spark, sf).collect())
    target = [t for (t,) in helpers.table(sf, "benchmark", "text")]
    assert got == Counter(plain(helpers.table(sf, "documents", "doc_id, text"), target))


@pytest.mark.parametrize("max_run", [1, 3])
def test_awkward_rows(spark, max_run):
    rows = [(*r, 1, "x", 9) for r in helpers.awkward_rows()]
    docs = spark.createDataFrame(rows, helpers.DOCS + ", score int, rank string, rid int")
    target = spark.createDataFrame([("The Quick brown é9x",), (None,), ("",)], "text string")
    options = {"max_run": max_run, "buckets": 50, "min_words": 3, "percent": 60}
    got = resampling.resampled(docs, target, **options).collect()
    want = plain([r[:2] for r in rows], ["The Quick brown é9x"], max_run, 50, 3, 60)
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert resampling.resampled(docs.limit(0), target).count() == 0
    assert resampling.resampled(docs, target.limit(0)).count() == len(rows)


def test_one_id_with_a_third_of_the_rows(spark):
    rows = [(7 if i % 3 == 0 else i, f"some word{i % 50} " * 20) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("word1 word2",)], "text string")
    got = resampling.resampled(docs, target, percent=50).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(r[:4] for r in plain(rows, ["word1 word2"], percent=50))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 301))
    best = [r[3] for r in sorted(got, key=lambda r: r["rank"] or 10**9)[:300]]
    assert best == sorted((r.score for r in got), reverse=True)[:300]


def test_ties_go_to_the_smaller_key(spark):
    rows = [(i, i % 7, 5 if i % 2 else 6, True) for i in range(100)]
    scored = written(spark.createDataFrame(rows, "rid long, doc_id long, score long, eligible boolean"), "s")
    got = sorted((r for r in resampling.drawn(scored, 70, "doc_id").collect() if r["rank"]), key=lambda r: r["rank"])
    want = sorted(rows, key=lambda r: (-r[2], r[1], r[0]))[:70]
    assert [r.rid for r in got] == [r[0] for r in want]
    assert {r["rank"] for r in resampling.drawn(scored, 0, "doc_id").collect()} == {None}


def test_scans_compose_the_crcs_of_runs():
    rng = random.Random(2)
    for _ in range(60):
        words = ["".join(rng.choices("abc09é漢", k=rng.randint(1, 40))) for _ in range(rng.randint(0, 30))]
        text = f" {' '.join(words)} "
        other = " b a bb "
        dictionary = resampling.Dictionary([text, other])
        n, got = dictionary.features(text, 4)
        want = [zlib.crc32(r.encode()) for r in features(text, 4)[1]]
        assert n == len(words) and got.tolist() == want


def test_crcs_compose():
    rng = random.Random(4)
    pairs = [(rng.randbytes(rng.randint(0, 300)), rng.randbytes(rng.randint(0, 5000))) for _ in range(40)]
    left = np.array([zlib.crc32(a) for a, _ in pairs], dtype=np.uint32)
    right = np.array([zlib.crc32(b) for _, b in pairs], dtype=np.uint32)
    got = resampling.composed(left, right, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]
