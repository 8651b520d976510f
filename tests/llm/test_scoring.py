import math
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest

from shelfwise.llm import queries, scoring


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*helpers.WORD.findall(low), None]


def check_base(rows, got):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    counts = Counter(t for (_, x), h in zip(rows, held, strict=True) if not h for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = []
    for (d, text), h in zip(rows, held, strict=True):
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        want.append((str(d), h, len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    have = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in got
    ]
    assert sorted(have) == sorted(want)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, name):
    sf = f"/root/testdata/{name}"
    got = queries.QUERIES["op7_lm_scores"](spark, sf).collect()
    check_base(helpers.table(sf, "documents", "doc_id, text"), got)
    held = [r for r in got if r.held_out]
    assert all(r.score < 0 for r in got)
    # The mixture predicts texts that it has not seen better than the base does.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def plain_scores(rows, weights):
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for (_, text), h in zip(rows, held, strict=True):
        if not h:
            own = tokens(text)
            words.update(own)
            pairs.update(zip([None, *own], own, strict=False))
    contexts = words
    n, v = sum(words.values()), len(words)
    for d, text in rows:
        own, total = tokens(text), 0.0
        for a, b in zip([None, *own], own, strict=False):
            c = contexts[a]
            w = weights[0 if c == 0 else min(1 + int(math.log2(c)), scoring.BUCKETS - 1)]
            p2 = pairs[a, b] / c if c else 0.0
            total += math.log10(w[0] * p2 + w[1] * words[b] / n + w[2] / (v + 1))
        yield d, total


def test_scores_equal_the_formula(spark, sf):
    rows = helpers.table(sf, "documents", "doc_id, text")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chunks = scoring.token_chunks(docs)
    totals, n, v = scoring.counted(chunks)
    weights = scoring.mixture(chunks, totals, n, v)
    assert np.allclose(weights.sum(axis=1), 1) and (weights > 0).all()
    assert weights[0][0] < 0.34
    got = {r.doc_id: r.score for r in scoring.scored(docs).collect()}
    for d, score in plain_scores(rows, weights):
        assert got[d] == pytest.approx(score, rel=1e-9)


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame([(*r, True, 1) for r in rows], helpers.DOCS + ", held boolean, chunk int")
    check_base([r[:2] for r in rows], scoring.scored(docs).collect())
    assert scoring.scored(spark.createDataFrame([], helpers.DOCS)).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    row = scoring.scored(docs).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score)
