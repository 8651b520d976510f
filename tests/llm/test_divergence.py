import random
import re
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest

from shelfwise.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=10, top=10):
    """The audit as its definition has it, over all terms of every pair."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(SMALL))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups[lang].add(source)
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(count, kept=kept, v=v):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        by_source = {s: shares(counts[lang, s]) for s in sources}
        for s, p in by_source.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), o) for o, q in by_source.items() if o != s]
            over = [
                (f(p[t], whole[t]), t) for t in kept if counts[lang, s][t] and p[t] > whole[t]
            ]
            for part, items in (("pair", pairs), ("term", over)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items, 1):
                    if part == "pair" or rank <= top:
                        yield lang, s, part, item, value, rank


def rows_of(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def random_rows(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{c}" for c in "abcdefghij"] + ["Été", "été", "x\x0by", "漢字", "don't", "UP9down", ""]
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 30])))
        yield i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", "", None]), 1


@pytest.mark.parametrize("seed", range(2))
def test_equals_definition(spark, seed):
    rows = list(random_rows(seed))
    docs = spark.createDataFrame(rows, helpers.DOCS).repartition(6)
    assert rows_of(divergence.audit(docs)) == Counter(plain(rows))


def test_blocks_add_up(spark):
    rows = list(random_rows(9))
    docs = spark.createDataFrame(rows, helpers.DOCS).repartition(3)
    cells = divergence.kept_cells(divergence.term_counts(docs), 1)
    groups = divergence.group_totals(docs, cells)
    want = Counter(
        {(la, s, i): v for la, s, part, i, v, _ in plain(rows, 1) if part == "pair"}
    )
    for size in (3, 1000):
        got = divergence.pair_sums(cells, groups, size).collect()
        assert {(r.lang, r.source, r["item"]): r.value for r in got} == want


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame(
        [(*r, 1, "t", 2) for r in rows], helpers.DOCS + ", n int, term string, block int"
    )
    # No term has ten documents: pairs of value zero only.
    assert rows_of(divergence.audit(docs)) == Counter(plain(rows))
    assert rows_of(divergence.audit(docs, min_documents=1)) == Counter(plain(rows, 1))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_one_source_has_no_pairs(spark):
    rows = [(i, "one two two", "en", "a", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, helpers.DOCS)
    assert rows_of(divergence.audit(docs)) == Counter(plain(rows)) == Counter()


def test_many_sources_and_a_hot_one(spark):
    rng = random.Random(3)
    rows = [(i, f"term word w{'abc'[i % 3]}", "en", "hot" if i % 3 else f"s{i}", 1) for i in range(240)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, helpers.DOCS).repartition(5)
    assert rows_of(divergence.audit(docs)) == Counter(plain(rows))


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(9 * 10**15, 3 * 10**16, 10**7), (0, 0, 3), (7, 9, 0)], "n long, total long, terms long")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (9 * 10**15 + 2) // (3 * 10**16 + 2 * 10**7), 1 + 10**9 * 2 // 6, None]


def test_runs():
    column = np.array([4, 4, 4, 7, 7, 1])
    ends, values = divergence.runs_of(column)
    assert ends.tolist() == [3, 5, 6] and values.tolist() == [4, 7, 1]
    other = np.array([4, 2, 2, 2, 7, 7])
    want = sum((p - q) ** 2 // (p + q) for p, q in zip(column.tolist(), other.tolist(), strict=True))
    assert divergence.run_divergence((ends, values), divergence.runs_of(other)) == want


def test_equal_columns_stand_together(spark):
    """The order of the vocabulary leaves one run per different column of counts."""
    rows = [(i, f"t{chr(97 + i % 20)} u", "en", "ab"[i % 2], 1) for i in range(400)]
    docs = spark.createDataFrame(rows, helpers.DOCS)
    cells = divergence.kept_cells(divergence.term_counts(docs))
    signs = [(r.lang_n, r.sign) for r in cells.where("first = 1").collect()]
    assert len(signs) == 21 and len(set(signs)) == 3
