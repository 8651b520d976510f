from collections import Counter

import helpers
import numpy as np

from shelfwise.llm import quality, queries


def plain_counts(text):
    words = helpers.WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if helpers.WORD.search(line):
            dup += line in lines
            lines.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), symbols, dup, len(inside), failed


def test_query_equals_brute_force(spark, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op8_quality_rules"](spark, sf).collect()}
    rows = helpers.table(sf, "documents", "doc_id, text")
    assert len(got) == len(rows)
    for doc_id, text in rows:
        r = got[doc_id]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert (*counts, r.base_failed) == plain_counts(text)
        assert not (r.base_failed and r.kept)


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op8_quality_rules"](spark, sf).collect()}
    good = [got[i] for i, q, _ in helpers.table(sf, "labels") if q == 1]
    junk = [got[i] for i, q, _ in helpers.table(sf, "labels") if q == 0]
    assert all(r.kept or r.n_words < 50 for r in good)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_reference_counts_all_documents(spark):
    docs = spark.createDataFrame(helpers.awkward_rows(), helpers.DOCS)
    refs = {r["lang"]: r for r in quality.reference(docs, 3)}
    words = Counter()
    for _, text, lang, _, _ in helpers.awkward_rows():
        if lang == "en":
            words.update(helpers.WORD.findall((text or "").lower()))
    assert refs["en"]["total"] == sum(words.values())
    top = sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[:3]
    assert refs["en"]["words"] == {w.encode(): n for w, n in top}
    assert set(refs) == {"en", "de", "fr", "es"}


def test_awkward_rows(spark):
    rows = [(*r, 1, "x") for r in helpers.awkward_rows()]
    docs = spark.createDataFrame(rows, helpers.DOCS + ", n_words int, kept string")
    got = quality.assess(docs).collect()
    assert len(got) == len(rows)
    want = sorted(plain_counts(r[1])[:5] for r in rows)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[c] for c in columns) for r in got) == want
    empty = spark.createDataFrame([], helpers.DOCS)
    assert quality.assess(empty).count() == 0
    assert quality.good_documents(docs).columns == docs.columns


def test_without_reference_only_the_base_rule_counts(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(80)), None)], "doc_id long, text string, lang string")
    row = quality.assess(docs).first()
    assert row.kept and row.char_distance is None and row.word_distance is None


def test_distance_is_zero_for_equal_shares_and_one_for_disjoint():
    p = np.array([2.0, 2, 0, 0])
    q = np.array([[1.0, 1, 0, 0], [0, 0, 5, 5]])
    assert np.allclose(quality.js_distance(p, q), [0, 1])
