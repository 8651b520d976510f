import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import helpers
import pytest

from shelfwise.llm import mixing, quality, repeats, simhash
from shelfwise.llm.common import documents, written


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(written(stage(spark, seen[-1], sf), name.replace(" ", "-")))
        assert seen[-1].columns == columns
    raw, good, single, cut, mix = seen
    verdicts = {r.doc_id: r.kept for r in quality.assess(raw).collect()}
    assert {r.doc_id for r in good.collect()} == {d for d, k in verdicts.items() if k}
    groups = simhash.near_duplicates(simhash.numbered(good, "d", "*")).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    spans = {r.doc_id: r for r in repeats.without_repeats(single, length=corpus_pipeline.PASSAGE_BYTES).collect()}
    for r in cut.collect():
        assert r.text.encode() == bytes(spans[r.doc_id].kept) or spans[r.doc_id].n_removed
        assert r.n_chars == len(r.text) or not spans[r.doc_id].n_removed
    taken = {r.doc_id: r.taken for r in mixing.taken_words(cut).collect()}
    words = Counter()
    for r in mix.collect():
        words[r.doc_id] += len(helpers.WORD.findall(r.text))
    assert words == Counter({d: t for d, t in taken.items() if t})
    last = corpus_pipeline.STAGES[-1][1](spark, mix, sf).collect()
    assert len({(r.sequence_id, r.offset) for r in last}) == len(last)


def test_planted_passages_go(spark):
    """Passages of 51 to 60 words that stand in several documents are cut, the rest stays."""
    rng = random.Random(7)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))

    passages = [words(n) for n in range(51, 61)]
    rows = []
    for i in range(200):
        own = [words(60), words(60)]
        middle = [passages[i % 10]] if i % 4 == 0 else []
        rows.append((i, " ".join([own[0], *middle, own[1]]), "en", "a", 0))
    docs = spark.createDataFrame(rows, helpers.DOCS).repartition(5)
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        if doc_id % 4 == 0:
            assert passages[doc_id % 10] not in got[doc_id]
            assert len(got[doc_id]) >= len(text) - len(passages[doc_id % 10]) - 12
        else:
            assert got[doc_id] == text


def test_passages_of_the_benchmark_go(spark):
    """Whole passages of over 50 words that stand in two or more documents are found."""
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    passages = [t for _, t in helpers.table(sf, "benchmark", "item_id, text") if len(t.split()) > 50]
    holding = {p: [d for d, t in helpers.table(sf, "documents", "doc_id, text") if t and p in t] for p in passages}
    often = {p: ids for p, ids in holding.items() if len(ids) > 1}
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, sf).collect()}
    found = [p not in got[d] for p, ids in often.items() for d in ids]
    assert found and all(found)


def test_quality_labels_survive(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, documents(spark, sf), sf).collect()}
    long = {d for d, n in helpers.table(sf, "documents", "doc_id, len(string_split(text, ' '))") if n > 60}
    assert {d for d, q, _ in helpers.table(sf, "labels") if q == 1 and d in long} <= kept


@pytest.mark.parametrize("name", ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packing_plan"])
def test_awkward_rows(spark, name):
    good = "some words that are all of them quite unlike each other here " + " ".join(f"w{i}" for i in range(60))
    rows = [*helpers.awkward_rows(), *((50 + i, f"{good} {i}", "xx", "a", 3) for i in range(3))]
    rows = [(*r, 1, "v", True) for r in rows]
    docs = spark.createDataFrame(rows, helpers.DOCS + ", rid int, `_key` string, kept boolean")
    got = getattr(corpus_pipeline, name)(spark, docs, "")
    assert got.count()
    if name != "packing_plan":
        assert got.columns == docs.columns
        assert {(r.rid, r["_key"], r.kept) for r in got.collect()} == {(1, "v", True)}
    assert getattr(corpus_pipeline, name)(spark, docs.limit(0), "").count() == 0


def test_the_rest_imports_without_the_subpackage(tmp_path):
    top = Path(corpus_pipeline.__file__).parent
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "sys.modules['shelfwise.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert 'shortlist' in names and not any(n.startswith('op') for n in names)\n"
    )
    subprocess.run([sys.executable, "-c", code, str(top)], check=True, cwd=tmp_path)
