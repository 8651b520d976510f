import helpers
import pytest

from shelfwise.llm import mixing, queries
from shelfwise.llm.common import written


def plain_targets(sizes):
    """Target per source; ``sizes`` maps a source (None too) to its words."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    found, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            return found | {s: weight[s] * level for s in free}
        for s in above:
            found[s] = 2.0 * sizes[s]
            left -= found[s]
        free -= above
    return found


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(helpers.WORD.findall(text or ""))
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    taken = {}
    names = {(d, len(helpers.WORD.findall(t or ""))): s for d, t, s in rows}
    for r in got:
        source = names[(r.doc_id, r.size)]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_meets_the_targets(spark, name):
    sf = f"/root/testdata/{name}"
    first = queries.QUERIES["op9_mix_sources"](spark, sf).collect()
    check(helpers.table(sf, "documents", "doc_id, text, source"), first)
    if name == "sf0.001":
        assert sorted(first) == sorted(queries.QUERIES["op9_mix_sources"](spark, sf).collect())


def test_awkward_rows(spark):
    docs = spark.createDataFrame(helpers.awkward_rows(), helpers.DOCS)
    got = mixing.taken_words(docs).collect()
    check([(r[0], r[1], r[3]) for r in helpers.awkward_rows()], got)
    empty = spark.createDataFrame([], helpers.DOCS)
    assert mixing.taken_words(empty).count() == 0
    assert mixing.mixed_documents(empty).columns == empty.columns
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], helpers.DOCS)
    assert {(r.size, r.target, r.taken) for r in mixing.taken_words(blank).collect()} == {(0, 0.0, 0)}


def test_documents_of_the_mix_hold_the_words_taken(spark):
    docs = spark.createDataFrame(helpers.awkward_rows(), helpers.DOCS)
    mix = mixing.mixed_documents(docs, block=7).collect()
    total = sum(r.taken for r in mixing.taken_words(docs, block=7).collect())
    assert sum(len(helpers.WORD.findall(r.text)) for r in mix) == total
    whole = {r[1] for r in helpers.awkward_rows()}
    cut = [r for r in mix if r.text not in whole]
    assert len(cut) <= 4
    assert all(r.n_chars == len(r.text) for r in mix)


def test_every_stretch_of_the_schedule_is_in_proportion(spark):
    quotas = spark.createDataFrame([("sa", 30_000.0), ("sb", 10_000.0), ("n", 20_000.0)], "_key string, target double")
    slots = mixing.schedule(written(quotas, "quotas"), 10).orderBy("n").collect()
    assert len(slots) == 6000 and len({r.n for r in slots}) == 6000
    for key, share in (("sa", 1 / 2), ("sb", 1 / 6), ("n", 1 / 3)):
        ranks = [r._block for r in slots if r._key == key]
        assert ranks == list(range(len(ranks))) and len(ranks) == 6000 * share
        for begin in range(0, 5900, 100):
            inside = sum(r._key == key for r in slots[begin : begin + 100])
            assert abs(inside - 100 * share) <= 4


def source_order(mix):
    return [[r.source for r in part] for part in mix.rdd.glom().collect() if part]


def test_the_mix_goes_by_the_schedule(spark):
    """Each stretch of every partition has the sources by their weights."""
    rows = [(i, " ".join(f"w{i}" for _ in range(20)), "en", "abc"[i % 3], 0) for i in range(1800)]
    docs = spark.createDataFrame(rows, helpers.DOCS)
    for part in source_order(mixing.mixed_documents(docs, block=20)):
        if len(part) < 300:
            continue
        whole = {s: part.count(s) / len(part) for s in "abc"}
        for begin in range(0, len(part) - 100, 100):
            stretch = part[begin : begin + 100]
            for s in "abc":
                assert abs(stretch.count(s) / 100 - whole[s]) < 0.2


def test_the_schedule_decides_the_order(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"a{i} b c d e", "en", "ab"[i % 2], 0) for i in range(300)], helpers.DOCS
    )
    forward = [r.doc_id for r in mixing.mixed_documents(docs, block=5).coalesce(1).collect()]
    slots = {r.doc_id: r.first_slot for r in mixing.taken_words(docs, block=5).collect()}
    plain = mixing.schedule

    def reversed_schedule(quotas, block):
        return plain(quotas, block).selectExpr("-n as n", "_key", "_block")

    monkeypatch.setattr(mixing, "schedule", reversed_schedule)
    backward = [r.doc_id for r in mixing.mixed_documents(docs, block=5).coalesce(1).collect()]
    assert sorted(forward) == sorted(backward) and forward != backward
    turned = {r.doc_id: r.first_slot for r in mixing.taken_words(docs, block=5).collect()}
    assert slots != turned and min(slots.values()) >= 0


def test_many_sources_and_clashing_columns(spark):
    rows = [(i, "one two three " * (1 + i % 3), "en", f"s{i % 150}", 1, 2, "x") for i in range(600)]
    docs = spark.createDataFrame(rows, helpers.DOCS + ", rid int, _key string")
    check([(r[0], r[1], r[3]) for r in rows], mixing.taken_words(docs, block=4).collect())
    mix = mixing.mixed_documents(docs, block=4)
    assert mix.columns == docs.columns and {(r.rid, r["_key"]) for r in mix.collect()} == {(2, "x")}
