import math
import random
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest

from shelfwise.llm import language, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op5_language_id"](spark, sf).collect()}
    rows = helpers.table(sf, "documents", "doc_id, text, lang")
    assert len(got) == len(rows)
    for doc_id, _, _ in rows:
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= got[doc_id].score <= 1
    held = [(got[i].lang_pred, lang) for i, _, lang in rows if got[i].held_out]
    assert sum(a == b for a, b in held) >= 0.99 * len(held)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcde "), 400)) for _ in range(5)]
    found = [language.symbols(t) for t in texts]
    model = language.learn("x", found)
    all_symbols = model.levels[0].keys
    for text in ("abc", "ab ", "ddd", "zab", "zzz"):
        context = language.symbols("q" + text + "q")[2:5]
        key = np.uint64(0)
        for s in context:
            key = (key << np.uint64(16)) | s
        keys = (key << np.uint64(16)) | all_symbols
        known = np.exp(language.log_probs(model, keys)).sum()
        unseen = np.exp(language.log_probs(model, np.array([(key << np.uint64(16)) | np.uint64(9999)])))[0]
        assert known + unseen == pytest.approx(1, abs=1e-9)


def test_symbols_keep_letters_only():
    assert "".join(map(chr, language.symbols("Ab3,, ÇÉ--\n"))) == " ab çé "
    assert len(language.symbols(" 12 .,!")) == 0 and len(language.symbols("")) == 0


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], helpers.DOCS + ", score double")
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.lang_pred == "und" for r in got) == 4
    assert {r.lang_pred for r in got} <= {"und", "en", "de", "fr", "es"}
    assert language.identify(spark.createDataFrame([], helpers.DOCS)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()] == [("und", 0.0)]


def test_chunks_do_not_change_the_entropy(monkeypatch):
    texts = [language.symbols("some words of one sort " * 30), language.symbols("x")]
    models = [language.learn("a", texts), language.learn("b", [language.symbols("other things")])]
    whole = language.cross_entropies(models, texts)
    monkeypatch.setattr(language, "CHUNK", 50)
    assert np.allclose(whole, language.cross_entropies(models, texts))


def test_text_of_no_known_language_is_not_accepted(spark):
    rows = [(i, f"the fish and the bird number {'abcdefgh'[i % 8]} swim and fly over the sea " * 8, "en") for i in range(90)]
    rows.append((1000, "ξψω φθγ χψξ ωωξ ψφθ " * 20, "en2"[:0] or None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[0].accepted and not got[1000].accepted and got[1000].lang_pred == "en"


def plain_entropy(trained, text, order=4):
    """Interpolated Kneser-Ney by its definition, on strings of symbols."""
    counts = {order: Counter(t[i : i + order] for t in trained for i in range(len(t) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(run[1:] for run in counts[n + 1])
    discount = {}
    for n, found in counts.items():
        once, twice = (sum(c == k for c in found.values()) for k in (1, 2))
        discount[n] = once / (once + 2 * twice) if once else 0.5

    def p(run):
        n = len(run)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        after = [c for r, c in counts[n].items() if r[:-1] == run[:-1]]
        if not after:
            return p(run[1:])
        own = max(counts[n][run] - discount[n], 0) if run in counts[n] else 0.0
        return own / sum(after) + discount[n] * len(after) / sum(after) * p(run[1:])

    padded = " " * (order - 2) + text
    runs = [padded[i : i + order] for i in range(len(padded) - order + 1)]
    return -sum(math.log(p(r)) for r in runs) / len(runs)


@pytest.mark.parametrize("seed", range(3))
def test_entropy_equals_the_definition(seed):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(30)) for _ in range(4)]
    found = [language.symbols(t) for t in texts]
    model = language.learn("x", found)
    trained = ["".join(map(chr, f)) for f in found]
    others = ["abc dab", "zzz a", texts[0], "é"]
    got = language.cross_entropies([model], [language.symbols(t) for t in others])[:, 0]
    want = [plain_entropy(trained, "".join(map(chr, language.symbols(t)))) for t in others]
    assert np.allclose(got, want)


def test_every_letter_is_a_letter():
    table = language._symbol_of()
    letters = [p for p in range(0x110000) if chr(p).isalpha()]
    assert not {0, language.SPACE} & set(table[letters].tolist())
    assert len(language.symbols("\U00020022\U00020022 \U00010021")) == 6


def test_languages_that_get_a_model_are_bounded(spark, monkeypatch):
    """A label of its own in every document brings no table as long as the corpus to the driver."""
    monkeypatch.setattr(language, "LANGUAGES", 3)
    rows = [(i, f"words of number {'abcdefgh'[i % 8]} here", "en") for i in range(40)]
    rows += [(100 + i, "mots de la langue", "fr") for i in range(20)] + [(200 + i, f"y{i}", f"junk{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.train(docs)
    assert len(models) == 3 and {"en", "fr"} <= {m.lang for m in models}
    assert language.identify(docs).count() == len(rows)
