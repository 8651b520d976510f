import random
import zlib
from collections import Counter

import helpers
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import packing, queries
from shelfwise.llm.common import written

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def plain_pieces(rows, capacity=2048):
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            yield doc_id, piece, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())


def check(rows, got, capacity=2048):
    have = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    assert have == Counter(plain_pieces(rows, capacity))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def fewest(lengths, capacity):
    return -(-sum(lengths) // capacity)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_round_trip(spark, name):
    sf = f"/root/testdata/{name}"
    got = queries.QUERIES["op3_pack"](spark, sf).collect()
    n = check(helpers.table(sf, "documents", "doc_id, text"), got)
    assert n <= 1 + 1.005 * fewest([r.length for r in got], 2048)


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    rows.append((20, "see <|endoftext|> and <|ENDOFTEXT|> don't ÉCOLE İstanbul á ́b  x y ﬁ", "en", "a", 1))
    rows.append((21, "\u0085 ٣٤ ½ Ⅷ 'S 'll we'RE 😀😀 ‍ x\x1cy", "en", "a", 1))
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], helpers.DOCS + ", length int, offset string")
    check([r[:2] for r in rows], packing.packed_documents(docs, PATH).collect())
    assert packing.packed_documents(spark.createDataFrame([], helpers.DOCS), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_strategy_places_every_piece(seed):
    rng = random.Random(seed)
    most = rng.choice([50, 400, 2048])
    lengths = [min(most, 1 + int(rng.expovariate(1 / rng.choice([8, most / 4])))) for _ in range(20_000)]
    histogram = Counter(lengths)
    made = packing.strategy(histogram, most)
    placed = Counter()
    for pattern, count in made:
        assert sum(pattern) <= most and count > 0
        for length in pattern:
            placed[length] += count
    assert placed == histogram
    assert sum(c for _, c in made) <= 1 + 1.01 * fewest(lengths, most)


def test_strategy_of_little_and_nothing():
    assert packing.strategy({}, 10) == []
    assert packing.strategy({10: 3}, 10) == [((10,), 3)]
    assert sum(c for _, c in packing.strategy({6: 4}, 10)) == 4


def test_fit_weighs_patterns_to_the_histogram():
    lengths = np.array([2, 3, 5])
    assert packing.patterns(lengths, 10) == [(5, 5), (5, 3, 2)]
    members = np.array([[0, 1, 2]])
    x = packing.fitted(np.array([7.0, 7.0, 7.0]), members, np.ones((1, 3)))
    assert np.allclose(x, 7)


def test_one_length_that_most_pieces_share(spark):
    rows = [(i, "a " * 99) for i in range(900)] + [(i, "b " * (i % 50)) for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = packing.packed(written(packing.token_pieces(docs, PATH, 256), "p"), 256).collect()
    check(rows, got, 256)


def test_pieces_of_new_words_are_encoded_once(monkeypatch):
    real = Tokenizer.from_file(PATH)
    given = []

    class Counted:
        get_vocab = staticmethod(real.get_vocab)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return real.encode_batch_fast(texts, **options)

    class Files:
        from_file = staticmethod(lambda path: Counted())

    words = [f"stra\u00e9en{chr(97 + i)}zug" for i in range(26)]
    text = " ".join(f"{a}{w.upper()}{b}" for w in words for a in ("", "(", "'") for b in ("", ",", "'s", "7"))
    whole = text + " \u00e9\u0301 <|endoftext|>, \u6f22\u5b57, x</w>'ll"
    want = [np.array(real.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in (text, whole)]
    monkeypatch.setattr("tokenizers.Tokenizer", Files)
    encode = packing._encoder.__wrapped__(PATH)
    assert encode(text.encode()) == want[0]
    assert sum(map(len, given)) < len(text) / 6
    assert encode(whole.encode()) == want[1]
