import base64
import random
from collections import Counter

import helpers
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import queries, token_counts
from shelfwise.llm.common import written

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SIGNS = " \t\n\r\x0b\x0c\x1c\x85\xa0 　​abzAZ019'sdtlrevm!?.,<|>é漢字あ한я\U0001f600́٠½"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, rows):
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        yield doc_id, len((text or "").encode()), n, n > 512


def compare(library, rows, got):
    assert Counter(tuple(r) for r in got) == Counter(plain(library, rows))


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_token_counts"](spark, sf).collect()
    compare(library, helpers.table(sf, "documents", "doc_id, text"), got)


def test_awkward_rows(spark, library):
    rows = [(*r, 7, "x") for r in helpers.awkward_rows()]
    rows.append((30, "a <|endoftext|> b<|endoftext|>", "en", "a", 1, 7, "y"))
    docs = spark.createDataFrame(rows, helpers.DOCS + ", n_tokens int, rid string")
    compare(library, [r[:2] for r in rows], token_counts.token_counts(docs, PATH, chunk=2000, overlap=100).collect())
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


def nasty_texts(rng):
    yield "a" * 9000 + "b"
    yield " " * 5000 + "x" + "\n" * 5000
    yield "ab" * 6000
    yield base64.b64encode(rng.randbytes(12_000)).decode()
    yield "".join(rng.choices("漢字一齋国人", k=7000))
    yield "<|endoftext|>" * 900
    yield "".join(rng.choices(["<|endoftext|>", " ", "x", "<|end", "oftext|>"], k=3000))
    yield "'s" * 5000
    yield "don't we'll they're " * 600
    yield "".join(rng.choices(SIGNS, k=9000))
    yield "".join(w + rng.choice(["", " ", "  "]) for w in rng.choices(["!", "a", "́", "'", "½", "9"], k=9000))
    yield "the quick brown fox jumps over it. " * 400


def test_long_texts_are_spliced_exactly(spark, library):
    rows = list(enumerate(nasty_texts(random.Random(5))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk, overlap in ((200, 64), (777, 100)):
        got = token_counts.token_counts(docs, PATH, chunk=chunk, overlap=overlap).collect()
        compare(library, rows, got)


def test_overlaps_widen_only_where_needed(spark):
    """Words splice at once; a row without any certain place and without a shared token does not."""
    texts = ["some words of a text " * 200, "́'½" * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first = token_counts.short_counts(docs, PATH, 200)
    todo = first.selectExpr("rid", "explode(sequence(0L, n_chars div 200 - 1)) as first").selectExpr("*", "first + 1 as after")
    spans = token_counts.encoded_spans(first, todo, PATH, 200, 64)
    seams = written(token_counts.splices(spans), "splices")
    ids = {r.doc_id: r.rid for r in first.collect()}
    assert seams.where(f"rid = {ids[0]} and at is null").count() == 0
    assert seams.where(f"rid = {ids[1]} and at is not null").count() == 0


def test_boundaries_are_those_of_the_library(library):
    encoder = token_counts.Encoder(PATH)
    rng = random.Random(1)
    for i in range(4000):
        text = "".join(rng.choices(SIGNS, k=rng.randint(0, 40)))
        if i % 5 == 0:
            text = text[:10] + "<|endoftext|>" + text[10:]
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.counts([text]) == [len(ids)]
        bounds = encoder.boundaries(text).tolist()
        assert len(bounds) == len(ids) and (not bounds or bounds[-1] == len(text.encode()))
        cut = rng.randint(0, 5)
        skipped = len(text[:cut].encode())
        assert {p + skipped for p in encoder.certain(text[cut:], True)} <= set(bounds)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Encoder(str(public_tokenizers.path("word_bpe_49k.json")))
