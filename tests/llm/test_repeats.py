import hashlib
import random
from collections import Counter

import helpers
import numpy as np
import pytest

from shelfwise.llm import queries, repeats


def plain(texts, length):
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        yield len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def check(rows, got, length):
    want = plain([(t or "").encode() for _, t in rows], length)
    want = sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=str)
    have = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(have, key=str) == want


def test_query_equals_brute_force(spark, sf):
    rows = helpers.table(sf, "documents", "doc_id, text")
    check(rows, queries.QUERIES["op2_remove_repeats"](spark, sf).collect(), 400)


def passages(seed, length):
    """Random texts with planted repeats just below, at and above the length."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefghé "
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [word(n) for n in (length - 1, length, length + 1, length + 3, 2 * length, 5 * length)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 5)):
            piece = rng.choice(shared)
            cut = rng.randint(0, len(piece) // 2)
            parts.append(rng.choice([piece, piece[cut:], piece[: len(piece) - cut], word(length * 2)]))
            if rng.random() < 0.3:
                parts.append(parts[-1])
        rows.append((i if i % 17 else None, "".join(parts)))
    rows += rows[:5] + [(900, "z" * (4 * length)), (901, "xy" * (2 * length)), (902, "x" * length)]
    return rows


@pytest.mark.parametrize(("seed", "length", "many"), [(0, 24, 20_000), (1, 24, 20_000), (2, 40, 1), (3, 9, 2), (4, 1, 20_000), (5, 5, 20_000)])
def test_planted_passages(spark, seed, length, many):
    rows = passages(seed, length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, repeats.without_repeats(docs, "doc_id", length, many).collect(), length)


def test_awkward_rows(spark):
    rows = helpers.awkward_rows()
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], helpers.DOCS + ", chunk int, kept string")
    check([r[:2] for r in rows], repeats.without_repeats(docs).collect(), 400)
    assert repeats.without_repeats(spark.createDataFrame([], helpers.DOCS)).count() == 0
    left = repeats.unrepeated_documents(docs)
    assert left.columns == docs.columns
    texts = {(r.doc_id, r.lang): r for r in left.collect()}
    assert texts[1, "en"].text == "" and texts[3, "en"].text is None
    assert texts[5, "de"].text == " \t\n " and texts[5, "de"].n_chars == 4


def test_cuts_inside_characters_leave_text(spark):
    shared = "é" * 250
    docs = spark.createDataFrame([(1, "x" + shared + "yé"), (2, "è" + shared + "z")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in repeats.unrepeated_documents(docs).collect()}
    assert got == {1: "xyé", 2: "z"} or got == {1: "xyé", 2: "èz"}


def test_slices_do_not_change_the_strings(monkeypatch):
    import pyarrow as pa
    import zstandard

    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd") for _ in range(n)).encode() for n in (0, 900, 10, 64, 0, 500)]
    table = pa.table(
        {
            "chunk": [0],
            "keys": [list(range(6))],
            "ends": [np.cumsum([len(t) for t in texts]).tolist()],
            "body": [zstandard.ZstdCompressor().compress(b"".join(texts))],
        }
    )
    for size in (1 << 20, 100, 64, 7):
        monkeypatch.setattr(repeats, "SLICE", size)
        chunk = repeats.Chunk(table, 0, 64)
        starts = [i for a, b in zip(chunk.lo, chunk.hi, strict=True) for i in range(a, b + 1)]
        want, at = [], 0
        for t in texts:
            want += range(at, at + max(len(t) - 63, 0))
            at += len(t)
        assert starts == want
        assert ((chunk.lo <= chunk.at) & (chunk.at + 48 <= chunk.hi + 64)).all()


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8])
def test_merge_of_front_coded_runs(count):
    rng = random.Random(count)
    runs = [
        sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40)))
        for _ in range(count)
    ]
    streams = []
    for run in runs:
        lcps, rest = repeats.front_coded(run)
        streams.append(repeats.decoded(lcps, [len(s) for s in run], b"".join(rest)))
    got = list(repeats.merged(streams))
    assert [s for _, _, s in got] == sorted(s for run in runs for s in run)
    for (_, _, a), (lcp, _, b) in zip(got, got[1:], strict=False):
        assert lcp == repeats.common_prefix(a, b)
    for i, run in enumerate(runs):
        assert [s for _, r, s in got if r == i] == run
