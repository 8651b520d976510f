"""Scores of texts by a word bigram model mixed by deleted interpolation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (
    bucketed,
    buckets_of,
    key_parts,
    map_batches,
    squeezed,
    squeezed_keys,
    unsqueezed,
    unsqueezed_keys,
    written,
)

#: Tokens in a chunk; a longer document is a chunk of its own.
CHUNK_TOKENS = 2_000_000
#: The end of a text, which is also what stands before its first word. No word holds it.
END = b"\n"
#: Contexts are put into buckets by the binary logarithm of their frequency.
BUCKETS = 24
#: Probabilities on the way to the mixture weights are rounded to steps of a quarter bit.
STEPS = 4
LEVELS = 160
EM_ROUNDS = 100
UNIGRAM, BIGRAM = 0, 1


def _held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def token_chunks(docs: DataFrame) -> DataFrame:
    """The documents as chunks of token numbers, one row per chunk, bucketed by ``chunk``.

    ``words`` are the XXH64 hashes of a chunk's different tokens, ``tokens`` their numbers in
    the order of the texts, ``ends`` where each text ends (its end token included).
    """
    kind = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made = 0
        number: dict[bytes, int] = {}
        tokens: list[np.ndarray] = []
        ids: list[pa.Array] = []
        held: list[bool] = []
        ends: list[int] = []

        def out() -> pa.RecordBatch:
            words = np.array([xxhash.xxh64_intdigest(w) for w in number], dtype=np.uint64)
            values = pa.chunked_array(ids).combine_chunks()
            values = pa.concat_arrays(values.chunks) if hasattr(values, "chunks") else values
            offsets = pa.array([0, len(values)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made], pa.int64()),
                    pa.ListArray.from_arrays(offsets, values),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([squeezed(words)], pa.binary()),
                    pa.array([squeezed(np.concatenate(tokens))], pa.binary()),
                ],
                ["chunk", "doc_ids", "held", "ends", "words", "tokens"],
            )

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            flags = batch.column("held").to_pylist()
            for i in range(len(texts)):
                if not number:
                    number[END] = 0
                words = (texts[i].as_py() or b"").lower().split()
                words.append(END)
                for word in set(words).difference(number):
                    number[word] = len(number)
                tokens.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                ids.append(batch.column("doc_id").slice(i, 1))
                held.append(flags[i])
                ends.append((ends[-1] if ends else 0) + len(words))
                if ends[-1] >= CHUNK_TOKENS:
                    yield out()
                    made += 1
                    number, tokens, ids, held, ends = {}, [], [], [], []
        if ends:
            yield out()

    rows = docs.select("doc_id", _held_out("doc_id").alias("held"), "text")
    chunks = map_batches(
        rows,
        cut,
        f"chunk long, doc_ids array<{kind.simpleString()}>, held array<boolean>, "
        "ends array<long>, words binary, tokens binary",
    )
    return bucketed(chunks, "token-chunks", "chunk")


class Chunk:
    """One chunk's tokens, its different words and its different pairs of words."""

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int = 0) -> None:
        self.number = table["chunk"][row].as_py()
        self.doc_ids = table["doc_ids"][row].values
        self.held = np.array(table["held"][row].as_py(), dtype=bool)
        self.ends = np.array(table["ends"][row].as_py(), dtype=np.int64)
        hashes = unsqueezed(table["words"][row].as_py(), np.uint64)
        numbers = unsqueezed(table["tokens"][row].as_py(), np.uint32)
        order = np.argsort(hashes)
        self.words = hashes[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.tokens = place[numbers]
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        # A text's end token is the same as what stands before a text.
        before[0] = place[0]
        self.before = before
        sizes = np.diff(self.ends, prepend=0)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.training = ~self.held[self.owner]
        pair = self.words[before] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.tokens]
        pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        pair ^= pair >> np.uint64(32)
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)

    def local(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and how often each occurs in training texts."""
        keys, at = (self.words, self.tokens) if kind == UNIGRAM else (self.pairs, self.pair_at)
        return keys, np.bincount(at[self.training], minlength=len(keys)).astype(np.uint32)


def counted(chunks: DataFrame) -> tuple[DataFrame, int, int]:
    """Corpus counts of every chunk's words and pairs, and N and V of the training tokens.

    A chunk sends its different keys once, cut into key ranges; a range adds up what all
    chunks sent and answers each with the totals of its keys, in their order. Words that a
    third of all texts share are one number per chunk.
    """
    parts = buckets_of(chunks.sparkSession)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row)
                rows = []
                for kind in (UNIGRAM, BIGRAM):
                    keys, counts = chunk.local(kind)
                    cuts = key_parts(keys, parts)
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        if a < b:
                            sent = squeezed_keys(keys[a:b]), squeezed(counts[a:b])
                            rows.append((p, chunk.number, kind, *sent))
                yield _rows(rows, ASK)

    def answer(table: pa.Table) -> pa.Table:
        rows, part = [], table["part"][0].as_py()
        for kind in (UNIGRAM, BIGRAM):
            at = [i for i, k in enumerate(table["kind"].to_pylist()) if k == kind]
            if not at:
                continue
            keys = [unsqueezed_keys(table["keys"][i].as_py()) for i in at]
            counts = [unsqueezed(table["counts"][i].as_py(), np.uint32) for i in at]
            different, where = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(where, np.concatenate(counts)).astype(np.uint64)
            del different
            mine = np.split(totals[where], np.cumsum([len(k) for k in keys])[:-1])
            for i, own in zip(at, mine, strict=True):
                rows.append((table["chunk"][i].as_py(), part, kind, squeezed(own), None, None))
            if kind == UNIGRAM:
                rows.append((None, part, kind, None, int(totals.sum()), int((totals > 0).sum())))
        return pa.Table.from_batches([_rows(rows, ANSWER)])

    answers = written(
        map_batches(chunks, ask, _ddl(ASK)).groupBy("part").applyInArrow(answer, _ddl(ANSWER)),
        "totals",
    )
    total, different = answers.where(F.col("chunk").isNull()).agg(F.sum("n"), F.sum("v")).first()
    return answers.where(F.col("chunk").isNotNull()), total or 0, different or 0


ASK = {"part": pa.int32(), "chunk": pa.int64(), "kind": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}
ANSWER = {"chunk": pa.int64(), "part": pa.int32(), "kind": pa.int32(), "totals": pa.binary(), "n": pa.int64(), "v": pa.int64()}
CELLS = {"bucket": pa.int32(), "level2": pa.int32(), "level1": pa.int32(), "n": pa.int64()}
_NAMES = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_NAMES[kind]}" for name, kind in kinds.items())


def _rows(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _with_totals(left: pa.Table, right: pa.Table) -> tuple[Chunk, np.ndarray, np.ndarray]:
    chunk = Chunk(left)
    rows = sorted(
        zip(right["kind"].to_pylist(), right["part"].to_pylist(), range(right.num_rows), strict=True)
    )
    found = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)]]
    for kind, _, i in rows:
        found[kind].append(unsqueezed(right["totals"][i].as_py(), np.uint64))
    return chunk, *(np.concatenate(f).astype(np.float64) for f in found)


def _bucket(frequency: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + the binary logarithm of the frequency."""
    return np.where(
        frequency > 0, np.minimum(1 + np.log2(np.maximum(frequency, 1)), BUCKETS - 1), 0
    ).astype(np.int64)


def _level(p: np.ndarray) -> np.ndarray:
    """Rounded negative logarithm; the last level is probability zero."""
    with np.errstate(divide="ignore"):
        return np.where(
            p > 0, np.minimum(np.rint(-np.log2(np.maximum(p, 1e-300)) * STEPS), LEVELS - 1), LEVELS
        ).astype(np.int64)


def mixture(chunks: DataFrame, totals: DataFrame, n: int, v: int) -> np.ndarray:
    """Weights of pair, word and uniform estimates for every bucket of context frequency.

    Every training token is held out in turn: the counts that predict it are those without
    it. Held-out tokens are counted by (bucket, rounded estimates), a table whose size does
    not depend on the corpus, and expectation-maximisation runs on these counts.
    """

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([_rows([], CELLS)])
        chunk, words, pairs = _with_totals(left, right)
        use = chunk.training
        context = words[chunk.before[use]] - 1
        p2 = (pairs[chunk.pair_at[use]] - 1) / np.maximum(context, 1)
        p1 = (words[chunk.tokens[use]] - 1) / max(n - 1, 1)
        code = (_bucket(context) * (LEVELS + 1) + _level(p2)) * (LEVELS + 1) + _level(p1)
        code, times = np.unique(code, return_counts=True)
        first, low = np.divmod(code, LEVELS + 1)
        bucket, middle = np.divmod(first, LEVELS + 1)
        arrays = [bucket, middle, low, times]
        return pa.Table.from_arrays(
            [pa.array(a, k) for a, k in zip(arrays, CELLS.values(), strict=True)], names=list(CELLS)
        )

    rows = (
        chunks.groupBy("chunk")
        .cogroup(totals.groupBy("chunk"))
        .applyInArrow(cells, _ddl(CELLS))
        .groupBy("bucket", "level2", "level1")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    weights = np.full((BUCKETS, 3), 1 / 3)
    uniform = 1 / (v + 1)
    estimates = [
        np.where(rows[c] == LEVELS, 0.0, 2.0 ** (-rows[c].to_numpy() / STEPS))
        for c in ("level2", "level1")
    ]
    p = np.stack([*estimates, np.full(len(rows), uniform)], axis=1)
    bucket, times = rows["bucket"].to_numpy(np.int64), rows["n"].to_numpy(float)
    for _ in range(EM_ROUNDS):
        share = weights[bucket] * p
        share *= (times / share.sum(axis=1))[:, None]
        gained = np.stack(
            [np.bincount(bucket, share[:, k], minlength=BUCKETS) for k in range(3)], axis=1
        )
        # One made-up token each, so that no weight becomes zero.
        weights = (gained + 1) / (gained.sum(axis=1, keepdims=True) + 3)
    return weights


def scored(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its base score and its score by the mixed model.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. The
    score is the log10 probability of the words and the end, each given the word before:
    pair, word and uniform estimates mixed by the frequency of the word before. A null or
    blank text is its end token. A null id counts as an empty one for the fold. Without
    training texts all tokens have the uniform estimate.
    """
    chunks = token_chunks(docs)
    totals, n, v = counted(chunks)
    weights = mixture(chunks, totals, n, v)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, words, pairs = _with_totals(left, right)
        context, word = words[chunk.before], words[chunk.tokens]
        p2 = pairs[chunk.pair_at] / np.maximum(context, 1)
        p1 = word / max(n, 1)
        w = weights[_bucket(context)]
        logs = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (v + 1))
        base = np.log10((word + 1) / (n + v + 1))
        texts = len(chunk.ends)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(chunk.owner, values, minlength=texts)

        return pa.table(
            {
                "doc_id": chunk.doc_ids,
                "held_out": pa.array(chunk.held),
                "n_tokens": pa.array(np.diff(chunk.ends, prepend=0)),
                "n_known": pa.array(per_text(word > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(texts, n, dtype=np.int64)),
                "base_score": pa.array(per_text(base)),
                "score": pa.array(per_text(logs)),
            }
        )

    return (
        chunks.groupBy("chunk")
        .cogroup(totals.groupBy("chunk"))
        .applyInArrow(
            score,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
