"""Removal of repeated passages by a distributed merge sort of suffixes.

A passage that occurs twice is a common prefix of two suffixes. Sorting all suffixes of a
corpus would move each byte hundreds of times, so suffixes are sampled first, in a way
that loses nothing: of all strings of ``length`` bytes that share their rarest-looking inner
window (a minimizer), one suffix goes on, the one at that window, and only if the window
occurs again somewhere. These suffixes are sorted in runs, exchanged front-coded, and merged
by loser trees that know the common prefixes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import (
    bucketed,
    buckets_of,
    key_parts,
    map_batches,
    squeezed,
    squeezed_keys,
    stashed,
    unsqueezed,
    unsqueezed_keys,
    written,
)

LENGTH = 400
CHUNK_BYTES = 4_000_000
#: Window starts looked at together.
SLICE = 1 << 18
#: A window whose surroundings differ in more ways than this is not resolved in one task.
MANY = 20_000

_BASE = 0x9E3779B97F4A7C15
_KINDS = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
ASK = {"part": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "times": pa.binary(), "kinds": pa.binary()}
ANSWER = {"chunk": pa.int64(), "part": pa.int32(), "status": pa.binary(), "many": pa.int32()}
RUN = {
    "part": pa.int32(), "chunk": pa.int64(), "numbers": pa.binary(), "times": pa.binary(),
    "lcps": pa.binary(), "sizes": pa.binary(), "left_sizes": pa.binary(), "rest": pa.binary(), "lefts": pa.binary(),
}
FOUND = {"chunk": pa.int64(), "numbers": pa.binary(), "begins": pa.binary(), "ends": pa.binary()}
WINDOWS = {"d1": pa.int64(), "d2": pa.int64(), "chunk": pa.int64(), "number": pa.int64(), "nth": pa.int64(), "times": pa.int64()}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_KINDS[kind]}" for name, kind in kinds.items())


def _rows(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def text_chunks(docs: DataFrame, key: str) -> DataFrame:
    """Texts as UTF-8, many to a chunk, with their ``key``: a table bucketed by ``chunk``."""
    schema = (
        T.StructType()
        .add("chunk", "long")
        .add("keys", T.ArrayType(docs.schema[key].dataType))
        .add("ends", T.ArrayType(T.LongType()))
        .add("body", "binary")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        bodies: list[bytes] = []
        keys: list[pa.Array] = []
        size = 0

        def out() -> pa.RecordBatch:
            values = pa.concat_arrays(keys)
            ends = np.cumsum([len(b) for b in bodies]).tolist()
            packed = zstandard.ZstdCompressor(level=1).compress(b"".join(bodies))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([packed], pa.binary()),
                ],
                ["chunk", "keys", "ends", "body"],
            )

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for i in range(len(texts)):
                bodies.append(texts[i].as_py() or b"")
                keys.append(batch.column(key).slice(i, 1))
                size += len(bodies[-1])
                if size >= CHUNK_BYTES:
                    yield out()
                    made, bodies, keys, size = made + 1, [], [], 0
        if bodies:
            yield out()

    chunks = map_batches(docs.select(key, "text"), cut, schema)
    return bucketed(chunks, "text-chunks", "chunk")


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tables[0], tables[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Chunk:
    """A chunk's text, and its strings of ``length`` bytes in runs that share a minimizer.

    Run r holds the strings that start at ``lo[r]`` to ``hi[r]``; the minimizer, a window of
    three quarters of the length, is at ``at[r]``. Runs with equal text from ``lo`` to the
    end of the last string are one class: ``number[r]``. ``keys`` are the classes' window
    hashes in ascending order, ``first`` one run of each class and ``times`` its runs. Equal
    strings have equal minimizers at equal places, so strings of different keys differ.
    """

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int, length: int) -> None:
        self.length, self.inner = length, max(1, length * 3 // 4)
        self.chunk = table["chunk"][row].as_py()
        self.doc_keys = table["keys"][row].values
        self.ends = np.array(table["ends"][row].as_py(), dtype=np.int64)
        self.body = zstandard.ZstdDecompressor().decompress(table["body"][row].as_py())
        found = [self._slice(s) for s in range(0, max(len(self.body) - length + 1, 0), SLICE)]
        found = found or [(np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2]
        self.lo, self.hi, self.at, key, text = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        self.keys, self.first = key[new], order[new]
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.times = np.bincount(self.number, minlength=len(self.first))

    def _slice(self, begin: int) -> tuple[np.ndarray, ...]:
        length, inner = self.length, self.inner
        end = min(begin + SLICE, len(self.body) - length + 1)
        raw = np.frombuffer(self.body, np.uint8, end - begin + length - 1, begin)
        power, inverse = _powers(SLICE + length + 1)
        n = len(raw)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        windows = n - inner + 1
        hashes = _mixed((sums[inner:] - sums[:-inner]) * inverse[:windows])
        bits = np.uint64((2 * SLICE + length - 1).bit_length())
        ranked = (hashes >> bits << bits) | np.arange(windows, dtype=np.uint64)
        low, have, wanted = ranked, 1, length - inner + 1
        while 2 * have <= wanted:
            low, have = np.minimum(low[: len(low) - have], low[have:]), 2 * have
        if more := wanted - have:
            low = np.minimum(low[: len(low) - more], low[more:])
        at = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        # Strings must not run over the end of a text.
        starts = np.concatenate(([0], self.ends[:-1]))
        inside = (self.ends > begin) & (starts < end)
        edge = np.zeros(end - begin + 1, dtype=np.int32)
        over = np.clip(np.maximum(starts, self.ends - length + 1)[inside] - begin, 0, end - begin)
        np.add.at(edge, over, 1)
        np.add.at(edge, np.clip(self.ends[inside] - begin, 0, end - begin), -1)
        open_ = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        if not len(open_):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
        where = at[open_]
        cut = np.flatnonzero((np.diff(where) != 0) | (np.diff(open_) != 1)) + 1
        lo = open_[np.concatenate(([0], cut))]
        hi = open_[np.concatenate((cut - 1, [len(open_) - 1]))]
        own = where[np.concatenate(([0], cut))]
        shape = ((own - lo).astype(np.uint64) << np.uint64(32)) + (hi - lo).astype(np.uint64)
        text = _mixed((sums[hi + length] - sums[lo]) * inverse[lo] + shape * np.uint64(_BASE))
        # Minimizers are small hashes; mixed once more, they spread over the key ranges.
        key = _mixed(hashes[own] * np.uint64(_BASE))
        return lo + begin, hi + begin, own + begin, key, text

    def offers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different keys, where each begins among the classes, its runs and its classes."""
        keys, begins, kinds = np.unique(self.keys, return_index=True, return_counts=True)
        times = np.add.reduceat(self.times, begins) if len(keys) else self.times
        return keys, begins, times.astype(np.uint32), kinds.astype(np.uint32)

    def strings(self, number: int) -> tuple[bytes, bytes]:
        """A class's text before its minimizer, and from there to the end of its strings."""
        run = self.first[number]
        lo, at, end = self.lo[run], self.at[run], self.hi[run] + self.length
        return self.body[lo:at], self.body[at:end]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in the first ``known`` bytes."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Common prefix of each string with the one before, and what follows it."""
    lcps = [0] * len(strings)
    for i in range(1, len(strings)):
        lcps[i] = common_prefix(strings[i - 1], strings[i])
    return lcps, [s[n:] for s, n in zip(strings, lcps, strict=True)]


def decoded(lcps: list[int], sizes: list[int], rest: bytes) -> Iterator[tuple[int, bytes]]:
    """The strings of a front-coded run, one at a time, with their common prefixes."""
    before, at = b"", 0
    for lcp, size in zip(lcps, sizes, strict=True):
        before = before[:lcp] + rest[at : at + size - lcp]
        at += size - lcp
        yield lcp, before


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """Merge sorted runs: (common prefix with the string before, run, string).

    A loser tree. Every waiting string carries its common prefix with the last string that
    passed its node; the one with the longer prefix is smaller without a look at it, and
    equal prefixes are compared from there on, so known bytes are never compared again.
    """
    count = len(runs)
    leaves = 1 << max(count - 1, 0).bit_length()
    text: list[bytes | None] = [None] * leaves
    known = [0] * leaves
    losers = [-1] * leaves

    def duel(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes that with the winner."""
        if text[b] is None:
            return a, b
        if text[a] is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = text[a], text[b]
        shared = common_prefix(x, y, known[a])
        if shared == len(x) or (shared < len(y) and x[shared] < y[shared]):
            known[b] = shared
            return a, b
        known[a] = shared
        return b, a

    for i, run in enumerate(runs):
        found = next(run, None)
        text[i] = None if found is None else found[1]
    standing = list(range(leaves))
    level = leaves
    while level > 1:
        level //= 2
        after = []
        for node in range(level):
            winner, losers[level + node] = duel(standing[2 * node], standing[2 * node + 1])
            after.append(winner)
        standing = after
    winner = standing[0]
    while text[winner] is not None:
        yield known[winner], winner, text[winner]
        found = next(runs[winner], None)
        if found is None:
            text[winner] = None
        else:
            known[winner], text[winner] = found
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = duel(winner, losers[node])
            node //= 2


def candidates(chunks: DataFrame, length: int, many: int = MANY) -> DataFrame:
    """For every chunk which of its window hashes occur again: 0 no, 1 yes, 2 in many ways."""
    parts = buckets_of(chunks.sparkSession)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row, length)
                keys, _, times, kinds = chunk.offers()
                cuts = key_parts(keys, parts)
                yield _rows(
                    [
                        (p, chunk.chunk, squeezed_keys(keys[a:b]), squeezed(times[a:b]), squeezed(kinds[a:b]))
                        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                        if a < b
                    ],
                    ASK,
                )

    def answer(table: pa.Table) -> pa.Table:
        n = table.num_rows
        keys = [unsqueezed_keys(table["keys"][i].as_py()) for i in range(n)]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        times, kinds = (
            np.bincount(
                where,
                np.concatenate([unsqueezed(table[c][i].as_py(), np.uint32) for i in range(n)]),
            )
            for c in ("times", "kinds")
        )
        status = np.where(kinds > many, 2, times > 1).astype(np.uint8)[where]
        mine = np.split(status, np.cumsum([len(k) for k in keys])[:-1])
        chunk, part = table["chunk"].to_pylist(), table["part"][0].as_py()
        return pa.Table.from_batches(
            [
                _rows(
                    [
                        (c, part, squeezed(own), int((own == 2).any()))
                        for c, own in zip(chunk, mine, strict=True)
                    ],
                    ANSWER,
                )
            ]
        )

    asked = map_batches(chunks, ask, _ddl(ASK))
    return written(asked.groupBy("part").applyInArrow(answer, _ddl(ANSWER)), "candidates")


def _class_status(chunk: Chunk, right: pa.Table) -> np.ndarray:
    """The answer for every class of a chunk."""
    order = np.argsort(right["part"].to_numpy())
    found = [unsqueezed(right["status"][int(i)].as_py(), np.uint8) for i in order]
    keys, begins, _, kinds = chunk.offers()
    return np.repeat(np.concatenate(found), kinds) if len(keys) else np.empty(0, np.uint8)


def sorted_runs(chunks: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """Front-coded sorted runs of the suffixes at repeated windows, by range of their hash."""
    parts = buckets_of(chunks.sparkSession)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.Table.from_batches([_rows([], RUN)])
        chunk = Chunk(left, 0, length)
        status = _class_status(chunk, right)
        cuts = key_parts(chunk.keys, parts)
        compress = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            numbers = (np.flatnonzero(status[a:b] == 1) + a).tolist()
            if not numbers:
                continue
            run = sorted(((*chunk.strings(n)[::-1], n) for n in numbers), key=itemgetter(0))
            suffixes, lefts, numbers = map(list, zip(*run, strict=True))
            lcps, rest = front_coded(suffixes)
            rows.append(
                (
                    part,
                    chunk.chunk,
                    squeezed(np.array(numbers, dtype=np.uint32)),
                    squeezed(np.minimum(chunk.times[numbers], 2).astype(np.uint8)),
                    squeezed(np.array(lcps, dtype=np.uint32)),
                    squeezed(np.array([len(s) for s in suffixes], dtype=np.uint32)),
                    squeezed(np.array([len(s) for s in lefts], dtype=np.uint32)),
                    compress(b"".join(rest)),
                    compress(b"".join(lefts)),
                )
            )
        return pa.Table.from_batches([_rows(rows, RUN)])

    return (
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, _ddl(RUN))
    )


def resolve(
    group: list[tuple[bytes, bytes, int, int]], length: int
) -> Iterator[tuple[int, int, int]]:
    """Which strings of a group's classes occur again: (member, first, last) by place.

    A member is (text before the window, suffix at the window, runs of it, longest common
    prefix with a neighbour in the sorted order). String j of a class takes the last bytes
    before the window and the first ``length`` minus that many of the suffix, so it can only
    occur elsewhere if the common prefix reaches that far.
    """
    same: dict[tuple[bytes, bytes], list[int]] = {}
    for i, (left, suffix, _, _) in enumerate(group):
        same.setdefault((left, suffix), []).append(i)
    seen: Counter = Counter()
    digests = {}
    digest = xxhash.xxh3_128_digest
    for (left, suffix), members in same.items():
        strings = len(left) + len(suffix) - length + 1
        if len(members) > 1 or group[members[0]][2] > 1:
            weight = 2
            reach = strings if len(same) > 1 else 0
        else:
            weight = 1
            reach = min(strings, len(left) - length + group[members[0]][3] + 1)
        text = left + suffix
        digests[left, suffix] = [digest(text[j : j + length]) for j in range(max(reach, 0))]
        for d in set(digests[left, suffix]):
            seen[d] += weight
        # Within one class strings may repeat too, as in a text that goes round in circles.
        if len(set(digests[left, suffix])) < len(digests[left, suffix]):
            seen.update(digests[left, suffix])
    for (left, suffix), members in same.items():
        strings = len(left) + len(suffix) - length + 1
        if len(members) > 1 or group[members[0]][2] > 1:
            spans = [(0, strings - 1)]
        else:
            again = [seen[d] > 1 for d in digests[left, suffix]]
            edges = np.flatnonzero(np.diff(np.array([False, *again, False]).astype(np.int8)))
            spans = [(int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]
        for i in members:
            for a, b in spans:
                yield i, a, b


def repeated(runs: DataFrame, length: int) -> DataFrame:
    """The strings of every class that occur again, from merging the runs of a hash range."""
    inner = max(1, length * 3 // 4)

    def merge(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        n = table.num_rows
        streams, numbers, times, lefts = [], [], [], []
        for i in range(n):
            lcps, sizes, left_sizes, number = (
                unsqueezed(table[c][i].as_py(), np.uint32).tolist()
                for c in ("lcps", "sizes", "left_sizes", "numbers")
            )
            streams.append(decoded(lcps, sizes, expand(table["rest"][i].as_py())))
            numbers.append(iter(number))
            times.append(iter(unsqueezed(table["times"][i].as_py(), np.uint8).tolist()))
            whole, at, own = expand(table["lefts"][i].as_py()), 0, []
            for size in left_sizes:
                own.append(whole[at : at + size])
                at += size
            lefts.append(iter(own))
        results: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        group: list[list] = []
        owners: list[tuple[int, int]] = []

        def close() -> None:
            if len(group) > 1 or (group and group[0][2] > 1):
                for member, a, b in resolve(group, length):
                    run, number = owners[member]
                    results[run].append((number, a, b))

        for lcp, run, suffix in merged(streams):
            if lcp < inner:
                close()
                group, owners, lcp = [], [], 0
            elif group:
                group[-1][3] = max(group[-1][3], lcp)
            group.append([next(lefts[run]), suffix, next(times[run]), lcp])
            owners.append((run, next(numbers[run])))
        close()
        chunk = table["chunk"].to_pylist()
        rows = []
        for run, own in enumerate(results):
            if own:
                parts = [squeezed(np.array(x, dtype=np.uint32)) for x in zip(*own, strict=True)]
                rows.append((chunk[run], *parts))
        return pa.Table.from_batches([_rows(rows, FOUND)])

    return runs.groupBy("part").applyInArrow(merge, _ddl(FOUND))


def repeated_by_digest(chunks: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """The same for windows that occur in many ways: their strings are counted by digest.

    Every string is a key of its own, so no task sees a whole group.
    """

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            chunk = Chunk(left, 0, length)
            for number in np.flatnonzero(_class_status(chunk, right) == 2).tolist():
                text = b"".join(chunk.strings(number))
                for j in range(len(text) - length + 1):
                    d = xxhash.xxh3_128_digest(text[j : j + length])
                    high, low = np.frombuffer(d, dtype=np.int64).tolist()
                    rows.append((high, low, chunk.chunk, number, j, int(chunk.times[number])))
        return pa.Table.from_batches([_rows(rows, WINDOWS)])

    def gather(table: pa.Table) -> pa.Table:
        number, nth = (table[c].to_numpy().astype(np.uint32) for c in ("number", "nth"))
        row = (table["chunk"][0].as_py(), squeezed(number), squeezed(nth), squeezed(nth))
        return pa.Table.from_batches([_rows([row], FOUND)])

    windows = written(
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, _ddl(WINDOWS)),
        "windows",
    )
    again = windows.groupBy("d1", "d2").agg(F.sum("times").alias("n")).where("n > 1")
    return (
        windows.join(again, ["d1", "d2"])
        .select("chunk", "number", "nth")
        .groupBy("chunk")
        .applyInArrow(gather, _ddl(FOUND))
    )


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    length: int = LENGTH,
    many: int = MANY,
    as_text: bool = False,
) -> DataFrame:
    """Every text without the bytes that a repeated string of ``length`` bytes covers.

    One row per row of ``docs``: ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept`` (the other bytes, concatenated) and ``kept_sha256``. A string is repeated if it
    starts anywhere else, in the same text or another; all its occurrences go, and strings
    are judged on the input. Matches never cross texts. A null text is an empty one; texts
    shorter than ``length`` stay whole; equal rows remove each other's texts. Windows found in
    more than ``many`` ways are counted string by string instead of in one task. ``key`` may be
    of any type. With ``as_text`` ``kept`` is a string, without what is left of characters that
    were cut.
    """
    chunks = text_chunks(docs, key)
    answers = candidates(chunks, length, many)
    found = repeated(sorted_runs(chunks, answers, length), length)
    if answers.where("many > 0").limit(1).count():
        found = found.union(repeated_by_digest(chunks, answers, length))
    found = written(found, "repeated")
    schema = (
        T.StructType()
        .add(key, chunks.schema["keys"].dataType.elementType)
        .add("n_bytes", "long")
        .add("n_removed", "long")
        .add("n_spans", "long")
        .add("kept_sha256", "string")
        .add("kept", "string" if as_text else "binary")
    )

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left, 0, length)
        edge = np.zeros(len(chunk.body) + 1, dtype=np.int64)

        def cover(numbers: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
            """Mark the strings ``begins`` to ``ends`` of classes, in each run of a class."""
            order = np.argsort(chunk.number, kind="stable")
            bounds = np.searchsorted(chunk.number[order], [numbers, numbers + 1])
            counts = bounds[1] - bounds[0]
            each = np.repeat(np.arange(len(numbers)), counts)
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            runs = order[bounds[0][each] + within]
            np.add.at(edge, chunk.lo[runs] + begins[each], 1)
            np.add.at(edge, chunk.lo[runs] + ends[each] + length, -1)

        twice = np.flatnonzero(chunk.times > 1)
        if len(twice):
            first = chunk.first[twice]
            cover(twice, np.zeros(len(twice), np.int64), chunk.hi[first] - chunk.lo[first])
        for i in range(right.num_rows):
            cover(*(unsqueezed(right[c][i].as_py(), np.uint32).astype(np.int64) for c in ("numbers", "begins", "ends")))
        covered = np.cumsum(edge[:-1]) > 0
        body = np.frombuffer(chunk.body, dtype=np.uint8)
        removed, spans, kept, digests = [], [], [], []
        start = 0
        for end in chunk.ends.tolist():
            gone = covered[start:end]
            n = int(gone.sum())
            removed.append(n)
            spans.append(int((gone[1:] > gone[:-1]).sum()) + int(n > 0 and gone[0]))
            kept.append(body[start:end][~gone].tobytes() if n else chunk.body[start:end])
            digests.append(hashlib.sha256(kept[-1]).hexdigest())
            start = end
        if as_text:
            kept = [k.decode(errors="ignore") for k in kept]
        return pa.table(
            {
                key: chunk.doc_keys,
                "n_bytes": pa.array(np.diff(chunk.ends, prepend=0)),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
            }
        )

    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(cut, schema)


def unrepeated_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows of ``docs`` with the kept bytes as their text, ``n_chars`` to match.

    Where a removed string began or ended inside a character, what is left of the character
    goes too. A null text that lost nothing stays null.
    """
    used = ["text", "n_chars"] if "n_chars" in docs.columns else ["text"]
    rows, back = stashed(docs, *used)
    # The other columns travel with the texts, so that no second copy of the texts is stored.
    others = [c for c in rows.columns if c != "text"]
    row = F.struct(*others, F.col("text").isNull().alias("_none")).alias("_row")
    left = without_repeats(rows.select(row, "text"), "_row", length, as_text=True)
    texts = left.select(
        "n_removed", *(f"_row.{c}" for c in others), F.when(~F.col("_row._none"), F.col("kept")).alias("text")
    )
    if "n_chars" in used:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.col("n_removed") > 0
        texts = texts.withColumn("n_chars", F.when(changed, chars).otherwise(F.col("n_chars")))
    return texts.select(*back)
