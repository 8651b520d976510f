"""Near-duplicates by 64-bit SimHash fingerprints and an index of byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, numbered, schema_of, stashed, written
from shelfwise.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
POSITIONS = 8
#: Lists up to this length are tallied pair by pair; longer ones by their near values.
PAIRWISE = 2048


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text, repeats included.

    A-Z are lower-cased; words are runs of bytes other than space and \\t to \\r. A bit is
    set when it is set in more than half of the shingles' XXH64 values. A text of fewer
    words has one shingle, a text without a word the fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    total, ones = len(words) - width + 1, np.zeros(64, dtype=np.int64)
    hashes: list[int] = []
    for begin, end in spans:
        hashes.append(digest(joined[begin:end], SEED))
        if len(hashes) == 1 << 15:
            ones += _ones(hashes)
            hashes = []
    ones += _ones(hashes)
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def _ones(hashes: list[int]) -> np.ndarray:
    if not hashes:
        return np.zeros(64, dtype=np.int64)
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` (with a column ``text``) with ``fp``, the bits as a signed long."""
    keep = [c for c in docs.columns if c not in ("text", "fp")]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = [fingerprint(texts[i].as_py() or b"", shingle_words) for i in range(len(texts))]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), fp], [*keep, "fp"]
            )

    return map_batches(docs, mark, schema_of(docs, keep) + ", fp long")


def _keys(values: np.ndarray, chosen: tuple[int, ...], number: int) -> np.ndarray:
    """The bytes at the chosen positions, packed below the number of the choice."""
    key = np.full(len(values), number, dtype=np.uint64)
    for position in chosen:
        byte = (values >> np.uint64(8 * position)) & np.uint64(0xFF)
        key = (key << np.uint64(8)) | byte
    return key


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """Tally of positional bytes that are equal, from the XOR of two fingerprints."""
    return (x.view(np.uint8).reshape(*x.shape, POSITIONS) == 0).sum(axis=-1)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairs that pass the count filter and the check of the bit distance."""
    x = a ^ b
    passed = _shared_bytes(x) >= POSITIONS - max_bits
    passed[passed] = np.bitwise_count(x[passed]) <= max_bits
    return passed


def _roots(size: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index that each index reaches through the links."""
    root = np.arange(size)
    while True:
        old = root.copy()
        for a, b in links:
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, old):
            return root


def _list_roots(values: np.ndarray, chosen: tuple[int, ...], max_bits: int) -> np.ndarray:
    """Roots within one list of the index: distinct, sorted fingerprints that share a key."""
    n = len(values)
    links = []
    if n <= PAIRWISE:
        for begin in range(0, n, 256):
            part = values[begin : begin + 256]
            a, b = np.nonzero(_near(part[:, None], values[None, :], max_bits))
            links.append((a + begin, b))
        return _roots(n, links)
    # The key fixes all other bytes, so near fingerprints are the values a few bits away.
    free = [8 * p + bit for p in range(POSITIONS) if p not in chosen for bit in range(8)]
    for flips in range(1, max_bits + 1):
        for bits in combinations(free, flips):
            mask = np.uint64(sum(1 << bit for bit in bits))
            there = np.searchsorted(values, values ^ mask)
            there[there == n] = 0
            a = np.flatnonzero(values[there] == values ^ mask)
            if len(a):
                links.append((a, there[a]))
                if sum(len(x) for x, _ in links) > 4_000_000:
                    root = _roots(n, links)
                    links = [(np.arange(n), root)]
    return _roots(n, links)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints ``fp`` within ``max_bits`` bits.

    Fingerprints at most ``max_bits`` bits apart share at least 8 - ``max_bits`` of their
    positional bytes. The inverted index has a list for every combination of that many
    positions with their bytes, so a pair that reaches the count meets in a list; within
    it the shared bytes are tallied, the count filter applied and the bit distance checked.
    A list fixes all bytes but ``max_bits`` of them, which bounds its length by
    256 ** ``max_bits`` whatever the data. A list gives one link per member, to the root
    of its component in the list, never all pairs.
    """
    choices = list(combinations(range(POSITIONS), POSITIONS - max_bits))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for number, chosen in enumerate(choices):
                keys = _keys(values, chosen, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(values.view(np.int64))], ["key", "fp"]
                )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k = rest_v = np.empty(0, dtype=np.uint64)
        for batch in _with_end(batches):
            if batch is None:
                keys, values = rest_k, rest_v
                cut = len(keys)
            else:
                k = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
                v = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                keys, values = np.concatenate((rest_k, k)), np.concatenate((rest_v, v))
                # The last list may go on in the next batch.
                cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            rest_k, rest_v = keys[cut:], values[cut:]
            keys, values = keys[:cut], values[:cut]
            if len(keys) < 2:
                continue
            begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            lengths = np.diff(np.append(begins, len(keys)))
            found_a, found_b = [], []
            # Lists of two are the bulk of all lists with a pair.
            twos = begins[lengths == 2]
            near = _near(values[twos], values[twos + 1], max_bits)
            found_a.append(values[twos[near]])
            found_b.append(values[twos[near] + 1])
            for at, length in zip(begins[lengths > 2], lengths[lengths > 2], strict=True):
                own = np.sort(values[at : at + length])
                number = int(keys[at] >> np.uint64(8 * (POSITIONS - max_bits)))
                root = _list_roots(own, choices[number], max_bits)
                moved = np.flatnonzero(root != np.arange(length))
                found_a.append(own[moved])
                found_b.append(own[root[moved]])
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

    return (
        prints.select("fp")
        .distinct()
        .mapInArrow(index, "key long, fp long")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(tally, "a long, b long")
        .distinct()
    )


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(``rid``, ``doc_id``, ``fingerprint``, ``component_id``, ``root``) for every row.

    ``docs`` has ``rid``, ``doc_id`` and ``text``. ``fingerprint`` is 16 hexadecimal digits,
    ``root`` is the same for the rows of a component.
    ``component_id`` is the smallest ``doc_id`` among the rows whose fingerprints are linked,
    directly or through others; null when all of theirs are null. A null or empty text has
    fingerprint zero and is linked like any other, repeated rows are in one component.
    """
    marked = written(
        fingerprints(docs.select("rid", "doc_id", "text"), shingle_words), "fingerprints"
    )
    groups = components(near_links(marked, max_bits))
    low = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = low.join(groups, low.fp == groups.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = rooted.join(lowest, "root").select("fp", "component_id", "root")
    return marked.join(of_print, "fp").select(
        "rid",
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "root",
    )


def one_per_group(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates: its smallest (doc_id, row).

    Rows without a ``doc_id`` count after all others of their group.
    """
    rows, back = stashed(docs, "doc_id", "text")
    stored = numbered(rows, "documents", *rows.columns)
    groups = written(near_duplicates(stored, shingle_words, max_bits), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    first = groups.groupBy("root").agg(F.min(order).alias("first"))
    chosen = first.select(F.col("first.rid").alias("rid"))
    return stored.join(chosen, "rid", "left_semi").select(*back)
