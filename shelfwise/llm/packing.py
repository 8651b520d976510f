"""Packing of token sequences: patterns fitted to the length histogram."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, written

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task remembers, and pieces of words; beyond, it starts anew.
WORDS_KEPT = 400_000
#: How the tokenizer parts a text, and the same on words of ASCII and small or capital
#: letters of Latin-1, which no composition changes, as bytes, with ASCII lower-cased and
#: one space between words, which is a piece here.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
_SIMPLE = re.compile(rb"(?:[\x00-\x7f]|" + _LATIN + rb")*")
_PIECE = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|" + _LATIN + rb")+|[0-9]|[^a-z0-9\x80-\xff ]+| "
)
#: Stands for the space between words; no id has these four bytes.
_SPACE = b"\xff" * 4
FIT_STEPS = 300
#: A pattern may leave this part of a sequence empty, one in so many.
REST = 256
#: Where the second document of a three-document pattern lies in what the first leaves.
SPLITS = (0.5, 0.62, 0.75, 0.88)


def _word_ends(path: str, vocabulary: Mapping[str, int]) -> np.ndarray | None:
    """Whether an id ends a piece, by id; None for a tokenizer that parts texts otherwise."""
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    suffix = kind["model"].get("end_of_word_suffix")
    parts = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    if not suffix or (parts[0].get("pattern") or {}).get("Regex") != SPLIT:
        return None
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[bytes], bytes]:
    """Text to its ids as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never joins what stands on either side of it, so
    a text's ids are those of its words one after the other; words repeat, their ids are
    remembered. ASCII is lower-cased first, as the tokenizer does itself, unless a special
    token could arise from it. The tokenizer composes before it lower-cases, and some small
    letters compose with a mark that the capital does not, so in a text with combining
    marks only words of pure ASCII are.

    It parts words again, into runs of letters, digits and runs of signs, and joins nothing
    across these. The pieces of a new word are remembered too, and new pieces are encoded
    in one text: each has one id that ends a word, its last.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = _word_ends(path, tokenizer.get_vocab())
    known: dict[bytes, bytes] = {}
    known_pieces: dict[bytes, bytes] = {}

    def whole(new: list[bytes]) -> Iterator[bytes]:
        ids = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        return (pack(f"<{len(e)}I", *e.ids) for e in ids)

    def encode_pieces(new: list[bytes]) -> Iterator[bytes]:
        text = b" ".join(new).decode()
        ids = np.array(
            tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4"
        )
        stops = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
        if len(stops) != len(new):
            return whole(new)
        body = ids.tobytes()
        return (body[i:j] for i, j in zip([0, *stops], stops, strict=False))

    def learn(new: list[bytes]) -> None:
        others = []
        text = b" ".join(new)
        if ends is None:
            new, others = [], new
        elif b"<|" in text or not _SIMPLE.fullmatch(text):
            simple = {w for w in new if b"<|" not in w and _SIMPLE.fullmatch(w)}
            others = [w for w in new if w not in simple]
            new = list(simple)
            text = b" ".join(new)
        if new:
            found = _PIECE.findall(text.lower())
            if len(known_pieces) > WORDS_KEPT:
                known_pieces.clear()
            known_pieces[b" "] = _SPACE
            if pieces := list(set(found).difference(known_pieces)):
                known_pieces.update(zip(pieces, encode_pieces(pieces), strict=True))
            ids = b"".join(map(known_pieces.__getitem__, found)).split(_SPACE)
            known.update(zip(new, ids, strict=True))
        if others:
            known.update(zip(others, whole(others), strict=True))

    def encode(body: bytes) -> bytes:
        low = body.lower()
        words = (body if b"<|" in low else low).split()
        # First bytes of U+0300 to U+037F: only marks among these compose with ASCII letters.
        if b"\xcc" in low or b"\xcd" in low:
            words = [x.lower() if x.isascii() and b"<|" not in low else x for x in body.split()]
        if len(known) > WORDS_KEPT:
            known.clear()
        if new := set(words).difference(known):
            learn(list(new))
        return b"".join(map(known.__getitem__, words))

    return encode


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document's ids: at most ``capacity`` long, cut only where needed.

    ``tokenizer`` is the path of a tokenizer file on every machine. A document's ids are
    followed by the id 0; a null or empty text is that id alone. ``part`` and ``nth`` number
    the pieces of one length within the task that made them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            doc_ids = batch.column("doc_id")
            at, rows = [], []
            for i in range(len(texts)):
                ids = encode(texts[i].as_py() or b"") + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[start : start + 4 * capacity]
                    length = len(own) // 4
                    at.append(i)
                    rows.append((piece, start // 4, length, zlib.crc32(own), part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(pa.array(at, pa.int64())),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"),
        cut,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long",
    )


def patterns(lengths: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Combinations of one to three of the lengths that fill a sequence but for a rest.

    For every longest member: the longest second one that fits, and several seconds each
    with the longest third one that fits, if no more than one part in ``REST`` of the
    sequence stays empty; looser ones would use up the short lengths that fill others.
    Lengths are sorted; the number of patterns is at most five per length, whatever the
    number of documents.
    """
    found = set()
    for a in lengths.tolist():
        room = capacity - a
        firsts = [room, *(int(room * s) for s in SPLITS)]
        for most in firsts:
            i = int(np.searchsorted(lengths, min(a, most), side="right")) - 1
            if i < 0:
                found.add((a,))
                continue
            b = int(lengths[i])
            k = int(np.searchsorted(lengths, min(b, room - b), side="right")) - 1
            found.add((a, b) if k < 0 else (a, b, int(lengths[k])))
    tight = capacity - capacity // REST
    return sorted((p for p in found if sum(p) >= tight), reverse=True)


def fitted(counts: np.ndarray, members: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts of patterns that fit the histogram by least squares.

    ``members`` holds the index of each length of each pattern, ``used`` whether it is there.
    Accelerated projected gradient steps; long lengths weigh more, as short ones are easy
    to place afterwards.
    """
    n = len(counts)
    weight = np.linspace(0.3, 1.0, n)
    flat = members.ravel()

    def times(x: np.ndarray) -> np.ndarray:
        return weight * np.bincount(flat, (x[:, None] * used).ravel(), minlength=n)

    def back(r: np.ndarray) -> np.ndarray:
        return ((weight * r)[members] * used).sum(axis=1)

    x = np.ones(len(members))
    for _ in range(30):
        x = back(times(x))
        norm = np.linalg.norm(x)
        x /= norm
    target, step = weight * counts, 1.0 / norm
    x = z = np.zeros(len(members))
    momentum = 1.0
    for _ in range(FIT_STEPS):
        new = np.maximum(0.0, z - step * back(times(z) - target))
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        z = new + (momentum - 1) / after * (new - x)
        x, momentum = new, after
    return x


def strategy(histogram: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """How many sequences to make of which lengths: (pattern, count), all pieces placed.

    Fitted patterns are rounded and cut to what the histogram has. What is left goes, the
    longest first, to where it fits best: into room that patterns leave or into a new
    sequence. The work depends on ``capacity``, not on the number of pieces.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    lengths = np.array(sorted(left), dtype=np.int64)
    made: list[tuple[tuple[int, ...], int]] = []
    if chosen := patterns(lengths, capacity):
        place = {length: i for i, length in enumerate(lengths.tolist())}
        members = np.array([[place[m] for m in p] + [0] * (3 - len(p)) for p in chosen])
        used = np.array([[1.0] * len(p) + [0.0] * (3 - len(p)) for p in chosen])
        counts = np.array([left[x] for x in lengths.tolist()], dtype=float)
        repeats = np.rint(fitted(counts, members, used)).astype(np.int64)
        for i in np.lexsort((np.arange(len(chosen)), -repeats)).tolist():
            pattern = chosen[i]
            most = min(left[m] // pattern.count(m) for m in pattern)
            take = int(min(repeats[i], most))
            if take > 0:
                made.append((pattern, take))
                for m in pattern:
                    left[m] -= take
    # Sequences with room, by room; each entry stands for `count` equal sequences.
    rooms: list[list[list]] = [[] for _ in range(capacity + 1)]
    for pattern, count in made:
        rooms[capacity - sum(pattern)].append([pattern, count])
    for length in sorted(left, reverse=True):
        n = left[length]
        room = length
        while n > 0:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                fits = capacity // length
                if full := n // fits:
                    rooms[capacity - fits * length].append([(length,) * fits, full])
                if rest := n % fits:
                    rooms[capacity - rest * length].append([(length,) * rest, 1])
                break
            entry = rooms[room][-1]
            take = min(n, entry[1])
            entry[1] -= take
            if entry[1] == 0:
                rooms[room].pop()
            rooms[room - length].append([(*entry[0], length), take])
            n -= take
            if room - length >= length:
                room = length
    return [(tuple(p), c) for room in rooms for p, c in room if c > 0]


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces.

    The histogram (at most ``capacity`` rows) comes to the driver and the strategy goes back
    as arrays whose size depends on ``capacity`` alone. Pieces of one length are equal to
    the strategy: the piece of rank r takes the r-th place for its length, and ranks are
    sums of the counts that tasks made, so a length that a third of all pieces share needs
    no common task.
    """
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("_n"))
    histogram = {
        r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    }
    keys, begins, bases, offsets = [], [], [], []
    ranks: dict[int, int] = dict.fromkeys(histogram, 0)
    sequence = 0
    for pattern, count in strategy(histogram, capacity):
        offset = 0
        for length in pattern:
            keys.append((length << 44) + ranks[length])
            begins.append(ranks[length])
            bases.append(sequence)
            offsets.append(offset)
            ranks[length] += count
            offset += length
        sequence += count
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    key_table = np.array(keys, dtype=np.int64)[order]
    begin_table, base_table, offset_table = (
        np.array(x, dtype=np.int64)[order] for x in (begins, bases, offsets)
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(key_table, (length << 44) + rank, side="right") - 1
            own = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *own,
                    pa.array(base_table[at] + rank - begin_table[at]),
                    pa.array(offset_table[at]),
                ],
                [*names, "sequence_id", "offset"],
            )

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    ranked = pieces.join(starts, ["length", "part"]).select(
        *(c for c in pieces.columns if c not in ("part", "nth")),
        (F.col("_start") + F.col("nth")).alias("_rank"),
    )
    types = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank"
    )
    return ranked.mapInArrow(place, f"{types}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document with its sequence and its place there.

    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``. Null ids and
    repeated rows are packed like any other; an empty table gives no rows.
    """
    return packed(written(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)
