"""Token counts of whole texts: huge ones in overlapping chunks, spliced where both agree.

For byte-level BPE vocabularies. Such a tokenizer first cuts a text into pieces by a pattern
that reads from left to right (runs of letters, of digits, of other signs, each with a space
before it, and runs of white space) and then merges bytes inside a piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, written

LIMIT = 512
#: Characters of a chunk and of the part that two neighbours share.
CHUNK = 16_384
OVERLAP = 512
#: Pieces whose tokens a task remembers; beyond, it starts anew. Longer pieces are not kept.
PIECES_KEPT = 400_000
PIECE_KEPT_CHARS = 40

# Characters that some tables of white space hold and others do not, or that
# the pattern counts as white space though they are not among the four of _BREAK.
_UNSURE = "\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_BREAK = " \t\n\r"
_CAREFUL = re.compile(
    f"[{_BREAK}{_UNSURE}]*(?:[^{_BREAK}{_UNSURE}]+(?:[{_UNSURE}][{_BREAK}{_UNSURE}]*)?)+"
    f"|[{_BREAK}{_UNSURE}]+"
)
_HAS_UNSURE = re.compile(f"[{_UNSURE}]")
# Letters in every edition of the character tables.
_LETTERS = (
    "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af\u0400-\u0481\u048a-\u0523"
    "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
#: Two characters between which the pattern always cuts, whatever stands around them: no
#: alternative of it goes on from a letter to another sign, from a digit to another sign, or
#: from a sign to white space.
_CERTAIN = re.compile(
    f"(?<=[{_LETTERS}])(?=[\\x00-@\\[-`{{-\\x7f])|(?<=[0-9])(?=[\\x00-/:-\\x7f])|(?<=[!-~])(?=[{_BREAK}])"
)
#: Parts that end between two such characters: the second kind only before white space.
_PLAIN = re.compile(f"[{_BREAK}]*[{_LETTERS}]++(?=[\\x00-@\\[-`{{-\\x7f])|[{_BREAK}]*[^{_BREAK}]+|[{_BREAK}]+")
_WORD = re.compile(f" [{_LETTERS}]+")
#: A stretch that the pattern never cuts inside.
_ONE_PIECE = re.compile(f"[{_LETTERS}]+|[0-9]+|[{_BREAK}]+|[!-&(-/:-@\\[-`{{-~]+")


class Encoder:
    """A byte-level BPE tokenizer file, giving the lengths in bytes of a text's tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        known = (
            model["type"] == "BPE"
            and not model["dropout"]
            and not model.get("ignore_merges")
            and spec["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut["add_prefix_space"]
            and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not known:
            raise ValueError(f"{path} is no byte-level BPE without normalizer")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        sizes = {i: len(token) for token, i in model["vocab"].items()}
        sizes |= {a["id"]: len(a["content"].encode()) for a in added}
        # A byte each: no token has more than 255.
        self.sizes = np.zeros(max(sizes) + 1, dtype=np.uint8)
        self.sizes[list(sizes)] = list(sizes.values())
        self.specials = [a["content"] for a in added]
        self.guard = max([len(s) for s in self.specials], default=0)
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that share no token, cut between characters always parted."""
        careful = _HAS_UNSURE.search(text) or any(s in text for s in self.specials)
        return (_CAREFUL if careful else _PLAIN).findall(text)

    def learn(self, parts: set[str]) -> None:
        """Put the token lengths of new parts into ``known``."""
        # Words after a space share no token with each other, so many are encoded at once.
        words = [p for p in parts if _WORD.fullmatch(p)]
        rows = [words[i : i + 1000] for i in range(0, len(words), 1000)]
        rows += [[p] for p in parts.difference(words)]
        for start in range(0, len(rows), 5000):
            some = rows[start : start + 5000]
            texts = ["".join(r) for r in some]
            codes = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for row, code in zip(some, codes, strict=True):
                sizes = self.sizes[code.ids].tobytes()
                if len(row) == 1:
                    self.known[row[0]] = sizes
                    continue
                ends = np.cumsum(np.frombuffer(sizes, dtype=np.uint8), dtype=np.int64)
                own = np.cumsum([len(p.encode()) for p in row])
                cuts = (np.searchsorted(ends, own) + 1).tolist()
                for p, a, b in zip(row, [0, *cuts], cuts, strict=False):
                    self.known[p] = sizes[a:b]

    def lengths(self, texts: list[str]) -> Iterator[list[bytes]]:
        """Lengths in bytes of the tokens of each text, part by part."""
        if len(self.known) > PIECES_KEPT:
            self.known.clear()
        rows = [self.pieces(t) for t in texts]
        new = set().union(*rows).difference(self.known)
        self.learn(new)
        for row in rows:
            yield list(map(self.known.__getitem__, row))
        for part in new:
            if len(part) > PIECE_KEPT_CHARS:
                del self.known[part]

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        out, some, size = [], [], 0
        for i, text in enumerate(texts):
            some.append(text)
            size += len(text)
            if size > 1_000_000 or i + 1 == len(texts):
                out += [sum(map(len, row)) for row in self.lengths(some)]
                some, size = [], 0
        return out

    def boundaries(self, text: str) -> np.ndarray:
        """Where the tokens of a text end, in bytes."""
        (row,) = self.lengths([text])
        return np.cumsum(np.frombuffer(b"".join(row), dtype=np.uint8), dtype=np.int64)

    def certain(self, shared: str, last: bool) -> list[int]:
        """Byte offsets in a shared stretch at which every encoding has a token boundary.

        Between two characters that the pattern always parts, and not inside a special
        string. A special string could reach in from outside, so as many characters as the
        longest one has are left out on either side; not at the end of a text (``last``).
        """
        end = len(shared) if last else len(shared) - self.guard
        taken = [
            (m.start(), m.end()) for s in self.specials for m in re.finditer(re.escape(s), shared)
        ]
        out, bytes_before, at = [], 0, 0
        for m in _CERTAIN.finditer(shared, self.guard, max(end, 0)):
            p = m.start()
            if not any(a < p < b for a, b in taken):
                bytes_before += len(shared[at:p].encode())
                at = p
                out.append(bytes_before)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def short_counts(docs: DataFrame, tokenizer: str, chunk: int) -> DataFrame:
    """A written table: ``rid``, ``doc_id``, ``n_bytes``, ``n_tokens``, ``n_chars`` and ``text``.

    Texts of less than two chunks are counted; longer ones keep their text instead.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            bodies = batch.column("text").cast(pa.large_binary()).to_pylist()
            texts = [(b or b"").decode(errors="replace") for b in bodies]
            short = [len(t) < 2 * chunk for t in texts]
            counts = iter(encoder.counts([t for t, s in zip(texts, short, strict=True) if s]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    batch.column("doc_id"),
                    pa.array([len(b or b"") for b in bodies], pa.int64()),
                    pa.array([next(counts) if s else None for s in short], pa.int64()),
                    pa.array([None if s else len(t) for t, s in zip(texts, short, strict=True)], pa.int64()),
                    pa.array([None if s else t for t, s in zip(texts, short, strict=True)], pa.string()),
                ],
                ["rid", "doc_id", "n_bytes", "n_tokens", "n_chars", "text"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    schema = f"rid long, doc_id {kind}, n_bytes long, n_tokens long, n_chars long, text string"
    return written(map_batches(rows, count, schema), "token-counts")


def encoded_spans(
    texts: DataFrame, spans: DataFrame, tokenizer: str, chunk: int, overlap: int
) -> DataFrame:
    """A written table of spans with their encodings: what a splice and a count need.

    A span holds the chunks ``first`` to ``after`` (exclusive) of text ``rid`` and is encoded with
    ``overlap`` more characters. ``n`` is its number of tokens, ``head`` the token boundaries in
    its first ``overlap`` characters (from its start), ``tail`` those in the stretch that it shares
    with the next span (from that one's start), in bytes; ``certain`` the proven boundaries
    of that stretch and ``one_piece`` whether the pattern cannot cut inside it.
    """
    lists = spans.groupBy("rid").agg(F.collect_list(F.struct("first", "after")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rid, text = batch.column("rid")[i].as_py(), batch.column("text")[i].as_py()
                whole = len(text) // chunk
                for s in batch.column("spans")[i].as_py():
                    end = len(text) if s["after"] == whole else s["after"] * chunk + overlap
                    body = text[s["first"] * chunk : end]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "rid": [rid], "first": [s["first"]], "after": [s["after"]],
                            "last": [s["after"] == whole], "ends": [end >= len(text)], "body": [body],
                        }
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                body = row["body"]
                bounds = encoder.boundaries(body)
                own = (row["after"] - row["first"]) * chunk
                start = len(body[:own].encode())
                head = bounds[bounds <= len(body[:overlap].encode())].tolist()
                tail, certain, one_piece = [], [], False
                if not row["last"]:
                    shared = body[own:]
                    tail = (bounds[bounds >= start] - start).tolist()
                    certain = encoder.certain(shared, row["ends"])
                    one_piece = _ONE_PIECE.fullmatch(shared) is not None
                rows.append((len(bounds), [0, *head], tail, certain, one_piece))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            lists = pa.list_(pa.int64())
            kinds = [pa.int64(), lists, lists, lists, pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["rid", "first", "after", "last"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *arrays],
                [*names, "n", "head", "tail", "certain", "one_piece"],
            )

    bodies = map_batches(
        texts.select("rid", "text").join(lists, "rid"),
        cut,
        "rid long, first long, after long, last boolean, ends boolean, body string",
    )
    # One text's chunks go to many tasks.
    dealt = bodies.repartition("rid", "first")
    schema = (
        "rid long, first long, after long, last boolean, n long, head array<long>, "
        "tail array<long>, certain array<long>, one_piece boolean"
    )
    return written(map_batches(dealt, encode, schema), "spans")


def _pairs(bounds: str) -> Column:
    """Neighbouring boundaries: the tokens of a list of boundaries."""
    return F.expr(
        f"transform(slice({bounds}, 2, greatest(size({bounds}) - 1, 0)), "
        f"(to, i) -> named_struct('from', {bounds}[i], 'to', to))"
    )


def splices(spans: DataFrame) -> DataFrame:
    """(``rid``, ``seam``, ``at``) for every two neighbouring spans; ``at`` is null without a proof.

    ``at`` is a place in the shared stretch, in bytes from its start, where the left encoding
    ends and the right one goes on. Two kinds are proven. A boundary that the pattern makes
    from the two characters beside it alone, and that both encodings have. Or, in a stretch
    inside one piece, the end of a token that both encodings have: tokens of a piece are
    its encoding if every two neighbours are the encoding of their bytes, and with a shared
    token all neighbours of the spliced row are neighbours in one of the two encodings.
    """
    left = spans.where(~F.col("last")).select(
        "rid", F.col("after").alias("seam"), "tail", "certain", "one_piece"
    )
    right = spans.select("rid", F.col("first").alias("seam"), "head")
    agreed = F.array_min(F.array_intersect(F.array_intersect("certain", "head"), "tail"))
    shared = F.array_min(F.transform(F.array_intersect(_pairs("head"), _pairs("tail")), lambda t: t["to"]))
    return left.join(right, ["rid", "seam"]).select(
        "rid", "seam", F.coalesce(agreed, F.when(F.col("one_piece"), shared)).alias("at")
    )


def long_counts(
    texts: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(``rid``, ``n_tokens``) of texts of at least two chunks, by spliced encodings.

    ``texts`` is a written table with ``rid``, ``text`` and ``n_chars``. Where two neighbours have no
    proven place to splice, the overlap is widened to the whole of the next span: the two
    become one span and are encoded again. That happens to every second such seam of a
    text, so spans grow twofold a round and only where it is needed.
    """
    if overlap < 64 or overlap > chunk:
        raise ValueError("an overlap has 64 characters at least and a chunk at most")
    numbers = F.expr(f"sequence(0L, n_chars div {chunk} - 1)")
    todo = texts.select("rid", F.explode(numbers).alias("first"))
    todo = todo.withColumn("after", F.col("first") + 1)
    spans = encoded_spans(texts, todo, tokenizer, chunk, overlap)
    while True:
        seams = written(splices(spans), "splices")
        open_seams = seams.where("at is null")
        if open_seams.isEmpty():
            break
        nth = F.row_number().over(Window.partitionBy("rid").orderBy("seam"))
        chosen = open_seams.withColumn("_n", nth).where("_n % 2 = 1").select("rid", "seam")
        left = spans.select("rid", "first", F.col("after").alias("seam")).join(chosen, ["rid", "seam"])
        right = spans.select("rid", F.col("first").alias("seam"), "after").join(chosen, ["rid", "seam"])
        wider = written(left.join(right, ["rid", "seam"]).select("rid", "first", "seam", "after"), "wider")
        gone = wider.select("rid", "first").union(wider.select("rid", "seam"))
        again = encoded_spans(texts, wider.select("rid", "first", "after"), tokenizer, chunk, overlap)
        spans = written(spans.join(gone, ["rid", "first"], "left_anti").union(again.select(*spans.columns)), "spans")
    starts = seams.select("rid", F.col("seam").alias("first"), F.col("at").alias("_start"))
    ends = seams.select("rid", F.col("seam").alias("after"), F.col("at").alias("_end"))
    before = F.size(F.filter("head", lambda x: (x > 0) & (x <= F.col("_start"))))
    beyond = F.size(F.filter("tail", lambda x: x > F.col("_end")))
    own = F.col("n")
    own = own - F.when(F.col("_start").isNull(), 0).otherwise(before)
    own = own - F.when(F.col("_end").isNull(), 0).otherwise(beyond)
    return (
        spans.join(starts, ["rid", "first"], "left")
        .join(ends, ["rid", "after"], "left")
        .groupBy("rid")
        .agg(F.sum(own).alias("n_tokens"))
    )


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is the path of a byte-level BPE file on every machine; others raise ValueError.
    Special strings inside a text are one token, as the library has it. Texts of two chunks
    and more are encoded in chunks by many tasks (``long_counts``). A null or empty text has no
    tokens; null and repeated ids and repeated rows are counted row by row; an empty table
    gives no rows; columns other than ``doc_id`` and ``text`` are not read, whatever their names.
    """
    first = short_counts(docs, tokenizer, chunk)
    texts = first.where(F.col("n_chars").isNotNull())
    rows = first.where(F.col("n_chars").isNull()).select("doc_id", "n_bytes", "n_tokens")
    if not texts.select("rid").isEmpty():
        counts = long_counts(texts, tokenizer, chunk, overlap)
        long = texts.select("rid", "doc_id", "n_bytes").join(counts, "rid")
        rows = rows.union(long.select("doc_id", "n_bytes", "n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
