"""Quality rules: distances of a text's distributions from those of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, schema_of, stashed, written

COMMON_WORDS = 50
MIN_WORDS = 50
#: Jensen-Shannon distances (base 2, 0 to 1) beyond which a text is set aside.
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.18
#: A histogram of n words strays from its source by about 1 / sqrt(n); this much is allowed.
WORD_NOISE = 2.0
#: A language of fewer documents or words, in the whole corpus, is no reference.
REFERENCE_DOCUMENTS = 10
REFERENCE_WORDS = 2000
#: References at most, those of the languages with the most words.
REFERENCES = 1000

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "digit", "space", "sentence", "symbol", "beyond_ascii")


def _class_of_byte() -> np.ndarray:
    """Class of each byte; -1 for the later bytes of a code point."""
    of = np.full(256, CLASSES.index("symbol"))
    of[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    of[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    of[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    of[list(SPACES)] = CLASSES.index("space")
    of[list(b".,;:!?'\"()-")] = CLASSES.index("sentence")
    of[0x80:0xC0] = -1
    of[0xC0:] = CLASSES.index("beyond_ascii")
    return of


CLASS_OF_BYTE = _class_of_byte()


def class_counts(body: bytes) -> np.ndarray:
    """Number of code points of each character class."""
    found = CLASS_OF_BYTE[np.frombuffer(body, dtype=np.uint8)]
    return np.bincount(found + 1, minlength=len(CLASSES) + 1)[1:]


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of ``p`` from each row of ``q``; rows are counts."""
    p = p / max(p.sum(), 1)
    q = q / np.maximum(q.sum(axis=1, keepdims=True), 1)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0)
    return np.sqrt(np.maximum(0.0, (left + right).sum(axis=1) / 2))


def base_counts(body: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    solid = body.translate(None, SPACES)
    later = len(solid) - len(solid.translate(None, bytes(range(0x80, 0xC0))))
    lines = [x for x in body.split(b"\n") if x.strip(SPACES)]
    repeated = 0
    if len(words) > 2:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        times = Counter(windows)
        if len(times) < len(windows):
            begins = np.array([times[x] > 1 for x in windows])
            covered = np.zeros(len(words), dtype=bool)
            for shift in range(3):
                covered[shift : shift + len(begins)] |= begins
            repeated = int(covered.sum())
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    return len(words), len(solid) - later, symbols, len(lines) - len(set(lines)), repeated


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    column = batch.column("text").cast(pa.large_binary())
    for i in range(len(column)):
        yield column[i].as_py() or b""


def reference(
    docs: DataFrame,
    common_words: int = COMMON_WORDS,
    least_documents: int = 0,
    least_words: int = 0,
    most: int = REFERENCES,
) -> list[dict]:
    """Character-class counts and the commonest words of languages, over all documents.

    Of languages with ``least_documents`` documents and ``least_words`` words, ``most`` at most, those with
    the most words. Tasks add up their own documents first. What comes to the driver is
    one row of class counts and ``common_words`` words for each of these languages, whatever the
    number of documents and of other values of ``lang``. ``documents`` is the number of a
    language's documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}
        documents: Counter = Counter()

        def rows(kind: str, lang: str, items: list[bytes], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(n), pa.string()),
                    "kind": pa.array([kind] * len(n), pa.string()),
                    "item": pa.array(items, pa.binary()),
                    "n": pa.array(n, pa.int64()),
                }
            )

        def word_rows() -> Iterator[pa.RecordBatch]:
            for lang, counts in words.items():
                yield rows("word", lang, list(counts), list(counts.values()))

        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), _texts(batch), strict=True):
                documents[lang] += 1
                classes[lang] = classes.get(lang, 0) + class_counts(body)
                words.setdefault(lang, Counter()).update(body.lower().split())
            if sum(map(len, words.values())) > 500_000:
                yield from word_rows()
                words = {}
        yield from word_rows()
        for lang, counts in classes.items():
            yield rows("class", lang, [c.encode() for c in CLASSES], counts.tolist())
            yield rows("documents", lang, [b""], [documents[lang]])

    known = docs.select("lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    # Read three times: once for the choice of languages, twice for what they have.
    counted = written(
        map_batches(known, count, "lang string, kind string, item binary, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n")),
        "word-counts",
    )

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))

    chosen = (
        counted.groupBy("lang")
        .agg(total("documents").alias("_documents"), total("word").alias("_words"))
        .where((F.col("_documents") >= least_documents) & (F.col("_words") >= least_words))
        .orderBy(F.desc("_words"), "lang")
        .limit(most)
    )
    chosen = F.broadcast(written(chosen.select("lang"), "reference-languages"))  # `most` rows
    counted = counted.join(chosen, "lang")
    rank = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    kept = counted.withColumn("rank", F.row_number().over(rank))
    rows = (
        counted.groupBy("lang", "kind")
        .agg(F.sum("n").alias("total"))
        .join(kept.where(F.col("rank") <= common_words), ["lang", "kind"])
        .orderBy("lang", "kind", "rank")
        .collect()
    )
    found: dict[str, dict] = {}
    for row in rows:
        ref = found.setdefault(
            row.lang, {"lang": row.lang, "classes": {}, "words": {}, "total": 0, "documents": 0}
        )
        if row.kind == "documents":
            ref["documents"] = row.n
            continue
        ref["classes" if row.kind == "class" else "words"][bytes(row.item)] = row.n
        if row.kind == "word":
            ref["total"] = row.total
    return list(found.values())


OUTPUT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "char_distance double, word_distance double, base_failed boolean, kept boolean"
)


def assess(
    docs: DataFrame,
    references: list[dict] | None = None,
    max_char: float = MAX_CHAR_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Every row of ``docs`` with its counts, its two distances and ``kept``.

    A text fails the base rule with fewer than 50 words or with more than half of its
    words in repeated three-word windows. Beyond it, its character-class histogram and
    its histogram over the common words of a language are compared with every language's
    and the nearest language counts, so a wrong or missing ``lang`` does no harm. Only
    languages with enough text are references; documents of others are judged against
    these. A distance that too few words or a missing reference leave open is null
    and rejects nothing. A null text is an empty one; repeated rows each get a row and each
    count for their language; an empty table gives no rows. Columns of ``docs`` named like a result column
    are replaced; all others stay.
    """
    refs = references
    if refs is None:
        refs = reference(docs, COMMON_WORDS, REFERENCE_DOCUMENTS, REFERENCE_WORDS)
    keep = [c for c in docs.columns if c not in [x.split()[0] for x in OUTPUT.split(", ")]]
    classes = np.array(
        [[r["classes"].get(c.encode(), 0) for c in CLASSES] for r in refs], dtype=float
    )
    lists = [list(r["words"]) for r in refs]
    shares = [
        np.array([*r["words"].values(), r["total"] - sum(r["words"].values())], dtype=float)
        for r in refs
    ]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in _texts(batch):
                words = body.split()
                counts = base_counts(body, words)
                n, repeated = counts[0], counts[4]
                failed = n < MIN_WORDS or 100 * repeated > 50 * n
                by_char = by_word = None
                if refs and n >= MIN_WORDS:
                    by_char = float(js_distance(class_counts(body), classes).min())
                if refs and n >= MIN_WORDS:
                    seen = Counter(body.lower().split())
                    by_word = 1.0
                    for known, share in zip(lists, shares, strict=True):
                        own = [seen.get(w, 0) for w in known]
                        own = np.array([*own, n - sum(own)], dtype=float)
                        by_word = min(by_word, float(js_distance(own, share[None, :])[0]))
                most = max_word + WORD_NOISE / max(n, 1) ** 0.5
                far = (by_char or 0) > max_char or (by_word or 0) > most
                rows.append((*counts, by_char, by_word, failed, not failed and not far))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
            names = [x.split()[0] for x in OUTPUT.split(", ")]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *arrays], [*keep, *names]
            )

    return map_batches(docs, check, f"{schema_of(docs, keep)}, {OUTPUT}")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with their own columns."""
    rows, back = stashed(docs, "lang", "text")
    return assess(rows).where("kept").select(*back)
