"""Language identification by character language models with Kneser-Ney smoothing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, schema_of, written

ORDER = 4
BITS = 16
SPACE = 0x20
#: What stands for the letters beyond 16 bits that would fold to a space or to nothing.
FOLDED = 0xFFFF
#: Languages that get a model at most, those with the most different training rows.
LANGUAGES = 1000
#: The sample that models are learned from: so many rows per language, of so many characters on average at most.
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 20_000
#: One sampled row in this many sets the rejection threshold instead of the counts.
CALIBRATION = 10
REJECT_QUANTILE = 0.999
#: Symbols of short texts that are scored together; a longer text is scored by itself.
CHUNK = 2_000_000
SHARPNESS = 10.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    """Letters by code point stand for themselves, folded to 16 bits; all else is a space."""
    table = np.full(0x110000, SPACE, dtype=np.uint64)
    for point in range(0x110000):
        if chr(point).isalpha():
            folded = (point ^ (point >> 16)) & 0xFFFF
            # No letter may become a space or nothing.
            table[point] = FOLDED if folded in (0, SPACE) else folded
    return table


def symbols(text: str) -> np.ndarray:
    """Lower-cased letters with one space between and around runs; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found = _symbol_of()[points]
    found = np.concatenate(([SPACE], found, [SPACE])).astype(np.uint64)
    space = found == SPACE
    found = found[~(space & np.concatenate(([False], space[:-1])))]
    return found if len(found) > 1 else found[:0]


def grams(found: np.ndarray, order: int) -> np.ndarray:
    """Keys of all runs of ``order`` symbols, 16 bits each, the last symbol lowest."""
    key = found[: max(len(found) - order + 1, 0)].copy()
    for i in range(1, order):
        key = (key << np.uint64(BITS)) | found[i : len(found) - order + 1 + i]
    return key


def _low(key: np.ndarray, order: int) -> np.ndarray:
    """The keys of the last ``order`` symbols."""
    return key & np.uint64((1 << (BITS * order)) - 1) if order * BITS < 64 else key


@dataclass
class Level:
    """Sorted keys of one order with log probabilities; contexts with log back-off weights."""

    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    lang: str
    levels: list[Level]
    floor: float
    reject_above: float


def learn(lang: str, texts: list[np.ndarray]) -> Model:
    """Interpolated Kneser-Ney model of the symbols' runs up to ``ORDER``.

    The highest order uses counts, lower ones the number of different symbols before; each
    order's discount is n1 / (n1 + 2 n2). Every stored probability is already interpolated
    with the lower orders, so a look-up stops at the first order that knows the run.
    """
    counted = [(np.empty(0, np.uint64), np.empty(0, np.int64))] * (ORDER + 1)
    top = np.concatenate([grams(t, ORDER) for t in texts] or [np.empty(0, np.uint64)])
    counted[ORDER] = np.unique(top, return_counts=True)
    for order in range(ORDER - 1, 0, -1):
        longer = counted[order + 1][0]
        counted[order] = np.unique(_low(longer, order), return_counts=True)
    floor = -np.log(max(len(counted[1][0]), 1) + 1.0)
    levels: list[Level] = []
    for order in range(1, ORDER + 1):
        keys, counts = counted[order]
        if not len(keys):
            levels.append(Level(keys, np.empty(0), keys, np.empty(0)))
            continue
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context = keys >> np.uint64(BITS)
        contexts, where = np.unique(context, return_inverse=True)
        total = np.bincount(where, counts)
        kinds = np.bincount(where)
        weight = discount * kinds / total
        if order == 1:
            lower = np.full(len(keys), np.exp(floor))
        else:
            below = levels[-1]
            lower = np.exp(below.logs[np.searchsorted(below.keys, _low(keys, order - 1))])
        prob = np.maximum(counts - discount, 0) / total[where] + weight[where] * lower
        levels.append(Level(keys, np.log(prob), contexts, np.log(weight)))
    return Model(lang, levels, floor, np.inf)


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def log_probs(model: Model, keys: np.ndarray) -> np.ndarray:
    """Log probability of the last symbol of each highest-order key given the others."""
    result = np.zeros(len(keys))
    open_ = np.arange(len(keys))
    for order in range(ORDER, 0, -1):
        level, own = model.levels[order - 1], _low(keys[open_], order)
        at, known = _found(level.keys, own)
        if known.any():
            result[open_[known]] += level.logs[at[known]]
        open_, own = open_[~known], own[~known]
        at, known = _found(level.contexts, own >> np.uint64(BITS))
        if known.any():
            result[open_[known]] += level.weights[at[known]]
    result[open_] += model.floor
    return result


def cross_entropies(models: list[Model], texts: list[np.ndarray]) -> np.ndarray:
    """Mean negative log probability per symbol, by text and model; texts have a letter.

    Texts are taken together and cut in chunks. A chunk's different runs are scored once
    and the scores summed per text.
    """
    pad = np.full(ORDER - 2, SPACE, dtype=np.uint64)
    all_keys = [grams(np.concatenate((pad, t)), ORDER) for t in texts]
    counts = np.array([len(k) for k in all_keys])
    owner = np.repeat(np.arange(len(texts)), counts)
    keys = np.concatenate(all_keys)
    total = np.zeros((len(texts), len(models)))
    for begin in range(0, len(keys), CHUNK):
        part, own = keys[begin : begin + CHUNK], owner[begin : begin + CHUNK]
        different = np.unique(part)
        at = np.searchsorted(different, part)
        for m, model in enumerate(models):
            scores = log_probs(model, different)[at]
            total[:, m] += np.bincount(own, scores, minlength=len(texts))
    return -total / np.maximum(counts, 1)[:, None]


def _fold(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def sample(docs: DataFrame) -> DataFrame:
    """The bounded training sample: ``SAMPLE_ROWS`` rows per language, in hash order.

    Whole rows of any length, up to ``SAMPLE_ROWS * SAMPLE_CHARS`` characters a language, and
    one row of every language at least. With more than ``LANGUAGES`` languages the others, by
    their number of different rows, have none: a corpus with a label of its own in every
    document brings a bounded table to the driver.

    Hashes are spread evenly, so only those in the lowest part of their range, some four
    times as many as are wanted by an estimate of the different rows, come into the order.
    The cut is found on hashes alone; only sampled texts are moved, and equal rows count
    once.
    """
    rows = docs.where(
        F.col("lang").isNotNull()
        & (_fold("doc_id") != 1)
        & F.col("text").isNotNull()
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    langs = (
        rows.groupBy("lang")
        .agg(F.approx_count_distinct("h", 0.02).alias("rows"), F.min("h").alias("least"))
        .orderBy(F.desc("rows"), "lang")
        .limit(LANGUAGES)
    )
    langs = written(langs, "languages")
    place = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    low = (place <= F.lit(4.0 * SAMPLE_ROWS) / F.col("rows")) | (F.col("h") == F.col("least"))
    order = Window.partitionBy("lang").orderBy("h")
    cuts = (
        rows.select("lang", "h", F.length("text").cast("long").alias("n"))
        .join(F.broadcast(langs), "lang")  # LANGUAGES rows at most
        .where(low)
        .select("lang", "h", "n")
        .distinct()
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= SAMPLE_ROWS)
        .withColumn("chars", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("nth") == 1) | (F.col("chars") <= SAMPLE_ROWS * SAMPLE_CHARS))
        .groupBy("lang")
        .agg(F.max("h").alias("cut"))
    )
    cuts = F.broadcast(written(cuts, "cuts"))  # LANGUAGES rows at most
    chosen = rows.join(cuts, "lang").where("h <= cut")
    return chosen.groupBy("lang", "h").agg(F.first("text").alias("text"))


def train(docs: DataFrame) -> list[Model]:
    """A model per language from the sample; the driver gets arrays of bounded size."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("h", ignore_index=True)["text"]
        texts = [(n, s) for n, s in enumerate(map(symbols, ordered), 1) if len(s)]
        if not texts:
            return pd.DataFrame({"lang": [], "name": [], "data": []})
        held = [s for n, s in texts if n % CALIBRATION == 0 and len(s) >= 200]
        model = learn(
            rows["lang"].iloc[0], [s for n, s in texts if n % CALIBRATION or len(texts) < 20]
        )
        cut = np.inf
        if held:
            cut = float(np.quantile(cross_entropies([model], held), REJECT_QUANTILE)) * 1.1
        out = [("cut", np.array([cut, model.floor]))]
        for order, level in enumerate(model.levels):
            parts = (level.keys, level.logs, level.contexts, level.weights)
            out += [(f"{order}{i}", p) for i, p in enumerate(parts)]
        return pd.DataFrame(
            {
                "lang": [model.lang] * len(out),
                "name": [n for n, _ in out],
                "data": [p.tobytes() for _, p in out],
            }
        )

    rows = written(
        sample(docs).groupBy("lang").applyInPandas(fit, "lang string, name string, data binary"),
        "language-models",
    ).collect()
    models = []
    for lang in sorted({r.lang for r in rows}):
        own = {r.name: bytes(r.data) for r in rows if r.lang == lang}
        cut, floor = np.frombuffer(own["cut"])
        levels = [
            Level(
                *(
                    np.frombuffer(own[f"{order}{i}"], dtype=np.float64 if i % 2 else np.uint64)
                    for i in range(4)
                )
            )
            for order in range(ORDER)
        ]
        models.append(Model(lang, levels, float(floor), float(cut)))
    return models


def identify(docs: DataFrame, models: list[Model] | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``accepted`` for every row of ``docs``.

    The language with the lowest cross-entropy per symbol over the whole text. ``score`` is
    the share of the best language when the entropies compete; ``accepted`` is false when
    the entropy is beyond what the language's own calibration rows reach. A text that is
    null or has no letter is ``und`` with score 0; so are all when nothing could be
    learned. Equal entropies go to the first language by name. A null id counts as an empty
    one for the fold. Repeated rows are learned from once and each get a row; an empty table
    gives none; other columns are not read, whatever their names. A text is scored whole
    in one task, at some 30 bytes a character.
    """
    learned = train(docs) if models is None else models
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    rows = docs.select("doc_id", (_fold("doc_id") == 1).alias("held_out"), "text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            texts = batch.column("text")
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            accepted = np.zeros(len(texts), dtype=bool)
            waiting: list[tuple[int, np.ndarray]] = []

            def decide(waiting: list, langs: list, scores: np.ndarray, accepted: np.ndarray):
                if not waiting or not models:
                    return
                entropy = cross_entropies(models, [s for _, s in waiting])
                best = entropy.argmin(axis=1)
                low = entropy[np.arange(len(best)), best]
                share = 1 / np.exp(SHARPNESS * (low[:, None] - entropy)).sum(axis=1)
                for (i, _), b, e, s in zip(waiting, best, low, share, strict=True):
                    langs[i], scores[i] = models[b].lang, min(max(s, 0.0), 1.0)
                    accepted[i] = e <= models[b].reject_above

            size = 0
            for i in range(len(texts)):
                found = symbols(texts[i].as_py() or "")
                if not len(found):
                    continue
                waiting.append((i, found))
                size += len(found)
                if size >= CHUNK:
                    decide(waiting, langs, scores, accepted)
                    waiting, size = [], 0
            decide(waiting, langs, scores, accepted)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(langs, pa.string()),
                    pa.array(scores),
                    pa.array(accepted),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return map_batches(
        rows,
        predict,
        schema_of(rows, ["doc_id", "held_out"]) + ", lang_pred string, score double, accepted boolean",
    )
