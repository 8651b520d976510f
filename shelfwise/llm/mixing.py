"""A mix of sources at target weights by a low-discrepancy schedule of blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfwise.llm.common import WORD, numbered, prefix_sums, stashed, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 256
GOLDEN = (5**0.5 - 1) / 2
#: Streams and the schedule are cut into this many parts and this many slots a part.
STREAM_PARTS = 4096
SCHEDULE_PART = 1 << 16


def sized_documents(docs: DataFrame, *more: str) -> DataFrame:
    """A written table of ``rid``, ``doc_id``, ``source``, ``size``, ``place`` and ``more``.

    ``size`` is the number of words. ``key`` names the source, null included; ``place`` is
    a hash that shuffles the source's documents.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names = ["doc_id", "source", *[c for c in more if c not in ("doc_id", "source")]]
    return numbered(
        docs,
        "sized",
        *names,
        F.when(F.col("source").isNull(), F.lit("n"))
        .otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
        .alias("_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.xxhash64(F.col("doc_id"), text).alias("_place"),
    )


def targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per source: ``_key``, ``source_size``, ``target``.

    Sources in the order of their code points, null last, get ``weights`` in turn and
    divide ``share`` of all sizes. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight. A step of the search is one aggregate.
    """
    order = Window.orderBy(F.col("_key") == "n", "_key")
    # One row per source, not per document, meets in the window.
    per_source = (
        sized.groupBy("_key")
        .agg(F.sum("_size").alias("source_size"))
        .withColumn("_number", F.row_number().over(order) - 1)
    )
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    per_source = written(
        per_source.select(
            "_key",
            "source_size",
            F.element_at(cycle, (F.col("_number") % len(weights) + 1).cast("int")).alias("_weight"),
            (F.col("source_size") * float(most)).alias("_cap"),
        ),
        "sources",
    )
    budget = share * (per_source.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("_cap") <= F.col("_weight") * level
        fixed, free = per_source.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))),
        ).first()
        now = (budget - fixed) / free if free else level
        if now <= level * (1 + 1e-15):
            break
        level = now
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(level))
    return per_source.select("_key", "source_size", target.alias("target"))


def schedule(quotas: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots of the mix: (``n``, ``_key``, ``_block``), one per block of every target.

    ``quotas`` is a written table of ``_key`` and ``target``. Slot n looks up the golden-ratio
    point frac((n + 1/2) x 0.618...) among the cumulative targets, so every stretch of the
    schedule mixes the sources in proportion; a source's slots are ranked, and rank r is
    its r-th block. Slots beyond a target are left out and blocks that the points did not
    reach, a few per source, come at the end.
    """
    spark = quotas.sparkSession
    need = F.ceil(F.floor(F.col("target") + 0.5) / F.lit(block)).cast("long")
    quotas = quotas.select("_key", need.alias("_need")).where("_need > 0")
    total, sources = quotas.agg(F.sum("_need"), F.count("*")).first()
    total = total or 0
    before = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    cells = max(1024, sources)
    bounds = (
        quotas.withColumn("_low", F.coalesce(F.sum("_need").over(before), F.lit(0)))
        .withColumn("_high", F.col("_low") + F.col("_need"))
        .withColumn(
            "_cell",
            F.explode(
                F.sequence(
                    F.floor(F.col("_low") * cells / max(total, 1)),
                    F.least(F.floor(F.col("_high") * cells / max(total, 1)), F.lit(cells - 1)),
                )
            ),
        )
    )
    # n is split in two so that the product keeps its fraction exact enough.
    high, low = F.shiftright("id", 20), F.col("id").bitwiseAND((1 << 20) - 1)
    step = ((1 << 20) * GOLDEN) % 1.0
    point = high * F.lit(step) + (low + 0.5) * F.lit(GOLDEN)
    points = (
        spark.range(total)
        .select(F.col("id").alias("n"), (point - F.floor(point)).alias("_x"))
        .withColumn("_at", F.least(F.floor(F.col("_x") * total), F.lit(max(total - 1, 0))))
        .withColumn("_cell", F.least(F.floor(F.col("_at") * cells / max(total, 1)), F.lit(cells - 1)))
    )
    drawn = written(
        points.join(bounds, "_cell")
        .where("_at >= _low and _at < _high")
        .select("n", "_key", "_need", F.floor(F.col("n") / SCHEDULE_PART).alias("_part")),
        "points",
    )
    ranked = prefix_sums(drawn, ["_key"], "_part", [F.col("n")], F.lit(1).cast("long"), "_block")
    missed = (
        quotas.join(drawn.groupBy("_key").agg(F.count("*").alias("_got")), "_key", "left")
        .withColumn("_got", F.coalesce("_got", F.lit(0)))
        .where("_got < _need")
        .select("_key", F.explode(F.expr("sequence(_got, _need - 1)")).alias("_block"))
    )
    return (
        ranked.where("_block < _need")
        .select("n", "_key", "_block")
        .union(
            missed.select(F.lit(total) + F.monotonically_increasing_id(), "_key", "_block")
        )
    )


def stream_pieces(sized: DataFrame, per_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks of every source's shuffled stream, as pieces of documents.

    (``rid``, ``_key``, ``_block``, ``_epoch``, ``_from``, ``_to``): the words from ``_from`` to ``_to``
    of a document in a pass over the source. The stream is the documents in the order of
    a hash, repeated until the target is full.
    """
    parted = written(
        sized.where("_size > 0").select(
            "rid",
            "_key",
            "_size",
            "_place",
            "doc_id",
            F.pmod("_place", F.lit(STREAM_PARTS)).alias("_part"),
        ),
        "parted",
    )
    placed = prefix_sums(
        parted,
        ["_key"],
        "_part",
        [F.col("_place"), F.col("doc_id"), F.col("rid")],
        F.col("_size"),
        "_begin",
    )
    taken = F.floor(F.col("target") + 0.5)
    epochs = placed.join(per_source, "_key").select(
        "*",
        taken.alias("_taken"),
        F.explode(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(taken / F.col("source_size")) - 1))
        ).alias("_epoch"),
    )
    spans = (
        epochs.withColumn("_low", F.col("_epoch") * F.col("source_size") + F.col("_begin"))
        .withColumn("_high", F.least(F.col("_low") + F.col("_size"), F.col("_taken")))
        .where("_low < _high")
    )
    return spans.select(
        "rid",
        "_key",
        "_epoch",
        "_low",
        "_high",
        F.explode(F.expr(f"sequence(_low div {block}, (_high - 1) div {block})")).alias("_block"),
    ).select(
        "rid",
        "_key",
        "_block",
        "_epoch",
        (F.greatest(F.col("_low"), F.col("_block") * block) - F.col("_low")).alias("_from"),
        (F.least(F.col("_high"), (F.col("_block") + 1) * block) - F.col("_low")).alias("_to"),
    )


def mixed(sized: DataFrame, per_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """The pieces of the mix with their slot ``n``: the schedule joined to the streams."""
    slots = schedule(per_source, block)
    return stream_pieces(sized, per_source, block).join(slots, ["_key", "_block"])


def taken_words(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                most: float = MOST, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``first_slot`` for every row of ``docs``.

    ``first_slot`` is where the schedule first takes words of the row, null if it takes none.
    Null texts and texts without a word have size 0 and are never taken. Null sources form
    one source, the last. Repeated rows are documents of their own.
    """
    sized = sized_documents(docs)
    per_source = written(targets(sized, weights, share, most), "targets")
    took = mixed(sized, per_source, block).groupBy("rid").agg(
        F.sum(F.col("_to") - F.col("_from")).alias("taken"), F.min("n").alias("first_slot")
    )
    return (
        sized.join(per_source, "_key")
        .join(took, "rid", "left")
        .select(
            "doc_id",
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            "first_slot",
        )
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                    most: float = MOST, block: int = BLOCK) -> DataFrame:
    """The mix itself: a row of ``docs`` for each pass in which words of it are taken.

    A document that a pass takes whole keeps its text; of one that the target cuts, the
    words taken are kept, joined by spaces. ``n_chars``, if there, is that of the text.

    Rows are in the order of the schedule: documents are dealt to partitions by a hash, and
    every partition, and so every file written from it, goes by the first slot of each
    row. So each stretch of each file mixes the sources by their targets, and the texts
    need no second shuffle. Null texts and texts without a word are not in the mix, repeated
    rows are documents of their own, and an empty table gives no rows.
    """
    used = ["doc_id", "source", "text", *(["n_chars"] if "n_chars" in docs.columns else [])]
    stash, back = stashed(docs, *used)
    sized = sized_documents(stash, *stash.columns)
    per_source = written(targets(sized, weights, share, most), "targets")
    spans = (
        mixed(sized, per_source, block)
        .groupBy("rid", "_epoch")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.min("n").alias("_slot"))
    )
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    begin, count = F.col("_from") + 1, F.col("_to") - F.col("_from")
    cut = F.array_join(F.slice(words, begin.cast("int"), count.cast("int")), " ")
    whole = (F.col("_from") == 0) & (F.col("_to") == F.col("_size"))
    rows = sized.join(spans, "rid").withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    if "n_chars" in used:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.length("text").cast(kind))
    return rows.sortWithinPartitions("_slot", "rid").select(*back)
