"""Shards by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import numbered, prefix_sums, written

SLOTS = 4096
SHARDS = 8
#: A text whose copies weigh more than this part of a shard is dealt out by document.
HEAVY = 0.25

MAP_SCHEMA = "version int, slot int, bytes long, shard int"


def sized(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``rid``, ``size``, ``text_crc32`` and the text's hash."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return numbered(
        docs,
        "sized",
        "doc_id",
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("text_hash"),
    )


def with_slots(rows: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Add ``vslot``: the fixed virtual slot of each row of a written table.

    Copies of a text share a slot, except those of a text whose copies weigh more than a
    quarter of a shard; there are at most 4 x ``shards`` of these, and each is dealt over
    all slots by ``doc_id`` and row, so that no slot can outweigh a shard.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = (
        rows.groupBy("text_hash")
        .agg(F.sum("size").alias("weight"))
        .where(F.col("weight") > HEAVY * total / shards)
        .select("text_hash", F.lit(True).alias("heavy"))
    )
    # Bounded: weights above a quarter of a shard fit 4 x shards times into the total.
    return rows.join(F.broadcast(heavy), "text_hash", "left").withColumn(
        "vslot",
        F.pmod(
            F.when(F.col("heavy"), F.xxhash64("text_hash", "doc_id", "rid")).otherwise(
                F.xxhash64("text_hash")
            ),
            F.lit(slots),
        ).cast("int"),
    )


def assign(bytes_of: Mapping[int, int], shards: int) -> dict[int, int]:
    """Slot to shard: the heaviest slot first, each to the shard with the fewest bytes."""
    load = [0] * shards
    found = {}
    for slot in sorted(bytes_of, key=lambda s: (-bytes_of[s], s)):
        shard = min(range(shards), key=lambda x: (load[x], x))
        found[slot] = shard
        load[shard] += bytes_of[slot]
    return found


def edited(
    old: Mapping[int, int], bytes_of: Mapping[int, int], shards: int, slack: float = 0.01
) -> dict[int, int]:
    """The map after rebalancing: slots move only from overfull shards to the lightest one.

    Shards that no longer exist are emptied, new ones start empty. It ends when no shard is
    above or none below the mean by ``slack``, or when no move brings the loads closer.
    """
    found = {s: old[s] for s in old if old[s] < shards}
    load = [0] * shards
    for slot, shard in found.items():
        load[shard] += bytes_of.get(slot, 0)
    for slot in sorted(set(bytes_of) - set(found), key=lambda s: (-bytes_of[s], s)):
        shard = min(range(shards), key=lambda x: (load[x], x))
        found[slot] = shard
        load[shard] += bytes_of[slot]
    mean = sum(load) / shards
    while True:
        high = max(range(shards), key=lambda x: (load[x], -x))
        low = min(range(shards), key=lambda x: (load[x], x))
        gap, wanted = load[high] - load[low], min(load[high] - mean, mean - load[low])
        if wanted <= slack * mean:
            return found
        own = [s for s in found if found[s] == high and 0 < bytes_of.get(s, 0) < gap]
        if not own:
            return found
        slot = min(own, key=lambda s: (abs(wanted - bytes_of[s]), s))
        found[slot] = low
        load[high] -= bytes_of[slot]
        load[low] += bytes_of[slot]


def slot_map(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map for rows with ``vslot``: one row per slot, ``slots`` at most."""
    return _as_map(rows.sparkSession, 1, _weights(rows, slots), shards, None)


def rebalanced(old: DataFrame, rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The next version of a map for the present rows and number of shards."""
    last = old.where(F.col("version") == old.agg(F.max("version")).first()[0]).collect()
    before = {r.slot: r.shard for r in last}
    version = last[0].version + 1 if last else 1
    return _as_map(rows.sparkSession, version, _weights(rows, slots), shards, before)


def _weights(rows: DataFrame, slots: int) -> dict[int, int]:
    """Bytes per slot; the driver gets ``slots`` sums, whatever the number of rows."""
    found = dict.fromkeys(range(slots), 0)
    found.update({r.vslot: r.n for r in rows.groupBy("vslot").agg(F.sum("size").alias("n")).collect()})
    return found


def _as_map(
    spark: SparkSession, version: int, weights: dict[int, int], shards: int, before: dict | None
) -> DataFrame:
    found = assign(weights, shards) if before is None else edited(before, weights, shards)
    rows = [(version, s, weights[s], found[s]) for s in sorted(weights)]
    return written(spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1), "slot-map")


def sharded(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs`` with its shard and its place there.

    Columns: ``doc_id``, ``size`` (UTF-8 bytes plus one; 1 for a null text), ``text_crc32``,
    ``law`` (``bytes``), ``shard``, ``slot`` (gapless from 0 in its shard), ``grown_shard``
    (null under this law), ``virtual_slot`` and ``map_version``. Null ids and repeated rows
    are rows like any other. An empty table gives no rows.
    """
    rows = written(with_slots(sized(docs), shards, slots), "slotted")
    mapping = slot_map(rows, shards, slots)
    placed = written(
        rows.join(F.broadcast(mapping.select(F.col("slot").alias("vslot"), "shard", "version")), "vslot")
        .select("*", F.pmod("rid", F.lit(64)).alias("part"))
        .withColumn("bucket", F.col("vslot") * 64 + F.col("part")),
        "placed",
    )
    found = prefix_sums(
        placed, ["shard"], "bucket", [F.col("rid")], F.lit(1).cast("long"), "slot"
    )
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        F.col("version").alias("map_version"),
    )
