"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

Every row hashes into one of a fixed number of slots.  Bytes are summed per slot, and a
small stored map, one row per slot and version, says which shard a slot belongs to.
Rebalancing edits the map: it moves slots from shards above the mean to shards below it,
and everything else stays where it is.

A null text has no bytes; every row adds one byte of framing.  A null ``doc_id`` hashes
with the text's digest alone, so such rows spread as well.  Wholly equal rows are numbered
and all but the first hash their number too, so copies spread over the slots as other rows
do, and further copies leave the earlier ones where they are.
An empty table gives no rows and a map of equal numbers of slots.  Input columns other
than the id and the text are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlark.llm import common

SHARDS = 8
SLOTS = 8192
#: Copies of a row that one task numbers.
COPIES = 1024
_MAP = "version bigint, virtual_slot int, shard int"


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``virtual_slot`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = ["doc_id", "size", "text_crc32"]
    # Copies are folded before the shuffle, and come back by the numbers of their blocks.
    blocks = rows.groupBy(*key).agg(F.count("*").alias("_n")).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(COPIES)))
    )
    last = F.least(F.col("_n"), F.col("_from") + COPIES) - 1
    numbered = blocks.repartition(*key, "_from").select(
        *key, F.explode(F.sequence("_from", last)).alias("_copy")
    )
    first = F.xxhash64("doc_id", "text_crc32", "size")
    hashed = F.when(F.col("_copy") == 0, first).otherwise(
        F.xxhash64("doc_id", "text_crc32", "size", "_copy")
    )
    slot = F.pmod(hashed, F.lit(slots)).cast("int")
    return numbered.select(*key, slot.alias("virtual_slot"))


def slot_totals(rows: DataFrame) -> DataFrame:
    """Bytes and rows per slot: as many rows as there are slots at most."""
    return rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )


def rebalance(owner: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """Edits a map until no move of a slot from the fullest shard to the emptiest helps.

    Slots of shards that no longer exist, or of none, are placed first, heaviest first.
    """
    owner = {slot: shard for slot, shard in owner.items() if 0 <= shard < shards}
    load = [0] * shards
    for slot, shard in owner.items():
        load[shard] += weight.get(slot, 0)
    heap = [(load[shard], shard) for shard in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(set(weight) - set(owner), key=lambda s: (-weight[s], s)):
        _, shard = heap[0]
        owner[slot] = shard
        load[shard] += weight[slot]
        heapq.heapreplace(heap, (load[shard], shard))
    held = [{s for s in owner if owner[s] == shard} for shard in range(shards)]
    while True:
        low = min(range(shards), key=lambda s: (load[s], s))
        high = max(range(shards), key=lambda s: (load[s], -s))
        gap = load[high] - load[low]
        # The move that leaves the two closest: a weight near half of the gap, below the gap.
        movable = [s for s in held[high] if 0 < weight.get(s, 0) < gap]
        if not movable:
            return owner
        slot = min(movable, key=lambda s: (abs(2 * weight[s] - gap), s))
        held[high].remove(slot)
        held[low].add(slot)
        owner[slot] = low
        load[high] -= weight[slot]
        load[low] += weight[slot]


def latest_map(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The newest version of a stored map: its number and the shard of each slot."""
    rows = spark.read.schema(_MAP).parquet(path)
    newest = rows.agg(F.max("version")).first()[0]
    kept = rows.filter(F.col("version") == newest).collect()  # as many rows as slots
    return newest, {row["virtual_slot"]: row["shard"] for row in kept}


def write_map(spark: SparkSession, path: str, version: int, owner: dict[int, int]) -> None:
    rows = [(version, slot, shard) for slot, shard in sorted(owner.items())]
    spark.createDataFrame(rows, _MAP).coalesce(1).write.mode("append").parquet(path)


def first_map(slots: int, shards: int) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def assign(
    rows: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Edits the map at ``path`` (made when ``rebalance`` finds none) for these rows' bytes,
    stores it as the next version, and adds ``shard`` and ``slot``: the row's place in its
    shard, from 0 without gaps."""
    spark = rows.sparkSession
    totals = {
        row["virtual_slot"]: (row["bytes"], row["rows"]) for row in slot_totals(rows).collect()
    }
    version, owner = latest_map(spark, path)
    owner = rebalance(owner, {s: totals.get(s, (0, 0))[0] for s in range(slots)}, shards)
    write_map(spark, path, version + 1, owner)
    begin, filled = [], [0] * shards
    for slot in range(slots):
        begin.append((slot, owner[slot], filled[owner[slot]]))
        filled[owner[slot]] += totals.get(slot, (0, 0))[1]
    places = spark.createDataFrame(begin, "virtual_slot int, shard int, _begin bigint")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        common.without(rows, "shard", "slot")
        .withColumn("_within", F.row_number().over(within) - 1)
        .join(F.broadcast(places), "virtual_slot")  # one row per slot
        .withColumn("slot", F.col("_begin") + F.col("_within"))
        .drop("_begin", "_within")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over eight shards of near equal bytes."""
    rows = common.stored(slotted(common.table(spark, sf_dir, "documents")), "slotted")
    path = common.new_path(spark, "slot_map")
    write_map(spark, path, 1, first_map(SLOTS, SHARDS))
    return assign(rows, path).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
