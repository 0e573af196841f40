"""Sharding by fixed virtual slots.

Every record is hashed into one of ``SLOTS`` slots, a number that never changes. Bytes are summed per
slot, and a small table says which shard each slot belongs to. That table has versions: a new one
starts from the last and moves as few slots as it takes to bring the shards' bytes close together
again, or to fill new shards. Records are found by slot and version; they are rehashed never.

The law is ``bytes``: sizes of the shards are near equal. The whole map has ``SLOTS`` rows, so it is
edited on the driver and joined by broadcast. Places inside a shard are numbered without sorting the
records of a slot in one task: each input partition numbers its own records of a slot, and counts per
(slot, partition) say where they begin.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termspark.llm.common import read_once

SLOTS = 4096
SHARDS = 24
# bytes of a record besides its text
OVERHEAD = 8
# a map is left alone while the largest shard is within this share of the mean
TOLERANCE = 0.01
# monotonically_increasing_id keeps the partition above this bit
_PARTITION_BIT = 33

MAP = "version int, virtual_slot int, shard int"


def slot_records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, ``hash`` of id and text, and ``piece`` and ``at``, a record's place in the input."""
    text = F.col("text").cast("binary")
    at = F.monotonically_increasing_id()
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
        F.xxhash64("doc_id", text).alias("hash"),
        F.shiftright(at, _PARTITION_BIT).cast("int").alias("piece"),
        at.alias("at"),
    )


def with_slots(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``records`` with their ``virtual_slot`` instead of the hash.

    The slot follows the id and the text, so that many records of one id, or of one text, spread out. Of repeated
    rows each copy also has its number in its part of the input, so that they spread out as well.
    """
    repeated = records.groupBy("hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("hash")
    copy = F.row_number().over(Window.partitionBy("hash", "piece").orderBy("at"))
    single = records.join(repeated, "hash", "left_anti").withColumn("_slot", F.col("hash"))
    copies = records.join(repeated, "hash", "left_semi").withColumn("_slot", F.xxhash64("hash", "piece", copy))
    every = single.unionByName(copies)
    return every.withColumn("virtual_slot", F.pmod("_slot", F.lit(slots)).cast("int")).drop("hash", "_slot")


def rebalance(
    sizes: dict[int, int], current: dict[int, int], shards: int, slots: int, tolerance: float = TOLERANCE
) -> dict[int, int]:
    """Slot to shard, edited from ``current`` (empty at first) for the given bytes per slot.

    Slots without a shard, or of a shard that is gone, go largest first to the smallest shard. Then
    slots move from the largest shard to the smallest one, as long as that brings the two closer.
    """
    shard_of = {slot: shard for slot, shard in current.items() if shard < shards}
    load = [0] * shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for slot, shard in shard_of.items():
        load[shard] += sizes.get(slot, 0)
        held[shard][slot] = sizes.get(slot, 0)
    free = sorted((s for s in range(slots) if s not in shard_of), key=lambda s: (-sizes.get(s, 0), s))
    queue = [(bytes_, shard) for shard, bytes_ in enumerate(load)]
    heapq.heapify(queue)
    for slot in free:
        bytes_, shard = heapq.heappop(queue)
        load[shard] = bytes_ + sizes.get(slot, 0)
        held[shard][slot] = sizes.get(slot, 0)
        heapq.heappush(queue, (load[shard], shard))
    mean = sum(load) / shards
    for _ in range(slots):
        high, low = max(range(shards), key=lambda s: (load[s], s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        fits = [(abs(gap - 2 * n), slot) for slot, n in held[high].items() if 0 < n < gap]
        if load[high] <= mean * (1 + tolerance) and load[low] >= mean * (1 - tolerance) or not fits:
            break
        slot = min(fits)[1]
        n = held[high].pop(slot)
        held[low][slot] = n
        load[high], load[low] = load[high] - n, load[low] + n
    return {slot: shard for shard, own in enumerate(held) for slot in own}


def new_version(
    spark: SparkSession,
    sizes: DataFrame,
    shards: int,
    slots: int = SLOTS,
    previous: DataFrame | None = None,
) -> DataFrame:
    """The next version of the slot map, for ``sizes(virtual_slot, bytes)``; ``previous`` has MAP's columns.

    Slots that had no record are mapped as well, so any later record finds its shard.
    """
    last: list = previous.collect() if previous is not None else []
    version = max((r["version"] for r in last), default=0)
    current = {r["virtual_slot"]: r["shard"] for r in last if r["version"] == version}
    found = {r["virtual_slot"]: r["bytes"] for r in sizes.collect()}
    edited = rebalance(found, current, shards, slots)
    rows: Iterable = [(version + 1, slot, shard) for slot, shard in sorted(edited.items())]
    return spark.createDataFrame(list(rows), MAP).coalesce(1)


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with its shard and its place there.

    Columns: doc_id, size (UTF-8 bytes of the text and 8), text_crc32, law (``bytes``), shard, slot
    (gapless from 0 in each shard), grown_shard (NULL under this law), virtual_slot, version. A NULL
    text has no bytes. Repeated rows stay and spread over slots. No rows: no rows.
    """
    hashed, _ = read_once(slot_records(docs), "hashed-records")
    records, _ = read_once(with_slots(hashed, slots), "records")
    counted, _ = read_once(
        records.groupBy("virtual_slot", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "counts"
    )
    sizes = counted.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    slot_map, _ = read_once(new_version(docs.sparkSession, sizes, shards, slots), "slot-map")

    # where each slot begins in its shard: at most ``slots`` rows
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_starts = sizes.join(F.broadcast(slot_map), "virtual_slot").select(
        "virtual_slot", "shard", "version", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_slot_start")
    )
    # where each input partition begins in its slot
    before = Window.partitionBy("virtual_slot").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    piece_starts = counted.select(
        "virtual_slot", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_piece_start")
    )
    # a group is one slot's share of one input partition
    inside = F.row_number().over(Window.partitionBy("virtual_slot", "piece").orderBy("at")) - 1
    placed = records.withColumn("_inside", inside).join(piece_starts, ["virtual_slot", "piece"])
    return placed.join(F.broadcast(slot_starts), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_slot_start") + F.col("_piece_start") + F.col("_inside")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "version",
    )
