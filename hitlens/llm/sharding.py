"""Sharding through fixed virtual slots.

A record's hash decides its virtual slot for good. Only the bytes of each slot
are aggregated; a stored, versioned map sends slots to shards, and rebalancing
edits that map instead of rehashing records.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.llm.common import stored
from hitlens.session import stored_table_path

SLOTS = 4096
#: Each virtual slot is numbered in so many parts, so that no numbering
#: window holds a whole slot.
PARTS = 16
ROW_BYTES = 16


def placed_slots(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per record: key, size, text_crc32 and its virtual slot and part.

    A null text is empty (its CRC is 0); a null key hashes like any value.
    Equal rows share a slot.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(raw).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
    )
    h = F.xxhash64("key", "size", "text_crc32")
    return sized.select("*", F.pmod(h, F.lit(SLOTS)).cast("int").alias("virtual_slot"),
                        F.pmod(F.shiftrightunsigned(h, 32), F.lit(PARTS)).cast("int").alias("part"))


def largest_first(loads: dict[int, int], shards: int) -> dict[int, int]:
    """Slots to shards: each slot, the heaviest first, to the lightest shard."""
    heap = [(0, 0, s) for s in range(shards)]
    owner = {}
    for slot, load in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        total, count, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (total + load, count + 1, shard))
    return owner


def rebalanced(owner: dict[int, int], loads: dict[int, int], shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """``owner`` edited until no shard is over the mean by more than ``tolerance``.

    Slots unknown to the map and slots of removed shards are dealt first; then
    single slots move from the heaviest to the lightest shard as long as a
    move narrows their gap. Slots that need not move stay.
    """
    out = {s: o for s, o in owner.items() if o < shards}
    total = [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in out.items():
        total[shard] += loads.get(slot, 0)
        members[shard].add(slot)
    for slot, load in sorted(((s, v) for s, v in loads.items() if s not in out), key=lambda x: (-x[1], x[0])):
        shard = min(range(shards), key=lambda i: (total[i], i))
        out[slot] = shard
        total[shard] += load
        members[shard].add(slot)
    mean = sum(total) / shards
    while True:
        high, low = max(range(shards), key=lambda i: (total[i], -i)), min(range(shards), key=lambda i: (total[i], i))
        gap = total[high] - total[low]
        fit = [s for s in members[high] if 0 < loads.get(s, 0) < gap]
        if total[high] <= mean * (1 + tolerance) or not fit:
            return out
        slot = min(fit, key=lambda s: (abs(loads[s] - gap / 2), s))
        members[high].remove(slot)
        members[low].add(slot)
        total[high] -= loads[slot]
        total[low] += loads[slot]
        out[slot] = low


def slot_loads(placed: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot: at most ``SLOTS`` numbers, whatever the input."""
    return {r.virtual_slot: r.bytes for r in placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()}


def store_map(spark: SparkSession, owner: dict[int, int], version: int, path: str) -> DataFrame:
    """Write one version of the map below ``path``; earlier versions stay."""
    spark.createDataFrame(sorted(owner.items()), "virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")
    return load_map(spark, path, version)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{path}/version={version}")


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
                    map_path: str | None = None, version: int = 1) -> DataFrame:
    """Per record: key, size, text_crc32, shard, its place in the shard (gapless from 0), virtual slot and map version.

    Law ``bytes``: shards hold nearly equal bytes. Version 1 deals the slots
    anew; a later version edits the version before it. Empty tables give an
    empty result; repeated rows are separate records with places of their own.
    """
    spark = docs.sparkSession
    path = map_path or stored_table_path(spark, "slot-map")
    placed = stored(placed_slots(docs, key, text), "placed-slots")  # narrow: the texts are read once
    loads = slot_loads(placed)
    if version == 1:
        owner = largest_first(loads, shards)
    else:
        before = {r.virtual_slot: r.shard for r in load_map(spark, path, version - 1).collect()}
        owner = rebalanced(before, loads, shards)
    slot_map = store_map(spark, owner, version, path)
    # At most SLOTS * PARTS rows: a fixed bound, safe to broadcast.
    parts = placed.groupBy("virtual_slot", "part").agg(F.count("*").alias("n")).join(F.broadcast(slot_map), "virtual_slot")
    before_it = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("virtual_slot", "part", "shard", F.coalesce(F.sum("n").over(before_it), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("key", "text_crc32", "size")) - 1
    return (
        placed.withColumn("place", place)
        .join(F.broadcast(starts), ["virtual_slot", "part"])
        .select("key", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("place"), "virtual_slot",
                F.lit(version).alias("map_version"))
    )


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    return shard_documents(docs, shards).select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("place").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
