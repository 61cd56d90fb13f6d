"""Sharding over fixed virtual slots, with DataFrame functions only.

Every record hashes into one of a fixed number of virtual slots, bytes are
summed per slot, and a versioned slot-to-shard map says which shard holds
which slot.  Rebalancing and growing edit the map: only the rows of edited
slots move.  The driver holds nothing but the per-slot sums, at most
``slots`` rows whatever the size of the input.

Edge cases: a null id hashes like any other value; a null text counts no
bytes and its checksum is that of no bytes; repeated rows are kept, each with
its own place.  A slot that alone would hold more than an eighth of a shard
(one repeated or null id, say) has its rows dealt over all slots by their
content, and equal ones by their rank, so one hot key cannot fill a shard and
the places do not depend on files or partitions.  An empty table gives an
empty result.  Input columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import json_literal, stage
from tidewater.session import scratch_path

SLOTS = 4096
SHARDS = 24
ROW_OVERHEAD = 8
HOT_PART_OF_A_SHARD = 8


@dataclass(frozen=True)
class SlotMap:
    """One version of the slot-to-shard map: ``shard_of[slot]``."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def loads(self, slot_bytes: list[int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += slot_bytes[slot]
        return out


def plan_map(slot_bytes: list[int], shards: int = SHARDS) -> SlotMap:
    """Version 1: the largest slots first, each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    shard_of = [0] * len(slot_bytes)
    for slot in sorted(range(len(slot_bytes)), key=lambda s: (-slot_bytes[s], s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (load + slot_bytes[slot], shard))
    return SlotMap(1, shards, tuple(shard_of))


def rebalance(current: SlotMap, slot_bytes: list[int], tolerance: float = 0.01) -> SlotMap:
    """Next version: move slots from the fullest to the emptiest shard until
    they differ by at most ``tolerance`` of the mean, or no move helps."""
    shard_of, loads = list(current.shard_of), current.loads(slot_bytes)
    held = [sorted((slot_bytes[s], s) for s in range(len(shard_of)) if shard_of[s] == k) for k in range(current.shards)]
    goal = tolerance * sum(loads) / max(1, current.shards)
    while (gap := max(loads) - min(loads)) > goal:
        full, empty = loads.index(max(loads)), loads.index(min(loads))
        movable = [x for x in held[full] if 0 < x[0] < gap]
        if not movable:
            break
        size, slot = min(movable, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        held[full].remove((size, slot))
        held[empty] = sorted([*held[empty], (size, slot)])
        loads[full] -= size
        loads[empty] += size
        shard_of[slot] = empty
    return SlotMap(current.version + 1, current.shards, tuple(shard_of))


def grow(current: SlotMap, slot_bytes: list[int]) -> SlotMap:
    """Next version with one more shard, which alone takes slots in."""
    new, loads = current.shards, current.loads(slot_bytes)
    shard_of, goal, taken = list(current.shard_of), sum(slot_bytes) / (current.shards + 1), 0
    for slot in sorted(range(len(shard_of)), key=lambda s: (-slot_bytes[s], s)):
        size, old = slot_bytes[slot], shard_of[slot]
        if 0 < size <= goal - taken and loads[old] - size >= goal * 0.98:
            shard_of[slot] = new
            loads[old] -= size
            taken += size
    return SlotMap(current.version + 1, new + 1, tuple(shard_of))


def map_frame(spark: SparkSession, slot_map: SlotMap, first_place: list[int] | None = None) -> DataFrame:
    """The map as rows ``(slot, shard, map_version[, first_place])``."""
    arrays = {"shard": slot_map.shard_of, **({"first_place": first_place} if first_place else {})}
    each = spark.range(1).select(*[F.from_json(F.lit(json_literal(list(v))), "array<bigint>").alias(k) for k, v in arrays.items()])
    rows = each.select(F.posexplode(F.arrays_zip(*arrays)).alias("virtual_slot", "x"))
    return rows.select(
        F.col("virtual_slot").cast("int").alias("virtual_slot"),
        F.col("x.shard").cast("int").alias("shard"),
        *[F.col("x.first_place")] * ("first_place" in arrays),
        F.lit(slot_map.version).alias("map_version"),
    )


def save_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Add one version under ``path``; earlier versions stay readable."""
    rows = map_frame(spark, slot_map).withColumn("shards", F.lit(slot_map.shards))
    rows.coalesce(1).write.mode("append").partitionBy("map_version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """Read one version (the newest if not named); at most ``slots`` rows."""
    rows = spark.read.parquet(path)
    if version is None:
        version = rows.agg(F.max("map_version")).first()[0]
    got = rows.where(F.col("map_version") == version).orderBy("virtual_slot").select("shard", "shards").collect()
    return SlotMap(int(version), int(got[0]["shards"]), tuple(int(r["shard"]) for r in got))


def _sums(rows: DataFrame, slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot: at most ``slots`` rows come to the driver."""
    size, count = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        size[r["virtual_slot"]], count[r["virtual_slot"]] = int(r["b"]), int(r["n"])
    return size, count


def slot_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, shards: int = SHARDS) -> tuple[DataFrame, list[int], list[int]]:
    """Staged narrow rows ``(doc_id, size, text_crc32, row_no, virtual_slot)``
    with the bytes and the rows of each slot.  The text is read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_no"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(slots)).cast("int").alias("virtual_slot"),
    )
    rows = stage(narrow, "slot-rows")
    size, count = _sums(rows, slots)
    share = sum(size) / max(1, shards) / HOT_PART_OF_A_SHARD
    hot = [s for s in range(slots) if size[s] > share and count[s] > 1]
    if hot:
        rows = rows.where(~F.col("virtual_slot").isin(hot)).unionByName(_dealt(rows.where(F.col("virtual_slot").isin(hot)), slots))
        rows = stage(rows, "dealt-rows")
        size, count = _sums(rows, slots)
    return rows, size, count


def _dealt(rows: DataFrame, slots: int) -> DataFrame:
    """Rows of hot slots dealt over all slots by their content, equal ones by
    their rank: which slots get how many of them depends on the rows alone,
    not on files or partitions.  The rank is counted within a partition and
    shifted by the partitions before, so no task gathers equal rows."""
    ranked = rows.select("*", F.xxhash64("doc_id", "text_crc32", "size").alias("content"), F.shiftrightunsigned("row_no", 33).alias("part"))
    within = Window.partitionBy("content", "part").orderBy("row_no")
    earlier = Window.partitionBy("content").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranked.groupBy("content", "part").agg(F.count(F.lit(1)).alias("n"))
    shift = counts.select("content", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = ranked.withColumn("place", F.row_number().over(within)).join(shift, ["content", "part"])
    return placed.withColumn("virtual_slot", F.pmod(F.pmod("content", F.lit(slots)) + F.col("before") + F.col("place"), F.lit(slots)).cast("int")).select(*rows.columns)


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, shards: int = SHARDS, slot_map: SlotMap | None = None, map_path: str | None = None) -> DataFrame:
    """Shard and place in it for every record.

    Returns ``doc_id, size, text_crc32, virtual_slot, shard, slot,
    map_version``; ``slot`` counts the records of a shard from 0 without
    gaps.  The rank is taken within a virtual slot and shifted by the rows
    of the shard's earlier slots, so no task ever sorts a whole shard.
    Without ``slot_map`` a first version is planned from the summed bytes;
    the map used is stored under ``map_path`` (the scratch folder if None).
    """
    spark = docs.sparkSession
    rows, size, count = slot_rows(docs, id_col, text_col, slots, shards)
    used = slot_map or plan_map(size, shards)
    save_map(spark, used, map_path or scratch_path(spark, "slot-map"))
    first, filled = [0] * slots, [0] * used.shards
    for slot, shard in enumerate(used.shard_of):
        first[slot] = filled[shard]
        filled[shard] += count[slot]
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "row_no"))
    # The map has exactly ``slots`` rows, whatever the size of the input.
    placed = rows.withColumn("rank", rank).join(F.broadcast(map_frame(spark, used, first)), "virtual_slot")
    return placed.select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard",
        (F.col("first_place") + F.col("rank") - 1).cast("bigint").alias("slot"), "map_version",
    )
