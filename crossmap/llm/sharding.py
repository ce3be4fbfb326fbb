"""Sharding by fixed virtual slots.

A row's virtual slot is a hash of its identifier, so it never changes. Bytes are
added up per virtual slot, and a small versioned table says which shard holds
which virtual slot. Rebalancing or a change in the number of shards edits that
table; rows move only with their virtual slot.

Defined cases: a null text has size 1 and the checksum of the empty text; rows
with a null identifier are spread over the virtual slots by their text; repeated
rows each get a place of their own; an empty table gives an empty result and a
map of equal ranges; further columns, whatever their names, do no harm.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crossmap.llm.common import checkpointed, column, free_name

VIRTUAL_SLOTS = 8192
#: Rows of a virtual slot are numbered in so many parts, so that no sort grows with a whole slot.
PARTS = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long"


def virtual_slot(df: DataFrame, id_col: str, text_col: str, slots: int) -> Column:
    identifier, text = column(df, id_col), F.coalesce(column(df, text_col), F.lit(""))
    by_text = F.xxhash64(F.crc32(text.cast("binary")), F.octet_length(text))
    return F.pmod(F.when(identifier.isNull(), by_text).otherwise(F.xxhash64(identifier.cast("string"))), F.lit(slots)).cast("int")


def slotted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """(id, size, text_crc32, virtual_slot, part) of every row; texts are read once and left behind."""
    identifier, text = column(df, id_col), F.coalesce(column(df, text_col), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    return df.select(
        identifier.alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), crc.cast("long").alias("text_crc32"),
        virtual_slot(df, id_col, text_col, slots).alias("virtual_slot"),
        F.pmod(F.xxhash64(crc, identifier.cast("string")), F.lit(PARTS)).cast("int").alias("part"),
    )


def slot_sizes(rows: DataFrame, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Bytes per virtual slot; one number for each of the fixed slots reaches the driver."""
    sizes = [0] * slots
    for slot, size in rows.groupBy("virtual_slot").agg(F.sum("size")).collect():
        sizes[slot] = size
    return sizes


def first_map(slots: int, shards: int) -> list[int]:
    """The map before anything is known of sizes: virtual slots in equal ranges."""
    return [slot * shards // slots for slot in range(slots)]


def rebalanced(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """The map edited so that shards hold nearly equal bytes, moving few virtual slots.

    Slots of shards that no longer exist, and the largest slots that fit from
    shards above the mean, go to the lightest shard, largest first; then single
    moves and swaps between the heaviest and the lightest shard follow while they help.
    """
    owner, held = list(owner), [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    loose = []
    for slot, shard in enumerate(owner):
        if 0 <= shard < shards:
            members[shard].add(slot)
            held[shard] += sizes[slot]
        else:
            loose.append(slot)
    mean = sum(sizes) / shards
    for shard in range(shards):
        for slot in sorted(members[shard], key=lambda s: (-sizes[s], s)):
            if held[shard] <= mean:
                break
            if sizes[slot] and held[shard] - sizes[slot] >= mean - sizes[slot] / 2:
                members[shard].discard(slot)
                held[shard] -= sizes[slot]
                loose.append(slot)
    queue = [(size, shard) for shard, size in enumerate(held)]
    heapq.heapify(queue)
    for slot in sorted(loose, key=lambda s: (-sizes[s], s)):
        size, shard = heapq.heappop(queue)
        owner[slot] = shard
        members[shard].add(slot)
        held[shard] = size + sizes[slot]
        heapq.heappush(queue, (held[shard], shard))
    for _ in range(64 * shards):
        high, low = max(range(shards), key=lambda s: (held[s], -s)), min(range(shards), key=lambda s: (held[s], s))
        gap = held[high] - held[low]
        best = None
        lows = sorted((sizes[s], s) for s in members[low]) + [(0, -1)]
        lows.sort()
        at = 0
        for size, slot in sorted((sizes[s], s) for s in members[high]):
            while at + 1 < len(lows) and abs(size - lows[at + 1][0] - gap / 2) < abs(size - lows[at][0] - gap / 2):
                at += 1
            change = size - lows[at][0]
            if 0 < change < gap and (best is None or abs(change - gap / 2) < best[0]):
                best = (abs(change - gap / 2), slot, lows[at][1])
        if best is None:
            break
        _, give, take = best
        for slot, source, target in ((give, high, low), (take, low, high)):
            if slot >= 0:
                members[source].discard(slot)
                members[target].add(slot)
                owner[slot] = target
                held[source] -= sizes[slot]
                held[target] += sizes[slot]
    return owner


def next_version(spark, owner: list[int], sizes: list[int], version: int) -> DataFrame:
    """One version of the map as rows, to be appended to the stored map."""
    return spark.createDataFrame([(version, slot, shard, sizes[slot]) for slot, shard in enumerate(owner)], MAP_SCHEMA)


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Slotted rows with their shard and their place in it, counted from 0 without gaps.

    Places are numbered inside a part of a virtual slot; the counts of the parts
    (a fixed number of them) are added up to the place where each part starts.
    """
    key = ["virtual_slot", "part"]
    rows = rows.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
    counts = rows.groupBy("shard", *key).count()
    before = W.partitionBy("shard").orderBy(*key).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(W.partitionBy(*key).orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("number", number).join(F.broadcast(starts), key)
        .withColumn("slot", (F.col("start") + F.col("number") - 1).cast("long"))
        .drop("start", "number")
    )


def shard(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS,
          previous: list[int] | None = None, version: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rows with shard and place, and the version of the slot map that put them there."""
    rows = checkpointed(slotted(df, id_col, text_col, slots))
    sizes = slot_sizes(rows, slots)
    owner = rebalanced(previous or first_map(slots, shards), sizes, shards)
    slot_map = next_version(df.sparkSession, owner, sizes, version)
    return placed(rows, slot_map), slot_map


def write_shards(df: DataFrame, slot_map: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS) -> None:
    """The rows themselves, in one folder per shard, beside the map's version.

    A shard's folder is written by many tasks, one virtual slot at least each.
    """
    slot, place = free_name(df.columns, "virtual_slot"), free_name(df.columns, "shard")
    lookup = slot_map.select(F.col("virtual_slot").alias(slot), F.col("shard").alias(place))
    whole = df.withColumn(slot, virtual_slot(df, id_col, text_col, slots)).join(F.broadcast(lookup), slot)
    whole.hint("rebalance", place).write.mode("overwrite").partitionBy(place).parquet(f"{path}/rows")
    slot_map.write.mode("append").partitionBy("version").parquet(f"{path}/map")
