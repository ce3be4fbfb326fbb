"""Packing of token sequences by minimum bin slack.

Every document becomes its token ids and an end mark, cut into pieces of at
most `capacity` tokens only where it is longer. A sequence is filled with the
longest piece left and the fullest combination of other lengths that fits, found by a
subset-sum program over the available lengths on a bitset; the combination is
then removed and the next sequence is filled. Only lengths and their counts
matter for that, so the plan is made from at most `capacity` counts, and a
combination is used as often as its pieces last: the work of planning does not
grow with the number of documents. Spark then numbers the pieces of each length
and looks up the place of each number.

Defined cases: a null or empty text is one piece of length 1, the end mark;
repeated rows are packed as often as they occur; a null identifier is kept; an
empty table gives an empty result; further columns can have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crossmap.llm.bpe import load
from crossmap.llm.common import Words, checkpointed, column, shuffle_partitions, slices, with_fields

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
PLAN_SCHEMA = "length int, first long, last long, each int, sequence long, at int"


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(public_tokenizers.path(vocabulary))
        for part in slices(batches, "text"):
            flat, ends = bpe.encode(Words(part.column("text")))
            firsts = np.concatenate(([0], ends[:-1]))
            rows, numbers, starts, lengths, sums, tokens = [], [], [], [], [], []
            for row, (a, b) in enumerate(zip(firsts.tolist(), ends.tolist())):
                ids = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start:start + capacity]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(len(own))
                    sums.append(zlib.crc32(own))
                    tokens.append(own)
            arrays = [part.column("id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in tokens], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = df.select(column(df, id_col).alias("id"), column(df, text_col).alias("text"))
    schema = with_fields(rows.select("id").schema, "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)
    names = schema.names
    return rows.mapInArrow(cut, schema)


def fullest(left: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of the lengths left that fills the room as far as any can.

    `left` has lengths in falling order with how many there are. Bit s of
    `sums` says that a combination of the lengths seen so far adds up to s; the
    bits that a length adds are kept, to go back from the best sum to its parts.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in left.items():
        if length > room:
            continue
        before, copies, shift = sums, min(count, room // length), 1
        while copies > 0 and not sums >> room & 1:
            take = min(shift, copies)
            sums |= (sums << (length * take)) & mask
            copies, shift = copies - take, shift * 2
        if sums != before:
            steps.append((length, count, before))
        if sums >> room & 1:
            break
    target, parts = sums.bit_length() - 1, []
    for length, count, before in reversed(steps):
        times = 0
        while not before >> target & 1:
            target -= length
            times += 1
        if times:
            parts.append((length, times))
    return parts


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces, as rows (length, first, last, each, sequence, at).

    The pieces numbered first to last (exclusive) of a length go `each` at a time
    to sequence, sequence + 1 and so on, from offset `at` on.
    """
    left = {length: counts[length] for length in sorted(counts, reverse=True) if counts[length]}
    used, rows, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        others = fullest({x: n for x, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        times = dict(others)
        times[longest] = times.get(longest, 0) + 1
        repeats, at = min(left[x] // n for x, n in times.items()), 0
        for length, n in times.items():
            rows.append((length, used[length], used[length] + n * repeats, n, sequence, at))
            at += n * length
            used[length] += n * repeats
            left[length] -= n * repeats
            if not left[length]:
                del left[length]
        sequence += repeats
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset; pieces is expected to be cheap to read twice (checkpointed).

    At most `capacity` counts reach the driver, and the plan that goes back is
    bounded by them too. Pieces of one length are numbered in parts, so that no
    task sorts all pieces of a frequent length.
    """
    spark = cut.sparkSession
    parts = max(1, shuffle_partitions(spark))
    identifier = cut.columns[0]
    order = [c for c in (identifier, "piece", "ids_crc32", "start") if c in cut.columns]
    rows = cut.withColumn("part", F.pmod(F.xxhash64(*(column(cut, c).cast("string") for c in order)), F.lit(parts)).cast("int"))
    counts = rows.groupBy("length", "part").count()
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    totals = {int(n): int(m) for n, m in cut.groupBy("length").count().collect()}
    places = spark.createDataFrame(plan(totals, capacity), PLAN_SCHEMA).withColumnRenamed("length", "planned")
    number = F.row_number().over(W.partitionBy("length", "part").orderBy(*order))
    rows = rows.withColumn("number", number).join(starts, ["length", "part"]).withColumn("number", F.col("before") + F.col("number") - 1)
    inside = (F.col("length") == F.col("planned")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("last"))
    nth = F.col("number") - F.col("first")
    return rows.join(F.broadcast(places), inside).select(
        *(column(rows, c) for c in cut.columns),
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def packed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every row with its place, without the token ids."""
    return pack(checkpointed(pieces(df, id_col, text_col, vocabulary, capacity, end_id)), capacity).withColumnRenamed("id", id_col)


def sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids, starts of the pieces), at most `capacity` ids each."""
    placed = pack(checkpointed(pieces(df, id_col, text_col, vocabulary, capacity, end_id, with_ids=True)), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
