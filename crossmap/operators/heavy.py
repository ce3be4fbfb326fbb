"""Joins of many rows with the one row of their key, where a few keys hold most of the rows.

A mergeable summary of frequent items (Misra and Gries: a bounded number of counters, which are lowered together when
they run out) finds every key that more than a share of the rows has. Exactly these keys are split: their rows are dealt
over parts, and the one row on the other side is there once for each part. Keys are summed up as 64-bit hashes; two
keys of the same hash would be split together, which changes no result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmap.operators.sizes import busy_partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Counters of a summary: keys of more than one in so many rows are found. Tasks that merge summaries before the driver does.
COUNTERS, MERGED_BY = 256, 16
MOST_PARTS = 1024


def lowered(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` counters of those of equal keys added up: all lose as much as the first one that there is no room for."""
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, counts, minlength=len(keys)).astype(np.int64)
    if len(keys) > most:
        counts = counts - np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _summary(most: int):
    """Arrow task that summarises (key, count) rows."""
    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy(zero_copy_only=False)))
            counts = np.concatenate((counts, batch.column("n").to_numpy(zero_copy_only=False)))
            keys, counts = lowered(keys, counts, most)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["key", "n"])

    return run


def heavy_keys(rows: DataFrame, keys: list[str], counters: int = COUNTERS) -> list[tuple[int, int]]:
    """(hash of the key, rows at least) of keys, among them every key with more than one in `counters` of the rows."""
    hashed = rows.select(F.xxhash64(*keys).alias("key"), F.lit(1).cast("bigint").alias("n"))
    parts = hashed.mapInArrow(_summary(counters), "key bigint, n bigint").repartition(MERGED_BY).mapInArrow(_summary(counters), "key bigint, n bigint")
    found = parts.toPandas()
    merged = lowered(found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64), counters)
    return sorted(zip(*(x.tolist() for x in merged)))


def _dealt(rows: DataFrame) -> Column:
    """A number that differs between rows of one key."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType.typeName() != "map"))


def join_one(rows: DataFrame, one: DataFrame, keys: list[str], how: str = "inner", counters: int = COUNTERS) -> DataFrame:
    """An inner or left join of rows with a table that has one row for a key; keys that many rows have are split."""
    spark = rows.sparkSession
    found = heavy_keys(rows, keys, counters)
    room = max(1, sum(n for _, n in found) // (4 * busy_partitions(spark)))
    split = [(key, min(MOST_PARTS, -(-n // room))) for key, n in found if n > room]
    if not split:
        return rows.join(one, keys, how)
    hot = F.broadcast(spark.createDataFrame(split, "_hash bigint, _parts int"))
    left = rows.withColumn("_row", _dealt(rows)).withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")
    left = left.withColumn("_part", F.pmod("_row", F.coalesce("_parts", F.lit(1))).cast("int")).drop("_hash", "_parts", "_row")
    right = one.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_hash", "_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def join_lookup(rows: DataFrame, one: DataFrame, keys: list[str]) -> DataFrame:
    """The same inner join, left to adaptive execution where that splits hot keys by itself."""
    conf = rows.sparkSession.conf
    adaptive = all(conf.get(name, "true") == "true" for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))
    return rows.join(one, keys) if adaptive else join_one(rows, one, keys)
