"""Tiles of vectors that lie near each other, and which pairs of them can hold a score from a threshold up.

A bounded number of pivots, far from each other, is chosen from a bounded sample. Each vector belongs to the
nearest of the pivots that its framework uses, and the vectors of a pivot are cut into rings by their
angle to it; a crowded ring is split by hash. Of two tiles only the pivots and the
rings' angles have to be known: by the triangle inequality on the sphere, no two of their vectors are closer than
the angle that is left between the rings. A pair of tiles whose bound lies below the threshold never enters the
list of work. The result is that of all pairs of tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.operators.sizes import broadcast_if_small

#: Pivots at most, and bounds of the sample they are chosen from.
PIVOTS, SAMPLE_ROWS, SAMPLE_BYTES = 64, 4096, 1 << 25
#: Steps of the angle in which vectors are counted, per radian.
STEPS = 64
#: Room for roundings of an angle.
SLACK = 1e-6
PAIR = ["framework_A", "framework_B"]


def choose(vectors: DataFrame, n: int, dimension: int) -> np.ndarray:
    """At most n unit vectors, each the farthest of a sample from those before it, so that the first ones cover it coarsely."""
    rows = max(n, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dimension)))
    sample = vectors.select("embedding", F.xxhash64("framework", "pos").alias("_order")).orderBy("_order").limit(rows)
    found = np.array([row[0] for row in sample.select("embedding").collect()], np.float64).reshape(-1, dimension)
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    unit = (found / np.where(norms > 0, norms, 1))[norms[:, 0] > 0]
    if not len(unit):
        return np.zeros((1, dimension))
    places, nearest = [0], unit @ unit[0]
    while len(places) < n and nearest.min() < 1 - 1e-9:
        places.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[places[-1]])
    return unit[places]


def assigned(vectors: DataFrame, blocks: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with `pivot`, the nearest of as many pivots as their framework has blocks, and the `angle` to it."""
    columns = [*vectors.columns, "pivot", "angle"]

    def nearest(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = flat.reshape(batch.num_rows, -1)
            norms = np.linalg.norm(rows, axis=1, keepdims=True)
            near = (rows / np.where(norms > 0, norms, 1)) @ pivots.T
            used = batch.column("blocks").to_numpy(zero_copy_only=False)
            near[np.arange(len(pivots))[None, :] >= used[:, None]] = -2
            best = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(best)), best], -1, 1))
            kept = [batch.column(name) for name in columns[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(best.astype(np.int32)), pa.array(angle)], columns)

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in vectors.schema.fields)}, pivot int, angle double"
    return vectors.join(blocks.select("framework", "blocks"), "framework").mapInArrow(nearest, schema)


def _step():
    return F.floor(F.col("angle") * STEPS).cast("int")


def rings(rows: DataFrame, most: int) -> DataFrame:
    """(framework, pivot, step, first, splits, low, high): where the vectors of a step of a pivot's angles go.

    Steps are counted, so that no vector moves; steps next to each other share a tile until it has `most` rows,
    and a step with more is split over several tiles.
    """
    counts = rows.groupBy("framework", "pivot", _step().alias("step")).agg(
        F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("framework", "pivot").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select("framework", "pivot", "step", F.floor(before / most).alias("first"), F.greatest(F.lit(1), F.ceil(F.col("n") / most)).alias("splits"), "low", "high")


def ring_tiles(steps: DataFrame) -> DataFrame:
    """(framework, pivot, block, low, high): the tiles and the angles of their vectors to the pivot."""
    each = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("splits") - 1)).alias("ring")
    tiles = steps.select("framework", "pivot", "low", "high", each).groupBy("framework", "pivot", "ring").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return tiles.select("framework", "pivot", _block(F.col("ring")).alias("block"), "low", "high")


def _block(ring):
    return F.col("pivot").cast("bigint") * (1 << 32) + ring


def with_blocks(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """The vectors with the block that their angle and a hash of their position give."""
    placed = rows.withColumn("step", _step()).join(steps.select("framework", "pivot", "step", "first", "splits"), ["framework", "pivot", "step"])
    return placed.withColumn("block", _block(F.col("first") + F.pmod(F.xxhash64("pos"), "splits")))


def tile_pairs(tiles: DataFrame, pairs: DataFrame, pivots: np.ndarray, threshold: float) -> DataFrame:
    """(framework_A, block_A, framework_B, block_B, kept) of every pair of tiles; kept: whether a score can reach the threshold."""
    spark = tiles.sparkSession
    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    angles = spark.createDataFrame([(i, j, float(x)) for i, row in enumerate(between) for j, x in enumerate(row)], "pivot_A int, pivot_B int, between double")
    sides = [tiles.withColumnsRenamed({name: f"{name}_{letter}" for name in tiles.columns}) for letter in "AB"]
    work = pairs.select(*PAIR).join(sides[0], "framework_A").join(sides[1], "framework_B").join(F.broadcast(angles), ["pivot_A", "pivot_B"])
    apart = F.greatest(
        F.lit(0.0), F.col("between") - F.col("high_A") - F.col("high_B"),
        F.col("low_A") - F.col("between") - F.col("high_B"), F.col("low_B") - F.col("between") - F.col("high_A"),
    )
    # Below a threshold of 0 a vector of zeros, which has no angle, could be kept.
    kept = F.lit(True) if threshold <= 0 else F.cos(F.greatest(F.lit(0.0), apart - SLACK)) >= threshold
    return work.select("framework_A", "block_A", "framework_B", "block_B", kept.alias("kept"))


def pruning_report(work: DataFrame) -> DataFrame:
    """Pairs of tiles that are kept and skipped, by framework pair."""
    return work.groupBy(*PAIR).agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped"))


def tiled(vectors: DataFrame, counts: DataFrame, most: int, dimension: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(vectors with blocks, tiles, pivots) for frameworks that are to have about counts.blocks tiles of at most about `most` rows."""
    most_blocks = counts.agg(F.max("blocks")).first()[0] or 1
    pivots = choose(vectors, min(PIVOTS, most_blocks), dimension)
    rows = assigned(vectors, counts, pivots)
    steps = broadcast_if_small(rings(rows, most))
    return with_blocks(rows, steps), ring_tiles(steps), pivots
