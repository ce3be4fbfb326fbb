"""Running numbers and exact quantiles of groups that may hold most of the rows.

A double has a 64-bit image that rises with it. The image's digits of 16 bits cut any group
into steps of at most 65,536 values, however close its values lie together, so that no window
grows with the group. Digits are only taken as far as steps are still crowded.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from crossmap.operators.sizes import cut

#: Bits of the image that are left below each digit.
SHIFTS = (48, 32, 16, 0)
#: Different values of a step that are sorted by one task.
SORTED = 1 << 16
#: Groups and steps whose state is held by the driver between rounds; more are kept in the shared folder.
HELD = 100_000
POSITION_SPAN = 1 << 16
PAIR = ["framework_A", "framework_B"]


def _running_start(by: list[str], order: list[str], amount: str) -> Column:
    """Sum of `amount` over the rows that come before in the group."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


def with_image(df: DataFrame, value: str, name: str = "_image") -> DataFrame:
    """The rows with the 64-bit image of a double column: as whole numbers, images have the order of the doubles, NaN last."""
    columns = df.columns

    def add(batches):
        for batch in batches:
            bits = (batch.column(value).to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
            image = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(image)], [*columns, name])

    return df.mapInArrow(add, StructType([*df.schema.fields, StructField(name, LongType())]))


def _digits(round_: int) -> Column:
    return F.shiftright("_image", SHIFTS[round_])


def _part_starts(sizes: DataFrame, by: list[str], part: list[str]) -> DataFrame:
    """(by, part, _start) from (by, part, _image, _size): how many rows of the group come before each part.

    Parts are ordered by their image, then by the `part` columns. Steps of a digit get
    their start from sums of steps; crowded steps are cut by the next digit.
    """
    keys, level = list(by), 0
    parts = sizes.withColumn("_start", F.lit(0).cast("bigint"))
    while True:
        step = f"_step{level}"
        parts = parts.withColumn(step, _digits(level))
        sums = parts.groupBy(*keys, step).agg(F.sum("_size").alias("_sum"), F.count("*").alias("_parts"))
        starts = sums.select(*keys, step, _running_start(keys, [step], "_sum").alias("_before"))
        crowded = level + 1 < len(SHIFTS) and (sums.agg(F.max("_parts")).first()[0] or 0) > SORTED
        parts = parts.join(starts, [*keys, step]).withColumn("_start", F.col("_start") + F.col("_before")).drop("_before")
        keys.append(step)
        if not crowded:
            break
        level += 1
    # What is left of a step is one part for each value, or for each span of the positions of equal values.
    inside = _running_start(keys, ["_image", *part], "_size")
    return parts.select(*by, *part, "_image", (F.col("_start") + inside).alias("_start"))


def position_step(pos: str) -> Column:
    """Spans of consecutive positions."""
    return F.floor(F.col(pos) / POSITION_SPAN)


def position_index(df: DataFrame, name: str = "index") -> DataFrame:
    """0-based place of each requirement in its framework, by position: spans are counted, and only a span is sorted."""
    rows = df.withColumn("_span", position_step("pos"))
    sizes = rows.groupBy("framework", "_span").agg(F.count("*").alias("_size"))
    starts = sizes.select("framework", "_span", _running_start(["framework"], ["_span"], "_size").alias("_start"))
    place = F.row_number().over(Window.partitionBy("framework", "_span").orderBy("pos")) - 1
    return rows.withColumn("_place", place).join(starts, ["framework", "_span"]).withColumn(name, F.col("_start") + F.col("_place")).drop("_start", "_place", "_span")


def candidate_index(df: DataFrame, name: str = "index", by: list[str] = PAIR) -> DataFrame:
    """Place of each candidate in its framework pair: score down, then position and rank.

    Rows are counted by score and span of positions first, so that ties shrink; only the rows of one
    span of one score are ever sorted together.
    """
    part = ["_key", "_span"]
    rows = df.withColumn("_key", -F.col("semantic_score")).withColumn("_span", position_step("pos_A"))
    sizes = cut(with_image(rows.groupBy(*by, *part).agg(F.count("*").alias("_size")), "_key"))
    starts = _part_starts(sizes, by, part).drop("_image")
    place = F.row_number().over(Window.partitionBy(*by, *part).orderBy("pos_A", "rank")) - 1
    return (
        rows.withColumn("_place", place)
        .join(starts, [*by, *part])
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_start", "_place", *part)
    )


def exact_quantiles(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Count, mean and exact quantiles per group, with linear interpolation between neighbours.

    Values are counted first, so ties collapse. Histograms of the digits of the values' images tell
    which steps hold the wanted ranks; a round zooms into those that are still crowded, and what is left, at most
    SORTED values a step, is sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_value")).agg(F.count("*").alias("_n"))
    counts = with_image(counts, "_value")
    places = {}
    for name, point in points.items():
        rank = F.lit(point) * (F.col("n") - 1)
        places[f"_low_{name}"], places[f"_high_{name}"] = F.floor(rank), F.ceil(rank)

    def holds(rank: str, start: str, size: str) -> Column:
        return F.col(rank).between(F.col(start), F.col(start) + F.col(size) - 1)

    def wanted(steps: DataFrame) -> DataFrame:
        return steps.withColumns(places).filter(reduce(or_, (holds(rank, "_before", "_size") for rank in places)))

    sums = [F.sum("_n").alias("_size"), F.count("*").alias("_values")]
    steps = counts.groupBy(*by, _digits(0).alias("_step")).agg(*sums, F.sum(F.col("_value") * F.col("_n")).alias("_sum"))
    group = Window.partitionBy(*by)
    steps = steps.select(
        *by, "_step", "_size", "_values", _running_start(by, ["_step"], "_size").alias("_before"),
        F.sum("_size").over(group).alias("n"), (F.sum("_sum").over(group) / F.sum("_size").over(group)).alias("mean"),
    )
    state, level = _held(wanted(steps)), 0
    if level + 1 < len(SHIFTS) and _crowded(state):
        counts = cut(counts)
    while level + 1 < len(SHIFTS) and _crowded(state):
        known = state.select(*by, "_step", F.col("_before").alias("_base"), "n", "mean")
        inner = counts.withColumn("_step", _digits(level)).join(known, [*by, "_step"])
        finer = inner.groupBy(*by, "_step", _digits(level + 1).alias("_finer")).agg(*sums, *(F.max(x).alias(x) for x in ("_base", "n", "mean")))
        before = F.col("_base") + _running_start([*by, "_step"], ["_finer"], "_size")
        finer = finer.withColumn("_before", before).drop("_base", "_step").withColumnRenamed("_finer", "_step")
        state, level = _held(wanted(finer)), level + 1
    kept = counts.withColumn("_step", _digits(level)).join(state.drop("_size", "_values"), [*by, "_step"])
    kept = kept.withColumn("_first", F.col("_before") + _running_start([*by, "_step"], ["_image"], "_n"))
    found = kept.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max("mean").alias("mean"),
        *(F.max(F.when(holds(rank, "_first", "_n"), F.col("_value"))).alias(rank) for rank in places),
    )
    return found.select(*by, "n", "mean", *(_between(name, point).alias(name) for name, point in points.items()))


def _held(state: DataFrame) -> DataFrame:
    """The state between two rounds: a small one as a table of its own, a large one in the shared folder."""
    head = state.limit(HELD + 1).toArrow()
    return cut(state) if head.num_rows > HELD else state.sparkSession.createDataFrame(head, state.schema)


def _crowded(state: DataFrame) -> bool:
    return (state.agg(F.max("_values")).first()[0] or 0) > SORTED


def _between(name: str, point: float) -> Column:
    """Value at a rank between two neighbours; the middle one is their mean."""
    low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
    if point == 0.5:
        return (low + high) / 2
    place = F.lit(point) * (F.col("n") - 1)
    share = place - F.floor(place)
    from_low, from_high = low + (high - low) * share, high - (high - low) * (1 - share)
    return F.when(share >= 0.5, from_high).otherwise(from_low)
