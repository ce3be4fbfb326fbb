"""Vectors, tiles of vectors, and cosine scores between tiles.

The work is laid out as pairs of tiles of bounded size: a framework with a third
of all rows is just more tiles. Where there are many of them, tiles are made of
vectors that lie near each other, and pairs of tiles that are too far apart for the
threshold are left out (pivots.py). A task multiplies the pairs of tiles that reach
it and gives back the kept cells only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from math import isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions import text, tiles
from crossmap.operators import pivots as V
from crossmap.operators.sizes import TASKS_PER_CORE, broadcast_if_small, busy_partitions
from crossmap.sources.schemas import CELL, GRID, GRID_STRIP, GRID_SUMMARY

cloudpickle.register_pickle_by_value(tiles)

DENSE_ROWS = 4096
TERM_ROWS = 512
FEWEST_ROWS = 128
BYTES_PER_NUMBER = 8
BYTES_PER_LETTER = 4
TILE_BYTES = 1 << 24
BROADCAST_BYTES = 1 << 27
MOST_COPIES = 64
#: Tiles of A that a task holds while the tiles of B that they meet pass by.
HELD_TILES = 4
#: Tiles of the largest framework from which tiles are cut around pivots.
PRUNED_FROM = 8
DIGITS = 12


def embed(requirements: DataFrame, encoder: Callable[[pd.Series], np.ndarray]) -> DataFrame:
    """(framework, pos, embedding) with a pluggable encoder, one batch of texts at a time.

    The encoder is sent to the workers once per task; what it loads lazily is
    loaded once per Python worker. Each requirement is encoded once, whatever
    the number of pairs it takes part in.
    """

    def encode(batches):
        for batch in batches:
            vectors = np.asarray(encoder(batch["content"]), dtype=np.float32)
            yield pd.DataFrame(
                {"framework": batch["framework"], "pos": batch["pos"], "embedding": list(vectors)}
            )

    return requirements.select("framework", "pos", encoding_text().alias("content")).mapInPandas(
        encode, "framework STRING, pos BIGINT, embedding ARRAY<FLOAT>"
    )


def encoding_text(sentence_length: int | None = None) -> Column:
    """The whole text, or with a sentence length only the first sentence of the description."""
    return text.embedding_text(F.col("tags"), F.col("title"), F.col("description"), sentence_length)


def term_vectors(requirements: DataFrame) -> DataFrame:
    """(framework, pos, terms, weight): the words of each requirement, the default encoding."""
    texts = requirements.select("framework", "pos", encoding_text().alias("content"))
    return texts.select(
        "framework", "pos", text.terms(F.col("content")).alias("terms"), F.length("content").alias("weight")
    )


def framework_sizes(rows: DataFrame) -> DataFrame:
    """(framework, n, weight): one short row per framework, read once and kept small.

    `weight` adds up the column of that name, or counts the rows without one.
    """
    weight = F.sum("weight") if "weight" in rows.columns else F.count("*")
    return broadcast_if_small(
        rows.groupBy("framework").agg(F.count("*").alias("n"), weight.alias("weight"))
    )


def _dimension(vectors: DataFrame) -> int:
    first = vectors.select(F.size("embedding").alias("dimension")).first()
    return 1 if first is None else max(first["dimension"], 1)


class Layout(NamedTuple):
    """How frameworks are cut into tiles, and how the tiles meet."""

    counts: DataFrame  # (framework, blocks)
    tiles: int
    fits_broadcast: bool
    rows: int = DENSE_ROWS


def _layout(sizes: DataFrame, rows: int, bytes_per_weight: int) -> Layout:
    """Tiles of at most `rows` rows and a bounded size, small enough to keep all cores busy."""
    parts = busy_partitions(sizes.sparkSession)
    amount = F.col("weight") * bytes_per_weight
    total = sizes.agg(F.sum("n").alias("n"), F.sum(amount).alias("bytes")).first()
    n, size = total["n"] or 0, total["bytes"] or 0
    rows = min(rows, max(FEWEST_ROWS, isqrt(n * n // (2 * parts * TASKS_PER_CORE))))
    blocks = F.ceil(F.greatest(F.col("n") / rows, amount / TILE_BYTES))
    counts = sizes.select("framework", blocks.alias("blocks"))
    rows = max(1, min(rows, TILE_BYTES * n // max(size, 1)))
    return Layout(counts, max(n // rows, size // TILE_BYTES, 1), size <= BROADCAST_BYTES, rows)


def _spread(vectors: DataFrame, counts: DataFrame) -> DataFrame:
    """Positions are spread over the tiles by hash."""
    return vectors.join(counts, "framework").withColumn("block", block_of("pos"))


def block_of(pos: str) -> Column:
    """The tile of a position, of as many as the column `blocks` says."""
    return F.pmod(F.xxhash64(pos), "blocks")


def _tiles(vectors: DataFrame, payload: str) -> DataFrame:
    """(framework, block, rows)"""
    return vectors.groupBy("framework", "block").agg(F.collect_list(F.struct("pos", F.col(payload).alias("payload"))).alias("rows"))


def _side(df: DataFrame, letter: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{name}_{letter}" for name in df.columns})


def _by_tile(work: DataFrame, tiles: int, parts: int) -> DataFrame:
    """The list of tile pairs with those of a tile of A next to each other, in as many runs as keep all cores busy."""
    runs = -(-parts * TASKS_PER_CORE // max(tiles, 1))
    run = F.pmod(F.xxhash64("framework_B", "block_B"), F.lit(runs))
    tile = ["framework_A", "block_A"]
    return work.repartition(parts, *tile, run).sortWithinPartitions(*tile, "framework_B")


def _every_pair(layout: Layout, pairs: DataFrame, parts: int) -> DataFrame:
    """(framework_A, block_A, framework_B, block_B) of all pairs of tiles of all framework pairs."""
    counted = pairs.join(_side(layout.counts, "A"), "framework_A").join(_side(layout.counts, "B"), "framework_B")
    each_a = F.explode(F.sequence(F.lit(0), F.col("blocks_A") - 1)).alias("block_A")
    each_b = F.explode(F.sequence(F.lit(0), F.col("blocks_B") - 1)).alias("block_B")
    work = counted.select("framework_A", "framework_B", "blocks_B", each_a)
    work = work if layout.fits_broadcast else work.repartition(parts)
    return work.select("framework_A", "block_A", "framework_B", each_b)


class Paired(NamedTuple):
    """Tiles and the pairs of them that meet, as rows for a task, and how the task reads them."""

    rows: DataFrame
    read: Callable


def _met(work: DataFrame, blocks: DataFrame, layout: Layout) -> Paired:
    """The pairs of tiles of a list, with the tiles.

    The list carries numbers only. Tiles whose total size is known to be small are broadcast to it.
    Otherwise a task holds some tiles of A, and the tiles of B that they meet pass by, so that
    a tile of B moves once for several pairs.
    """
    parts = busy_partitions(work.sparkSession)
    if layout.fits_broadcast:
        work = _by_tile(work, layout.tiles, parts)
        for letter in "BA":
            work = work.join(F.broadcast(_side(blocks, letter)), [f"framework_{letter}", f"block_{letter}"])
        return Paired(work.select("framework_A", "block_A", "framework_B", "rows_A", "rows_B"), tiles.tile_pairs)
    runs = min(MOST_COPIES, -(-parts * TASKS_PER_CORE * HELD_TILES // layout.tiles))
    held = F.dense_rank().over(Window.partitionBy("framework_A").orderBy("block_A")) - 1
    groups = work.select("framework_A", "block_A").distinct().withColumn("group", F.floor(held / HELD_TILES))
    work = work.join(groups, ["framework_A", "block_A"]).withColumn("run", F.pmod(F.xxhash64("framework_B", "block_B"), F.lit(runs)))
    task = ["framework_A", "group", "run"]
    holds = work.select(*task, "block_A").distinct().join(_side(blocks, "A"), ["framework_A", "block_A"])
    passes = work.groupBy(*task, "framework_B", "block_B").agg(F.collect_list("block_A").alias("partners"))
    passes = passes.join(_side(blocks, "B"), ["framework_B", "block_B"])
    rows = holds.select(*task, F.lit("").alias("framework_B"), F.array("block_A").alias("partners"), F.col("rows_A").alias("rows"), F.lit(0).alias("side")).unionByName(
        passes.select(*task, "framework_B", "partners", F.col("rows_B").alias("rows"), F.lit(1).alias("side")))
    rows = rows.repartition(parts, *task).sortWithinPartitions(*task, "side", "framework_B")
    return Paired(rows, tiles.passing_pairs)


def paired_tiles(vectors: DataFrame, pairs: DataFrame, payload: str, layout: Layout) -> Paired:
    """Every pair of tiles of every framework pair."""
    work = _every_pair(layout, pairs, busy_partitions(vectors.sparkSession))
    return _met(work, _tiles(_spread(vectors, layout.counts), payload), layout)


def _dense_layout(vectors: DataFrame, rows: int, sizes: DataFrame | None) -> tuple[Layout, int]:
    sizes = framework_sizes(vectors) if sizes is None else sizes
    dimension = _dimension(vectors)
    return _layout(sizes.withColumn("weight", F.col("n")), rows, dimension * BYTES_PER_NUMBER), dimension


def dense_blocks(vectors: DataFrame, rows: int = DENSE_ROWS, sizes: DataFrame | None = None) -> tuple[Layout, DataFrame]:
    """The tiles that `similarity_matrix` multiplies, (framework, block, rows), and their layout."""
    layout, _ = _dense_layout(vectors, rows, sizes)
    return layout, _tiles(_spread(vectors, layout.counts), "embedding")


def _dense_pairs(vectors: DataFrame, pairs: DataFrame, rows: int, sizes: DataFrame | None) -> Paired:
    layout, _ = _dense_layout(vectors, rows, sizes)
    return paired_tiles(vectors, pairs, "embedding", layout)


def _near_pairs(vectors: DataFrame, pairs: DataFrame, threshold: float, layout: Layout, dimension: int) -> Paired:
    """Pairs of tiles around pivots that can hold a score from the threshold up."""
    placed, near, pivots = V.tiled(vectors, layout.counts, layout.rows, dimension)
    work = V.tile_pairs(near, pairs, pivots, threshold).filter("kept").drop("kept")
    work = work if layout.fits_broadcast else work.repartition(busy_partitions(vectors.sparkSession))
    return _met(work, _tiles(placed, "embedding"), layout)


def pruned_tiles(vectors: DataFrame, pairs: DataFrame, threshold: float, rows: int = DENSE_ROWS, digits: int = DIGITS, sizes: DataFrame | None = None) -> DataFrame:
    """Pairs of tiles around pivots that are kept and skipped for a threshold, by framework pair."""
    layout, dimension = _dense_layout(vectors, rows, sizes)
    _, near, pivots = V.tiled(vectors, layout.counts, layout.rows, dimension)
    return V.pruning_report(V.tile_pairs(near, pairs, pivots, _least(threshold, digits)))


def _least(threshold: float, digits: int) -> float:
    """The least score that can round to the threshold."""
    return threshold - 10.0**-digits


def cosine_cells(
    vectors: DataFrame, pairs: DataFrame, threshold: float, k: int,
    rows: int = DENSE_ROWS, digits: int = DIGITS, sizes: DataFrame | None = None,
) -> DataFrame:
    """Cells from the threshold up that hold the k best of each row, for (framework, pos, embedding)."""
    best = partial(tiles.dense_best, k=k, digits=digits)
    layout, dimension = _dense_layout(vectors, rows, sizes)
    most = layout.counts.agg(F.max("blocks")).first()[0] or 0
    if most >= PRUNED_FROM and threshold > 0:
        paired = _near_pairs(vectors, pairs, _least(threshold, digits), layout, dimension)
    else:
        paired = paired_tiles(vectors, pairs, "embedding", layout)
    return paired.rows.mapInArrow(tiles.cell_job(paired.read, tiles.dense_tile, best, k, threshold), CELL)


def term_cells(
    vectors: DataFrame, pairs: DataFrame, threshold: float, k: int,
    rows: int = TERM_ROWS, digits: int = DIGITS, sizes: DataFrame | None = None,
) -> DataFrame:
    """The same for term counts, (framework, pos, terms, weight)."""
    sizes = framework_sizes(vectors) if sizes is None else sizes
    paired = paired_tiles(vectors, pairs, "terms", _layout(sizes, rows, BYTES_PER_LETTER))
    best = partial(tiles.term_best, k=k, digits=digits)
    return paired.rows.mapInArrow(tiles.cell_job(paired.read, tiles.term_tile, best, k, threshold), CELL)


def display_cells(vectors: DataFrame, pairs: DataFrame, names: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Every cell as a row, for frameworks thinned out to the size of one tile."""
    counts = names.select("framework", F.lit(1).cast("bigint").alias("blocks"))
    paired = paired_tiles(vectors, pairs, "embedding", Layout(counts, 1, False))
    every = partial(tiles.dense_all, digits=digits)
    return paired.rows.mapInArrow(tiles.cell_job(paired.read, tiles.dense_tile, every), CELL)


def similarity_matrix(
    vectors: DataFrame, pairs: DataFrame, rows: int = DENSE_ROWS, digits: int = DIGITS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The whole matrix of every framework pair as row-major grids, a strip of a pair of tiles each."""
    paired = _dense_pairs(vectors, pairs, rows, sizes)
    return paired.rows.mapInArrow(tiles.grid_job(paired.read, digits), GRID)


def matrix_strips(
    vectors: DataFrame, pairs: DataFrame, rows: int = DENSE_ROWS, digits: int = DIGITS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The range of positions and of scores of every grid of the whole matrices; the cells stay in the task that scores them."""
    paired = _dense_pairs(vectors, pairs, rows, sizes)
    return paired.rows.mapInArrow(tiles.strip_job(paired.read, digits), GRID_STRIP)


def grids_of_tiles(work: DataFrame, blocks: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The grids of listed pairs of tiles (framework_A, block_A, framework_B, block_B), whose tiles are at hand."""
    size = F.size("rows").cast("bigint") * F.size(F.get("rows.payload", F.lit(0))) * BYTES_PER_NUMBER
    total = blocks.agg(F.count("*").alias("tiles"), F.sum(size).alias("bytes")).first()
    counts = blocks.groupBy("framework").agg(F.count("*").alias("blocks"))
    paired = _met(work, blocks, Layout(counts, max(total["tiles"], 1), (total["bytes"] or 0) <= BROADCAST_BYTES))
    return paired.rows.mapInArrow(tiles.grid_job(paired.read, digits), GRID)


def matrix_cells(grids: DataFrame) -> DataFrame:
    """One row per cell of the grids, with the score clipped to [0, 1] for display."""
    width = F.size("pos_B")
    cells = grids.select("*", F.posexplode("scores").alias("_at", "score"))
    return cells.select(
        "framework_A", "framework_B",
        F.get("pos_A", F.floor(F.col("_at") / width).cast("int")).alias("pos_A"),
        F.get("pos_B", F.col("_at") % width).alias("pos_B"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"),
    )


def matrix_summary(
    vectors: DataFrame, pairs: DataFrame, rows: int = DENSE_ROWS, digits: int = DIGITS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Cells, mean and extremes of every whole matrix; tiles are summed up where they are scored."""
    paired = _dense_pairs(vectors, pairs, rows, sizes)
    parts = paired.rows.mapInArrow(tiles.summary_job(paired.read, digits), GRID_SUMMARY)
    return parts.groupBy("framework_A", "framework_B").agg(
        F.sum("cells").alias("cells"),
        (F.sum("total") / F.sum("cells")).alias("mean_score"),
        F.min("low").alias("min_score"),
        F.max("high").alias("max_score"),
    )
