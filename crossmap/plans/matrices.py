"""Whole similarity matrices kept beside the candidates of their run.

The cells of a matrix grow with the product of both frameworks, but all of them are the product of the tiles of vectors that they
were made from. So these factors are stored, once for all pairs of an update, and every matrix as its list of strips, one row for a
strip of a pair of tiles, with the range of positions and of scores of each, for which an update goes through every cell. Strips lie in order of
framework pair and position, in small row groups, so that a reader of one pair, of some positions or of high scores skips the
groups that hold none of them; the tiles of the strips that are left are multiplied to the same grids again. Beside it lies the displayed
matrix, which is small. A list, written last, names the run of the candidates that each matrix belongs to: a matrix is read only
while that is the last run of its pair. What an update that died has left behind is in no list. A table of another version is refused.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.functions.relations import SEMANTIC_THRESHOLD, TOP_K
from crossmap.operators import similarity, views
from crossmap.operators.ordering import PAIR
from crossmap.operators.sizes import broadcast_if_small, cut
from crossmap.plans.stored import CANDIDATES, finished_pairs
from crossmap.sources.tables import VERSION, read_versioned

GRIDS, TILES, SHOWN, DONE = "matrix_strips", "matrix_tiles", "matrix_displayed", "matrix_listed"
#: Bytes of a row group: a few tiles, or some thousand strips.
GROUP_BYTES = 4 << 20
STATS = ["low_A", "high_A", "low_B", "high_B", "low", "high"]
TILE_PAIR = ["framework_A", "block_A", "framework_B", "block_B"]


def _last_runs(spark: SparkSession, folder: str, threshold: float, k: int) -> DataFrame:
    done = finished_pairs(spark, folder, CANDIDATES)
    if done is None:
        raise ValueError(f"{folder} holds no candidates; run update_candidates first")
    settings = (F.col("threshold") == float(threshold)) & (F.col("k") == int(k))
    return broadcast_if_small(done.filter(settings).select(*PAIR, "run"))


def _write(rows: DataFrame, path: str, order: list[str]) -> None:
    stamped = rows.withColumn("_v", F.lit(VERSION)).repartitionByRange(*order).sortWithinPartitions(*order)
    # A tile can be megabytes, so the size of a group is looked at after a few rows, not after the usual hundred.
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.page.size": 1 << 18, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 8}
    stamped.write.mode("append").partitionBy("_v").options(**sizes).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_versioned(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _listed(spark: SparkSession, folder: str, threshold: float, k: int) -> DataFrame | None:
    """(framework_A, framework_B, written, digits) of the matrices that belong to the last run of their pair."""
    done = _stored(spark, f"{folder}/{DONE}")
    if done is None:
        return None
    last = done.join(_last_runs(spark, folder, threshold, k), [*PAIR, "run"], "left_semi")
    return broadcast_if_small(last.groupBy(*PAIR).agg(F.max("written").alias("written"), F.max_by("digits", "written").alias("digits")))


def _ends() -> list[Column]:
    """The statistics of a strip."""
    values = [F.array_min("pos_A"), F.array_max("pos_A"), F.array_min("pos_B"), F.array_max("pos_B"), F.array_min("scores"), F.array_max("scores")]
    return [value.alias(name) for name, value in zip(STATS, values)]


def _placed(strips: DataFrame, counts: DataFrame, letter: str, written: Column) -> DataFrame:
    """Strips with the name of the stored tile on one side."""
    side = counts.select(F.col("framework").alias(f"framework_{letter}"), "blocks")
    return strips.join(side, f"framework_{letter}").withColumn(f"block_{letter}", _name(similarity.block_of(f"first_{letter}"), written)).drop("blocks", f"first_{letter}")


def _name(block: Column, written: Column) -> Column:
    return F.concat_ws("-", written, block)


def update_matrices(vectors: DataFrame, folder: str, threshold: float = SEMANTIC_THRESHOLD, k: int = TOP_K, rows: int = similarity.DENSE_ROWS, digits: int = similarity.DIGITS) -> int:
    """Computes and stores the matrices of finished pairs that have none of their last run; gives the number of these pairs."""
    spark = vectors.sparkSession
    todo, listed = _last_runs(spark, folder, threshold, k), _listed(spark, folder, threshold, k)
    if listed is not None:
        todo = broadcast_if_small(todo.join(listed, PAIR, "left_anti"))
    n = todo.count()
    if not n:
        return 0
    pairs, sizes = todo.select(*PAIR), similarity.framework_sizes(vectors)
    written = F.lit(datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f"))
    layout, blocks = similarity.dense_blocks(vectors, rows, sizes)
    used = broadcast_if_small(pairs.select(F.col("framework_A").alias("framework")).union(pairs.select("framework_B")).distinct())
    kept = blocks.join(used, "framework", "left_semi").select("framework", _name(F.col("block"), written).alias("block"), "rows", written.alias("written"))
    _write(kept, f"{folder}/{TILES}", ["framework", "block"])
    strips = similarity.matrix_strips(vectors, pairs, rows, digits, sizes)
    for letter in "AB":
        strips = _placed(strips, layout.counts, letter, written)
    _write(cut(strips.withColumn("written", written)), f"{folder}/{GRIDS}", [*PAIR, "low_A", "low_B"])
    _write(views.sample_matrix(vectors, pairs, sizes=sizes).withColumn("written", written), f"{folder}/{SHOWN}", [*PAIR, "pos_A"])
    _write(todo.withColumns({"written": written, "digits": F.lit(digits)}), f"{folder}/{DONE}", PAIR)
    return n


def _valid(spark: SparkSession, folder: str, name: str, threshold: float, k: int) -> DataFrame:
    listed = _listed(spark, folder, threshold, k)
    if listed is None:
        raise ValueError(f"{folder} holds no matrices; run update_matrices first")
    return read_versioned(spark, f"{folder}/{name}").join(listed, [*PAIR, "written"])


def stored_grids(
    spark: SparkSession, folder: str, threshold: float = SEMANTIC_THRESHOLD, k: int = TOP_K,
    pair: tuple[str, str] | None = None, positions: tuple[int, int] | None = None, least: float | None = None,
) -> DataFrame:
    """Grids of valid matrices: of one framework pair, with positions of A in a range, with a score from `least` up.

    The conditions hold for strips; a strip that meets them is given whole.
    """
    strips = _valid(spark, folder, GRIDS, threshold, k)
    tiles = read_versioned(spark, f"{folder}/{TILES}")
    if pair is not None:
        tiles = tiles.filter(F.col("framework").isin(*pair))
    conditions = list(_wanted(pair, positions, least))
    for condition in conditions:
        strips = strips.filter(condition)
    found = []
    for digits in [row["digits"] for row in _listed(spark, folder, threshold, k).select("digits").distinct().collect()] or [similarity.DIGITS]:
        own = strips.filter(F.col("digits") == digits).select(*TILE_PAIR).distinct()
        found.append(similarity.grids_of_tiles(own, tiles.select("framework", "block", "rows"), digits))
    # A pair of tiles has more strips than the wanted ones.
    grids = reduce(DataFrame.unionByName, found).select("*", *_ends())
    for condition in conditions:
        grids = grids.filter(condition)
    return grids


def _wanted(pair, positions, least):
    if pair is not None:
        yield (F.col("framework_A") == pair[0]) & (F.col("framework_B") == pair[1])
    if positions is not None:
        yield (F.col("high_A") >= positions[0]) & (F.col("low_A") <= positions[1])
    if least is not None:
        yield F.col("high") >= least


def stored_sample(spark: SparkSession, folder: str, threshold: float = SEMANTIC_THRESHOLD, k: int = TOP_K) -> DataFrame:
    """The displayed matrices (framework_A, framework_B, pos_A, pos_B, score) of valid ones."""
    return _valid(spark, folder, SHOWN, threshold, k).drop("written", "digits")
