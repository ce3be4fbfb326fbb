"""What the reader of a mapping looks at: filters, histograms, samples, review rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.functions import text
from crossmap.operators.ordering import PAIR, candidate_index, position_index
from crossmap.operators.sizes import broadcast_if_small
from crossmap.operators import similarity

MAX_LABELS = 80
BINS = 30
COLOUR_FLOOR = 0.05


def search_candidates(candidates: DataFrame, min_score: float = 0.0, pattern: str = "") -> DataFrame:
    """Candidates from a score up whose titles match a pattern, letter case ignored."""
    found = candidates.filter(F.col("semantic_score") >= min_score)
    if not pattern:
        return found
    match = F.col("title_A").rlike(f"(?iu){pattern}") | F.col("title_B").rlike(f"(?iu){pattern}")
    return found.filter(F.coalesce(match, F.lit(False)))


def filter_relations(relations: DataFrame, types: list[str] | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Relations of some types, from a confidence up."""
    found = relations if types is None else relations.filter(F.col("relation_type").isin(types))
    return found.filter(F.col("confidence") >= min_confidence)


def by_score(rows: DataFrame, score: str = "semantic_score") -> DataFrame:
    """Rows in falling order of a score."""
    return rows.orderBy(F.desc(score), *PAIR, "id_A", "id_B")


def column_floors(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The lowest value of each column, where a display filter starts."""
    return rows.agg(*(F.min(name).alias(name) for name in columns))


def score_histogram(candidates: DataFrame, bins: int = BINS, score: str = "semantic_score") -> DataFrame:
    """(framework_A, framework_B, bin, low, high, n): equal-width bins, empty ones included."""
    edges = candidates.groupBy(*PAIR).agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        *PAIR,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    edges = broadcast_if_small(edges)
    place = F.least(F.floor((F.col(score) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counted = candidates.join(edges, PAIR).groupBy(*PAIR, place.alias("bin")).agg(F.count("*").alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    return every.join(counted, [*PAIR, "bin"], "left").select(
        *PAIR, "bin",
        F.round(F.col("lo") + F.col("bin") * width, 6).alias("low"),
        F.round(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def thin_out(vectors: DataFrame, sizes: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Every n-th requirement of a framework, so that fewer than twice `max_labels` stay.

    Only positions are numbered; the few that stay are then looked up.
    """
    step = F.greatest(F.lit(1), F.floor(F.col("n") / max_labels)).alias("step")
    placed = position_index(vectors.select("framework", "pos"), "_index")
    placed = placed.join(sizes.select("framework", step), "framework")
    picked = broadcast_if_small(placed.filter(F.col("_index") % F.col("step") == 0).select("framework", "pos"))
    return vectors.join(picked, ["framework", "pos"], "left_semi")


def sample_matrix(
    vectors: DataFrame, pairs: DataFrame, max_labels: int = MAX_LABELS, sizes: DataFrame | None = None
) -> DataFrame:
    """The displayed matrix: rows and columns are thinned out before anything is scored."""
    sizes = similarity.framework_sizes(vectors) if sizes is None else sizes
    cells = similarity.display_cells(thin_out(vectors, sizes, max_labels), pairs, sizes)
    return cells.withColumnRenamed("semantic_score", "score")


def matrix_floor(cells: DataFrame, point: float = COLOUR_FLOOR) -> DataFrame:
    """Low percentile of each displayed matrix, where its colours start.

    A displayed matrix is limited in size, so the built-in aggregate is enough.
    """
    return cells.groupBy(*PAIR).agg(F.percentile("score", F.lit(point)).alias("floor"))


def review_rows(kept: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Numbered review rows: escaped texts, colour, score label and whether they are checked.

    The number runs over all framework pairs: a pair starts where the one
    before it ends.
    """
    sizes = kept.groupBy(*PAIR).agg(F.count("*").alias("_n"))
    starts = broadcast_if_small(_pair_starts(sizes))
    placed = candidate_index(kept, "_index").join(starts, PAIR)
    rows = placed.select(
        (F.col("_start") + F.col("_index")).alias("row"),
        *(text.escape_html(F.col(name)).alias(name) for name in ("id_A", "title_A")),
        text.escape_html(F.col("relation_type")).alias("relation_type"),
        R.review_colour(F.col("relation_type")).alias("colour"),
        text.score_label(F.col("semantic_score"), F.col("coverage_A_to_B"), F.col("coverage_B_to_A")).alias("label"),
        *(text.escape_html(F.col(name)).alias(name) for name in ("id_B", "title_B")),
        text.escape_html(F.coalesce("justification", F.lit(""))).alias("justification"),
    )
    if state is None:
        return rows.withColumn("checked", F.lit(False))
    marks = state.select("row", F.col("checked").alias("_checked"))
    return rows.join(marks, "row", "left").withColumn("checked", F.coalesce("_checked", F.lit(False))).drop("_checked")


def _pair_starts(sizes: DataFrame) -> DataFrame:
    """Where each pair starts: after all pairs of earlier first frameworks, and the earlier ones of its own.

    Only one row per first framework goes through a window without parts.
    """
    before = (Window.unboundedPreceding, -1)
    firsts = sizes.groupBy("framework_A").agg(F.sum("_n").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("framework_A").rowsBetween(*before))
    firsts = firsts.select("framework_A", F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    own = F.sum("_n").over(Window.partitionBy("framework_A").orderBy("framework_B").rowsBetween(*before))
    placed = sizes.withColumn("_own", F.coalesce(own, F.lit(0))).join(firsts, "framework_A")
    return placed.select(*PAIR, (F.col("_earlier") + F.col("_own")).alias("_start"))


def review_progress(rows: DataFrame) -> DataFrame:
    """Total, checked, remaining and percentage of review rows."""
    total, done = F.count("*"), F.count_if("checked")
    percent = F.when(total > 0, F.round(100.0 * done / total, 0)).otherwise(0.0)
    return rows.agg(
        total.alias("total"), done.alias("checked"), (total - done).alias("remaining"), percent.cast("int").alias("percent")
    )
