"""Candidate pairs: the best targets of every requirement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions.relations import SEMANTIC_THRESHOLD, TOP_K
from crossmap.operators import similarity, term_join
from crossmap.operators.pairs import framework_pairs, in_name_order
from crossmap.operators.sizes import broadcast_if_small

PAIR = ["framework_A", "framework_B"]


def select_candidates(scores: DataFrame, threshold: float = SEMANTIC_THRESHOLD, k: int = TOP_K) -> DataFrame:
    """The k best targets of each requirement and framework pair, from the threshold up.

    The filter stands below the rank: both cut from the top, so the order does
    not matter for the result, but fewer rows reach the shuffle.
    """
    best = Window.partitionBy(*PAIR, "pos_A").orderBy(F.desc("semantic_score"), "pos_B")
    return (
        scores.filter(F.col("semantic_score") >= threshold)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )


def name_candidates(selected: DataFrame, requirements: DataFrame, titles: bool = True) -> DataFrame:
    """Candidates with identifier and title of both requirements, or with their identifiers only."""
    named = requirements.select("framework", "pos", "id", *(["title"] if titles else []))
    for letter in ("A", "B"):
        side = named.withColumnsRenamed({name: f"{name}_{letter}" for name in named.columns})
        selected = selected.join(side, [f"framework_{letter}", f"pos_{letter}"])
    return selected


def dedupe_first(candidates: DataFrame) -> DataFrame:
    """One row per pair of identifiers: the first in position and rank order.

    An aggregate, so that repeats of a hot identifier shrink before the shuffle.
    """
    keys = [*PAIR, "id_A", "id_B"]
    rest = [name for name in candidates.columns if name not in keys and name not in ("pos_A", "rank")]
    first = F.min(F.struct("pos_A", "rank", *rest)).alias("first")
    return candidates.groupBy(*keys).agg(first).select(*keys, "first.*").select(*candidates.columns)


def lookup_last(requirements: DataFrame) -> DataFrame:
    """One row per identifier of a framework: the last one in the document."""
    keys = ["framework", "id"]
    rest = [name for name in requirements.columns if name not in keys and name != "pos"]
    last = F.max(F.struct("pos", *rest)).alias("last")
    return requirements.groupBy(*keys).agg(last).select(*keys, "last.*").select(*requirements.columns)


def candidates(
    requirements: DataFrame,
    vectors: DataFrame | None = None,
    encoder: Callable | None = None,
    sources: list[str] | None = None,
    targets: list[str] | None = None,
    threshold: float = SEMANTIC_THRESHOLD,
    k: int = TOP_K,
    pairs: DataFrame | None = None,
    digits: int = similarity.DIGITS,
    titles: bool = True,
) -> DataFrame:
    """Candidate pairs of all framework pairs, or of the given sources and targets.

    Scores come from the given vectors, else from the encoder, else from the
    words of the requirement texts. Titles can be whole paragraphs; without them, rows that travel are short.
    """
    if pairs is not None:
        named = [pairs.select(F.col(name).alias("framework")) for name in PAIR]
        needed = broadcast_if_small(named[0].union(named[1]).distinct())
        requirements = requirements.join(needed, "framework", "left_semi")
        vectors = vectors if vectors is None else vectors.join(needed, "framework", "left_semi")
    elif sources is not None and targets is not None:
        needed = F.col("framework").isin([*sources, *targets])
        requirements = requirements.filter(needed)
        vectors = vectors if vectors is None else vectors.filter(needed)
    if vectors is None and encoder is not None:
        vectors = similarity.embed(requirements, encoder)
    words = similarity.term_vectors(requirements) if vectors is None else None
    sizes = similarity.framework_sizes(requirements.select("framework"))
    if pairs is None:
        pairs = framework_pairs(in_name_order(sizes), sources, targets)
    if words is None:
        cells = similarity.cosine_cells(vectors, pairs, threshold, k, digits=digits, sizes=sizes)
    elif threshold > 0:
        cells = term_join.term_cells(words, pairs, threshold, k, sizes, digits=digits)
    else:
        cells = similarity.term_cells(words, pairs, threshold, k, digits=digits)
    return dedupe_first(name_candidates(select_candidates(cells, threshold, k), requirements, titles))


def reduction_ratio(found: DataFrame, requirements: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates, possible pairs and their percentage for every framework pair."""
    sizes = requirements.groupBy("framework").agg(F.count("*").alias("n"))
    kept = found.groupBy(*PAIR).agg(F.count("*").alias("kept"))
    side_a = sizes.select(F.col("framework").alias("framework_A"), F.col("n").alias("n_A"))
    side_b = sizes.select(F.col("framework").alias("framework_B"), F.col("n").alias("n_B"))
    total = F.coalesce(F.col("n_A") * F.col("n_B"), F.lit(0))
    kept_n = F.coalesce("kept", F.lit(0))
    return (
        pairs.join(side_a, "framework_A", "left").join(side_b, "framework_B", "left").join(kept, PAIR, "left")
        .select(
            *PAIR, kept_n.alias("kept"), total.alias("total"),
            F.round(100.0 * kept_n / F.greatest(total, F.lit(1)), 4).alias("percent"),
        )
    )
