"""Score distributions and the relation thresholds that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.operators.ordering import PAIR, exact_quantiles

QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9}


def score_distribution(candidates: DataFrame, score: str = "semantic_score") -> DataFrame:
    """Count, mean, median, quartiles and 90th percentile of every framework pair."""
    spread = exact_quantiles(candidates, PAIR, score, QUANTILES)
    names = ("mean", "median", "q25", "q75", "p90")
    return spread.select(*PAIR, "n", *(R.exact_round(F.col(name), 4).alias(name) for name in names))


def adaptive_thresholds(
    candidates: DataFrame,
    base_eq: float = R.THRESHOLD_EQUIVALENCE,
    base_cov: float = R.THRESHOLD_COVERAGE,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Thresholds of every framework pair, shifted by the median of its scores.

    With the list of pairs, a pair without candidates gets the bases unshifted.
    """
    shifts = score_distribution(candidates).withColumn("shift", R.threshold_delta(F.col("median")))
    found = shifts.select(
        *PAIR, "n", "mean", "median", "q25", "q75", "p90",
        R.exact_round(F.col("shift"), 4).alias("delta"),
        R.shifted(base_eq, F.col("shift"), R.EQUIVALENCE_RANGE).alias("thresh_eq"),
        R.shifted(base_cov, F.col("shift"), R.COVERAGE_RANGE).alias("thresh_cov"),
    )
    if pairs is None:
        return found
    return pairs.join(found, PAIR, "left").withColumns({
        "n": F.coalesce("n", F.lit(0)),
        "thresh_eq": F.coalesce("thresh_eq", F.lit(base_eq)),
        "thresh_cov": F.coalesce("thresh_cov", F.lit(base_cov)),
    })


def resolve_thresholds(
    candidates: DataFrame, eq: float | None = None, cov: float | None = None, pairs: DataFrame | None = None
) -> DataFrame:
    """Given thresholds if both are given; else adapted ones, on the bases that are given."""
    if eq is not None and cov is not None:
        known = candidates.select(*PAIR).distinct() if pairs is None else pairs
        return known.select(*PAIR, F.lit(eq).alias("thresh_eq"), F.lit(cov).alias("thresh_cov"))
    base_eq = R.THRESHOLD_EQUIVALENCE if eq is None else eq
    base_cov = R.THRESHOLD_COVERAGE if cov is None else cov
    found = adaptive_thresholds(candidates, base_eq, base_cov, pairs)
    return found.select(*PAIR, "thresh_eq", "thresh_cov")
