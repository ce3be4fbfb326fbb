"""A whole mapping run as a set of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.operators import similarity
from crossmap.operators.candidates import candidates, reduction_ratio
from crossmap.operators.cleanup import cleanup
from crossmap.operators.pairs import framework_pairs, in_name_order
from crossmap.operators.reports import report_table
from crossmap.operators.sizes import cut
from crossmap.operators.thresholds import resolve_thresholds
from crossmap.operators import verdicts as V

Judge = Callable[[DataFrame], DataFrame]


def judged(batched: DataFrame, requirements: DataFrame, judge: Judge, thresholds: DataFrame) -> DataFrame:
    """First-pass relations: ask, parse, ask again one by one where a batch failed."""
    requests = cut(V.build_requests(batched, requirements))
    found, failed = V.parse_responses(requests, cut(judge(requests)))
    retried = V.retry_batches(failed, batched)
    again = cut(V.build_requests(retried, requirements))
    found_again, _ = V.parse_responses(again, cut(judge(again)))
    first = V.match_verdicts(batched, found)
    second = V.match_verdicts(retried.drop("retry_of", "retry_idx"), found_again)
    return V.classify(first.unionByName(second), thresholds)


def second_opinion(first: DataFrame, requirements: DataFrame, judge: Judge, thresholds: DataFrame) -> DataFrame:
    """Relations with the strong ones judged once more and averaged."""
    batched = cut(V.confirmation_batches(first))
    again = judged(batched, requirements, judge, thresholds)
    return V.confirm(first, again, thresholds)


def judge_candidates(
    found: DataFrame, requirements: DataFrame, judge: Judge,
    thresh_eq: float | None = None, thresh_cov: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(relations, thresholds) of checkpointed candidates, after both passes."""
    thresholds = cut(resolve_thresholds(found, thresh_eq, thresh_cov))
    batched = cut(V.assign_batches(found))
    first = cut(judged(batched, requirements, judge, thresholds))
    return cut(second_opinion(first, requirements, judge, thresholds)), thresholds


def run_mapping(
    requirements: DataFrame,
    vectors: DataFrame | None = None,
    encoder: Callable | None = None,
    judge: Judge | None = None,
    sources: list[str] | None = None,
    targets: list[str] | None = None,
    threshold: float = R.SEMANTIC_THRESHOLD,
    k: int = R.TOP_K,
    thresh_eq: float | None = None,
    thresh_cov: float | None = None,
    min_confidence: float = R.MIN_CONFIDENCE,
    skip_cleanup: bool = False,
    pairs: DataFrame | None = None,
    found: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables of a run over all framework pairs, over given ones, or sources against targets.

    `judge` turns request rows into (framework_A, framework_B, batch_no, raw).
    Without it the run ends after the candidates. `found` are candidates that
    are there already, such as stored ones. What feeds several tables is
    checkpointed.
    """
    sizes = similarity.framework_sizes(requirements)
    if pairs is None:
        pairs = framework_pairs(in_name_order(sizes), sources, targets)
    if found is None:
        found = cut(candidates(requirements, vectors, encoder, threshold=threshold, k=k, pairs=pairs))
    tables = {"pairs": pairs, "candidates": found, "reduction": reduction_ratio(found, requirements, pairs)}
    if judge is None:
        return tables
    related, thresholds = judge_candidates(found, requirements, judge, thresh_eq, thresh_cov)
    kept, removed = (related, None) if skip_cleanup else cleanup(related, min_confidence)
    tables |= {"thresholds": thresholds, "relations": related, "kept": kept, "report": report_table(kept, removed)}
    if removed is not None:
        tables["removed"] = removed
    return tables


def mapping_totals(
    requirements: DataFrame, pairs: DataFrame, found: DataFrame, kept: DataFrame, removed: DataFrame
) -> DataFrame:
    """One row of totals: frameworks, requirements, pairs, matrix cells, candidates, kept, removed."""
    sizes = requirements.groupBy("framework").agg(F.count("*").alias("n"))
    per_pair = pairs.join(
        sizes.select(F.col("framework").alias("framework_A"), F.col("n").alias("n_A")), "framework_A"
    ).join(sizes.select(F.col("framework").alias("framework_B"), F.col("n").alias("n_B")), "framework_B")
    parts = [
        sizes.select(F.lit("frameworks").alias("metric"), F.lit(1).cast("bigint").alias("amount")),
        sizes.select(F.lit("requirements"), "n"),
        per_pair.select(F.lit("pairs"), F.lit(1).cast("bigint")),
        per_pair.select(F.lit("matrix_cells"), F.col("n_A") * F.col("n_B")),
        _counted(found, "candidates"),
        _counted(kept, "kept"),
        _counted(removed, "removed"),
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.union(part)
    return total.groupBy("metric").agg(F.sum("amount").alias("amount"))


def _counted(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n")).select(F.lit(name), "n")
