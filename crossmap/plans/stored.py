"""Candidates and relations in versioned tables that later runs extend.

Beside each table lies a list of finished framework pairs with their settings.
Every row carries its run. A pair counts as finished only by its row in that
list, which is written last, and only rows of that run are read; what a run
that died has left behind is ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.functions.relations import SEMANTIC_THRESHOLD, TOP_K
from crossmap.operators import similarity
from crossmap.operators.candidates import candidates
from crossmap.operators.incremental import SETTINGS, contents, incremental, with_content, with_settings
from crossmap.operators.ordering import PAIR
from crossmap.operators.pairs import framework_pairs, in_name_order
from crossmap.operators.sizes import broadcast_if_small, cut
from crossmap.plans.mapping import Judge, judge_candidates
from crossmap.sources.tables import read_versioned, write_versioned

CANDIDATES, RELATIONS = "candidates", "relations"


def finished_pairs(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """(framework_A, framework_B, threshold, k, run, content) with the last run of each pair."""
    try:
        pairs = read_versioned(spark, f"{folder}/{name}_done")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = [F.max("run").alias("run")]
    if "content" in pairs.columns:
        last.append(F.max_by("content", "run").alias("content"))
    return pairs.groupBy(*PAIR, *SETTINGS).agg(*last)


def stored(
    spark: SparkSession, folder: str, name: str, threshold: float = SEMANTIC_THRESHOLD, k: int = TOP_K
) -> DataFrame | None:
    """Rows of all finished pairs with these settings."""
    done = finished_pairs(spark, folder, name)
    if done is None:
        return None
    settings = (F.col("threshold") == float(threshold)) & (F.col("k") == int(k))
    last = broadcast_if_small(done.filter(settings).drop("content"))
    rows = read_versioned(spark, f"{folder}/{name}").filter(settings)
    return rows.join(last, [*PAIR, *SETTINGS, "run"], "left_semi").drop(*SETTINGS, "run")


def _append(rows: DataFrame, pairs: DataFrame, folder: str, name: str, threshold: float, k: int) -> None:
    run = datetime.now(timezone.utc).strftime("run-%Y%m%dT%H%M%S%f")
    marks = {"threshold": F.lit(float(threshold)), "k": F.lit(int(k)), "run": F.lit(run)}
    write_versioned(rows.withColumns(marks), f"{folder}/{name}", keys=["run"])
    write_versioned(pairs.withColumns(marks), f"{folder}/{name}_done")


def update_candidates(
    requirements: DataFrame,
    folder: str,
    vectors: DataFrame | None = None,
    encoder: Callable | None = None,
    sources: list[str] | None = None,
    targets: list[str] | None = None,
    threshold: float = SEMANTIC_THRESHOLD,
    k: int = TOP_K,
    force: bool = False,
    changed: DataFrame | None = None,
    encoding: str = "",
    digits: int = similarity.DIGITS,
) -> DataFrame:
    """Computes the pairs that are not finished yet, stores them, gives all candidates.

    A pair counts as finished only with the same requirements on both sides, the same
    vectors where they are given, and the same `encoding`, a name for the encoder in use.
    """
    spark = requirements.sparkSession
    sizes = similarity.framework_sizes(requirements)
    pairs = with_settings(framework_pairs(in_name_order(sizes), sources, targets), threshold, k)
    pairs = with_content(pairs, contents(requirements, vectors), encoding)
    todo = broadcast_if_small(incremental(pairs, finished_pairs(spark, folder, CANDIDATES), force, changed))
    if not todo.isEmpty():
        fresh = candidates(requirements, vectors, encoder, threshold=threshold, k=k, pairs=todo.select(*PAIR), digits=digits)
        _append(fresh, todo, folder, CANDIDATES, threshold, k)
    return stored(spark, folder, CANDIDATES, threshold, k)


def update_relations(
    requirements: DataFrame,
    folder: str,
    judge: Judge,
    threshold: float = SEMANTIC_THRESHOLD,
    k: int = TOP_K,
    thresh_eq: float | None = None,
    thresh_cov: float | None = None,
    force: bool = False,
) -> DataFrame:
    """Judges the stored candidates of pairs without relations, stores them, gives all relations."""
    spark = requirements.sparkSession
    found = stored(spark, folder, CANDIDATES, threshold, k)
    if found is None:
        raise ValueError(f"{folder} holds no candidates; run update_candidates first")
    ready = finished_pairs(spark, folder, CANDIDATES).drop("run")
    ready = ready.filter((F.col("threshold") == float(threshold)) & (F.col("k") == int(k)))
    todo = broadcast_if_small(incremental(ready, finished_pairs(spark, folder, RELATIONS), force))
    if not todo.isEmpty():
        open_rows = cut(found.join(todo.select(*PAIR), PAIR, "left_semi"))
        related, _ = judge_candidates(open_rows, requirements, judge, thresh_eq, thresh_cov)
        _append(related, todo, folder, RELATIONS, threshold, k)
    return stored(spark, folder, RELATIONS, threshold, k)
