"""One run from documents to stored and exported results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.operators import reports, similarity, validate
from crossmap.operators.cleanup import cleanup
from crossmap.operators.pairs import framework_pairs, in_name_order
from crossmap.operators.sizes import cut
from crossmap.operators.verdicts import output_relations
from crossmap.plans import stored
from crossmap.plans.mapping import Judge
from crossmap.sources.dimension import by_key, expected_counts, framework_dim
from crossmap.sources.registry import loader
from crossmap.sources.tables import read_requirements, write_requirements

PAIR = ["framework_A", "framework_B"]


class Totals:
    """Counts of rows that are gathered while the rows are written."""

    def __init__(self):
        self.watched: list[tuple[str, Observation]] = []
        self.known: dict[str, int] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(name)
        self.watched.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(metric, amount); read after the rows have been written."""
        found = self.known | {name: seen.get["n"] for name, seen in self.watched}
        return spark.createDataFrame(list(found.items()), "metric string, amount bigint")


def ingested(spark: SparkSession, path: str, kind: str = "generic", config: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(requirements, tables of the count check) of a named loader; frameworks without expected counts are not checked."""
    load = loader(kind)
    requirements = cut(load(spark, path, config=config) if kind == "generic" else load(spark, path))
    if config is None:
        return requirements, {}
    keys = framework_dim(spark, config).select("key", "survey_key")
    sections, report = validate.validate_counts(requirements, by_key(expected_counts(config), keys))
    return requirements, {"sections": sections, "validation": report}


def run(
    spark: SparkSession,
    path: str,
    folder: str,
    kind: str = "generic",
    config: DataFrame | None = None,
    vectors: DataFrame | None = None,
    encoder: Callable | None = None,
    judge: Judge | None = None,
    sources: list[str] | None = None,
    targets: list[str] | None = None,
    threshold: float = R.SEMANTIC_THRESHOLD,
    k: int = R.TOP_K,
    min_confidence: float = R.MIN_CONFIDENCE,
    force: bool = False,
    encoding: str = "",
    digits: int = similarity.DIGITS,
) -> dict[str, DataFrame]:
    """Reads, checks counts, maps what is not stored yet, judges, cleans up, exports and counts.

    A single framework is stored and checked, and makes no pairs. Without a judge the run
    ends with the candidates. With `force`, stored pairs are made again. All tables but those of the check lie in
    `folder`; a later run over the same requirements and settings reads them.
    """
    requirements, tables = ingested(spark, path, kind, config)
    totals = Totals()
    write_requirements(totals.watch(requirements, "requirements"), f"{folder}/requirements")
    requirements = read_requirements(spark, f"{folder}/requirements")
    tables["requirements"] = requirements
    sizes = similarity.framework_sizes(requirements.select("framework"))
    pairs = framework_pairs(in_name_order(sizes), sources, targets)
    cells = pairs
    for letter in "AB":
        cells = cells.join(sizes.select(F.col("framework").alias(f"framework_{letter}"), F.col("n").alias(f"n_{letter}")), f"framework_{letter}")
    n, n_cells = cells.agg(F.count("*"), F.coalesce(F.sum(F.col("n_A") * F.col("n_B")), F.lit(0))).first()
    totals.known |= {"frameworks": sizes.count(), "pairs": n, "matrix_cells": n_cells}
    if n:
        found = stored.update_candidates(requirements, folder, vectors, encoder, sources, targets, threshold, k, force, encoding=encoding, digits=digits)
        found = found.join(pairs.select(*PAIR), PAIR, "left_semi")
        reports.write_rows(totals.watch(found, "candidates"), f"{folder}/export/candidates", "parquet")
        tables["candidates"] = spark.read.schema(found.schema).parquet(f"{folder}/export/candidates")
    if n and judge is not None:
        related = stored.update_relations(requirements, folder, judge, threshold, k, force=force)
        kept, removed = cleanup(related.join(pairs.select(*PAIR), PAIR, "left_semi"), min_confidence)
        for name, rows in (("kept", kept), ("removed", removed)):
            rows = totals.watch(output_relations(rows), name)
            rows.write.mode("overwrite").parquet(f"{folder}/export/{name}")
            tables[name] = spark.read.parquet(f"{folder}/export/{name}")
        tables["report"] = reports.report_table(tables["kept"], tables["removed"])
        reports.write_report(tables["report"], f"{folder}/export/report", "parquet")
    return tables | {"pairs": pairs, "totals": totals.table(spark)}
