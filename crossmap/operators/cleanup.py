"""Kept and removed relations, and how the types are spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions.relations import MIN_CONFIDENCE, RELATION_TYPES


def cleanup(relations: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): a relation goes without a link or without enough confidence."""
    drop = (F.col("relation_type") == "no_link") | (F.col("confidence") < min_confidence)
    return relations.filter(~drop), relations.filter(drop)


def relation_counts(relations: DataFrame) -> DataFrame:
    """(relation_type, n) with a row for every type."""
    types = relations.sparkSession.createDataFrame([(kind,) for kind in RELATION_TYPES], "relation_type STRING")
    counted = relations.groupBy("relation_type").agg(F.count("*").alias("n"))
    return types.join(counted, "relation_type", "left").select("relation_type", F.coalesce("n", F.lit(0)).alias("n"))


def relation_share(relations: DataFrame) -> DataFrame:
    """(relation_type, n, percent) of the types that occur."""
    counted = relations.groupBy("relation_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.select("relation_type", "n", F.round(100.0 * F.col("n") / total, 4).alias("percent"))
