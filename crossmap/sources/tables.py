"""Requirement tables and versioned result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.functions import text
from crossmap.operators.sizes import gather, spread
from crossmap.sources.schemas import REQUIREMENT

VERSION = "4"


class OutdatedTable(ValueError):
    """The stored rows are of another version."""


def write_requirements(requirements: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Requirement rows, one folder per framework."""
    gather(requirements, "framework").write.mode(mode).partitionBy("framework").format(fmt).save(path)


def read_requirements(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Requirement rows with the defaults for what is missing."""
    rows = spark.read.schema(REQUIREMENT).format(fmt).load(path)
    return rows.withColumns({
        "description": F.coalesce("description", F.lit("")),
        "tags": F.coalesce("tags", F.array().cast("array<string>")),
    })


def write_versioned(
    df: DataFrame, path: str, keys: list[str] | None = None, mode: str = "append",
    version: str = VERSION, fmt: str = "parquet",
) -> None:
    """Rows marked with the version of the logic that made them, foldered by it."""
    stamped = (gather(df, *keys) if keys else df).withColumn("_v", F.lit(version))
    stamped.write.mode(mode).partitionBy("_v", *(keys or [])).format(fmt).save(path)


def read_versioned(spark: SparkSession, path: str, version: str = VERSION, fmt: str = "parquet") -> DataFrame:
    """Rows of one version; a table without versions is accepted as it is."""
    rows = spark.read.format(fmt).load(path)
    if "_v" not in rows.columns:
        return rows
    kept = rows.filter(F.col("_v").isNull() | (F.col("_v").cast("string") == version))
    if kept.isEmpty() and not rows.isEmpty():
        raise OutdatedTable(f"{path} holds no rows of version {version}")
    return kept.drop("_v")


def requirements_from_documents(documents: DataFrame, framework: str = "lang") -> DataFrame:
    """Requirements from (doc_id, text, source): first line as title, the rest as description."""
    first = F.substring_index("text", "\n", 1)
    rest = F.substr("text", F.length(first) + 2)
    title, description = text.title_and_description(first, rest)
    return spread(documents).select(
        F.col(framework).alias("framework"),
        F.col("doc_id").cast("string").alias("id"),
        title.alias("title"),
        description.alias("description"),
        F.array("source").alias("tags"),
        F.col("doc_id").alias("pos"),
    )
