"""Named loaders: each takes (spark, path) and gives requirement rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crossmap.operators.flatten import flatten_requirements
from crossmap.sources.dimension import framework_dim
from crossmap.sources.documents import decode_documents, read_documents
from crossmap.sources.tables import read_requirements, requirements_from_documents


def read_frameworks(
    spark: SparkSession, paths: str | list[str], name=None, config: DataFrame | None = None
) -> DataFrame:
    """Requirement rows of framework documents."""
    nodes = decode_documents(read_documents(spark, paths, name))
    return flatten_requirements(nodes, framework_dim(spark, config))


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    return requirements_from_documents(spark.read.parquet(path))


LOADERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "generic": read_frameworks,
    "requirements": read_requirements,
    "documents": load_documents,
}


def loader(name: str) -> Callable[[SparkSession, str], DataFrame]:
    if name not in LOADERS:
        raise KeyError(f"unknown loader {name!r}; known: {sorted(LOADERS)}")
    return LOADERS[name]
