"""Framework documents: discovery, reading and decoding into item nodes."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.functions import text
from crossmap.operators.sizes import broadcast_if_small
from crossmap.sources import decode
from crossmap.sources.schemas import NODE

cloudpickle.register_pickle_by_value(decode)


def _files(spark: SparkSession, paths: str | list[str], recursive: bool, pattern: str | None = None) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", pattern or ("*.yaml" if recursive else "*.{yaml,yml}"))
        .load(paths)
    )


def list_frameworks(spark: SparkSession, root: str, recursive: bool = True, name: Column | None = None, pattern: str | None = None) -> DataFrame:
    """(framework, path) of every document below a folder; contents stay unread."""
    name = text.framework_name(F.col("path")) if name is None else name
    return latest(_files(spark, root, recursive, pattern).select(name.alias("framework"), "path"))


def latest(files: DataFrame) -> DataFrame:
    """One path per framework name; the last one in path order counts."""
    return files.groupBy("framework").agg(F.max("path").alias("path"))


def framework_counts(frameworks: DataFrame) -> DataFrame:
    """How many frameworks there are and how many pairs they make."""
    n = F.count("*")
    return frameworks.agg(
        n.alias("frameworks"), (n * (n - 1) / 2).cast("bigint").alias("pairs")
    )


def read_documents(
    spark: SparkSession, paths: str | list[str], name: Column | None = None, recursive: bool = False, pattern: str | None = None
) -> DataFrame:
    """(framework, path, content), one row per framework document.

    The choice between files of the same name looks at the paths only.
    """
    name = text.framework_name(F.col("path")) if name is None else name
    files = _files(spark, paths, recursive, pattern).withColumn("framework", name)
    chosen = broadcast_if_small(latest(files.select("framework", "path")))
    content = F.decode("content", "UTF-8").alias("content")
    return files.select("framework", "path", content).join(chosen, ["framework", "path"], "left_semi")


def decode_documents(documents: DataFrame) -> DataFrame:
    """Item nodes of (framework, path, content) rows."""
    return documents.select("framework", "path", "content").mapInPandas(decode.decode_batches, NODE)
