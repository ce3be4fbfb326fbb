"""Size checks before broadcasts, and lineage cuts on shared storage."""

from __future__ import annotations

import re
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
TASKS_PER_CORE = 4


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A small summary as a broadcast table; a larger one stays as it is.

    Meant for summaries with one short row per framework or framework pair. At
    most `max_rows + 1` rows reach the driver; beyond that the caller's join is
    an ordinary shuffled one.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def busy_partitions(spark: SparkSession) -> int:
    """Partitions that keep all cores busy and even, within the shuffle partitions."""
    return min(shuffle_partitions(spark), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def gather(df: DataFrame, *columns: str) -> DataFrame:
    """Rows brought together by columns for a foldered write.

    Small folders get one file; adaptive execution splits a folder that holds
    much of the table over many tasks.
    """
    return df.hint("rebalance", *columns)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small input over all cores; an input with enough partitions is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints.

    Without a configured folder, a local session takes a temporary one; a
    cluster has to name one that all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpointed rows: computed once, kept in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)
