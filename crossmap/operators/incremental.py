"""Only the framework pairs that are not done yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.operators.ordering import PAIR

SETTINGS = ["threshold", "k"]


def with_settings(pairs: DataFrame, threshold: float, k: int) -> DataFrame:
    """Pairs keyed by what their result depends on."""
    return pairs.select(*PAIR, F.lit(float(threshold)).alias("threshold"), F.lit(int(k)).alias("k"))


def contents(requirements: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """(framework, content): a fingerprint of all rows of a framework, whatever their order."""

    def folded(rows: DataFrame) -> DataFrame:
        mark = F.xxhash64(*sorted(name for name in rows.columns if name != "framework"))
        return rows.groupBy("framework").agg(F.xxhash64(F.bit_xor(mark), F.count("*")).alias("content"))

    marks = folded(requirements)
    if vectors is None:
        return marks
    both = marks.join(folded(vectors).withColumnRenamed("content", "_vectors"), "framework", "left")
    return both.select("framework", F.xxhash64("content", "_vectors").alias("content"))


def with_content(pairs: DataFrame, marks: DataFrame, encoding: str = "") -> DataFrame:
    """Pairs with a fingerprint of both frameworks and of the name of the encoding."""
    for letter in "AB":
        pairs = pairs.join(marks.toDF(f"framework_{letter}", f"_content_{letter}"), f"framework_{letter}", "left")
    whole = F.xxhash64("_content_A", "_content_B", F.lit(encoding))
    return pairs.withColumn("content", whole).drop("_content_A", "_content_B")


def incremental(pairs: DataFrame, done: DataFrame | None, force: bool = False, changed: DataFrame | None = None) -> DataFrame:
    """Pairs without a finished result of the same settings; all of them if forced.

    Pairs of frameworks that changed (a column `framework`) count as not finished.
    """
    if force or done is None:
        return pairs
    if changed is not None:
        for name in PAIR:
            done = done.join(changed.select(F.col("framework").alias(name)), name, "left_anti")
    keys = [name for name in (*PAIR, *SETTINGS, "content") if name in pairs.columns and name in done.columns]
    return pairs.join(done.select(*keys).distinct(), keys, "left_anti")

