"""Which frameworks are mapped onto which."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.operators.sizes import broadcast_if_small


def in_name_order(names: DataFrame) -> DataFrame:
    """(framework, fw_ord) for a table of framework names; the name is the load order."""
    return names.select("framework", F.col("framework").alias("fw_ord"))


def in_load_order(documents: DataFrame) -> DataFrame:
    """(framework, fw_ord) of listed documents, in path order."""
    return documents.select("framework", F.col("path").alias("fw_ord"))


def frameworks_of(requirements: DataFrame) -> DataFrame:
    """(framework, fw_ord) of every framework that has requirements."""
    return in_name_order(broadcast_if_small(requirements.select("framework").distinct()))


def framework_pairs(
    frameworks: DataFrame, sources: list[str] | None = None, targets: list[str] | None = None
) -> DataFrame:
    """(framework_A, framework_B): all pairs in load order, or sources against targets.

    With both lists given, a pair is written in name order and appears once.
    """
    if sources is None or targets is None:
        return _pairs_in_order(frameworks)
    return (
        display_pairs(frameworks, sources, targets)
        .select(
            F.least("framework_A", "framework_B").alias("framework_A"),
            F.greatest("framework_A", "framework_B").alias("framework_B"),
        )
        .distinct()
    )


def _pairs_in_order(frameworks: DataFrame) -> DataFrame:
    numbered = frameworks.select(
        "framework",
        F.row_number().over(Window.orderBy("fw_ord")).alias("place"),
        F.count("*").over(Window.partitionBy()).alias("last"),
    )
    later = F.explode(F.sequence(F.col("place") + 1, F.col("last").cast("int"))).alias("place")
    first = numbered.filter("place < last").select(F.col("framework").alias("framework_A"), later)
    second = numbered.select("place", F.col("framework").alias("framework_B"))
    return first.join(second, "place").select("framework_A", "framework_B")


def display_pairs(frameworks: DataFrame, sources: list[str], targets: list[str]) -> DataFrame:
    """Every source with every other target; both directions stay."""
    known = frameworks.select("framework")
    others = F.array(*(F.lit(name) for name in sorted(set(targets))))
    return (
        known.filter(F.col("framework").isin(sources))
        .select(F.col("framework").alias("framework_A"), F.explode(others).alias("framework_B"))
        .filter("framework_A <> framework_B")
        .join(known.select(F.col("framework").alias("framework_B")), "framework_B", "left_semi")
        .select("framework_A", "framework_B")
    )


def role_of_frameworks(frameworks: DataFrame, sources: list[str], targets: list[str]) -> DataFrame:
    """(framework, role) of the selected frameworks: new, existing or both."""
    source, target = F.col("framework").isin(sources), F.col("framework").isin(targets)
    role = F.when(source & target, "both").when(source, "new").otherwise("existing")
    return frameworks.filter(source | target).select("framework", role.alias("role"))
