"""Item nodes of framework documents to requirement rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.functions import text
from crossmap.operators.sizes import broadcast_if_small


def section_start(framework_known, prefix, overwrite, section):
    """Identifier that a section hands down when it has no prefix of its own."""
    number = F.when(section.rlike(r"^\d+$"), F.expr("try_cast(section AS BIGINT)").cast("string"))
    renamed = F.coalesce(F.try_element_at(overwrite, number).cast("string"), number, section)
    return F.when(framework_known, F.concat(F.coalesce(prefix, F.lit("")), renamed)).otherwise(section)


def inherited_id(start):
    """Identifier prefix after walking down the node path."""
    first = F.element_at("node_prefixes", 1)
    steps = F.arrays_zip(
        F.col("node_nums").alias("num"),
        F.slice("node_prefixes", 2, F.greatest(F.size("node_prefixes") - 1, F.lit(0))).alias("own"),
    )

    def step(path, node):
        return F.when(node["own"] != "", node["own"]).otherwise(
            F.concat(path, F.lit("."), node["num"].cast("string"))
        )

    return F.aggregate(steps, F.when(first != "", first).otherwise(start), step)


def flatten_requirements(nodes: DataFrame, dim: DataFrame) -> DataFrame:
    """Requirement rows; `pos` is the place among the document's items, as the decoder has numbered them."""
    known = broadcast_if_small(dim.select(F.col("key").alias("framework"), "section_id_prefix", "overwrite"))
    start = section_start(
        F.col("section_id_prefix").isNotNull(), F.col("section_id_prefix"), F.col("overwrite"), F.col("section")
    )
    title, description = text.title_and_description(F.col("label"), F.col("desc"))
    return (
        nodes.join(known, "framework", "left")
        .select(
            "framework",
            text.requirement_id(F.col("prefix"), inherited_id(start), F.col("n")).alias("id"),
            title.alias("title"),
            description.alias("description"),
            F.filter("node_titles", lambda t: t != "").alias("tags"),
            "pos",
        )
        .filter("pos >= 0")
        .select("framework", "id", "title", "description", "tags", "pos")
    )
