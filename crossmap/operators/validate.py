"""Parsed requirement counts against expected counts, and selector expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions import text

SHOWN_IN_REPORT = 20
SHOWN_IN_LOG = 3


def section_counts(requirements: DataFrame, expected: DataFrame) -> DataFrame:
    """(framework, section, parsed): which section each requirement counts for.

    Requirements are counted by the shape of their identifier first, so the
    joins that look for an expected section see one row per distinct key.
    """
    parts, first, two = text.section_keys(F.col("id"))
    shape = F.when(parts >= 3, 3).otherwise(parts)
    whole = F.when(parts == 1, F.col("id")).otherwise(first)
    longer = F.when(parts >= 3, two).otherwise(whole)
    shaped = requirements.select("framework", shape.alias("parts"), whole.alias("one"), longer.alias("two"))
    counted = shaped.groupBy("framework", "parts", "one", "two").agg(F.count("*").alias("n"))
    known = expected.select("framework", "section").distinct()
    has_two = known.select("framework", F.col("section").alias("two"), F.lit(True).alias("has_two"))
    has_one = known.select("framework", F.col("section").alias("one"), F.lit(True).alias("has_one"))
    section = F.when(
        (F.col("parts") == 3) & (F.col("has_two").isNotNull() | F.col("has_one").isNull()), F.col("two")
    ).otherwise(F.col("one"))
    return (
        counted.join(has_two, ["framework", "two"], "left")
        .join(has_one, ["framework", "one"], "left")
        .groupBy("framework", section.alias("section"))
        .agg(F.sum("n").alias("parsed"))
    )


def validate_counts(requirements: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections with both counts and a status, and a report row per registered framework.

    The sections table is the full list of what is missing or over; the report
    has their numbers.
    """
    parsed = section_counts(requirements, expected)
    registered = expected.select("framework").distinct()
    missing = (F.col("expected") > 0) & (F.col("parsed") < F.col("expected"))
    over = F.col("parsed") > F.col("expected")
    sections = (
        expected.join(parsed, ["framework", "section"], "full_outer")
        .select("framework", "section", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("parsed", F.lit(0)).alias("parsed"))
        .join(registered, "framework", "left_semi")
        .withColumn("status", F.when(missing, "missing").when(over, "over").otherwise("equal"))
    )
    report = sections.groupBy("framework").agg(
        F.sum("expected").alias("total_expected"),
        F.sum("parsed").alias("total_parsed"),
        F.count_if(F.col("status") == "missing").alias("missing"),
        F.count_if(F.col("status") == "over").alias("over"),
    )
    return sections, report.withColumns({
        "ok": F.col("total_expected") == F.col("total_parsed"),
        "difference": F.col("total_parsed") - F.col("total_expected"),
    })


def shown_sections(sections: DataFrame, limit: int | None = SHOWN_IN_REPORT) -> DataFrame:
    """(framework, missing_sections, over_sections): the first sections of either kind in text order, or all without a limit."""
    first = sections.filter("status <> 'equal'")
    if limit is not None:
        order = Window.partitionBy("framework", "status").orderBy("section")
        first = first.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= limit)
    listed = {
        kind: F.sort_array(F.collect_list(F.when(F.col("status") == kind, F.col("section"))))
        for kind in ("missing", "over")
    }
    return (
        first.groupBy("framework")
        .agg(*(column.alias(f"{kind}_sections") for kind, column in listed.items()))
    )


def expand_na(selectors: DataFrame, sections: DataFrame) -> DataFrame:
    """(framework, option, item) of selectors like `9.3`, `10.*` or `3.2-4`.

    `selectors` has (framework, option, selector); `sections` has (framework,
    section, subsection, expected). A star or a range is limited by the size of
    its group; a single item is taken as written.
    """
    parts = F.split("selector", r"\.")
    nested = F.size(parts) > 2
    pieces = selectors.select(
        "framework", "option", "selector",
        F.element_at(parts, 1).alias("section"),
        F.when(nested, F.element_at(parts, 2)).otherwise("").alias("subsection"),
        F.when(nested, F.element_at(parts, 3)).otherwise(F.element_at(parts, 2)).alias("picked"),
    )
    many = pieces.filter((F.col("picked") == "*") | F.col("picked").contains("-"))
    single = pieces.filter(~((F.col("picked") == "*") | F.col("picked").contains("-")))
    sizes = sections.select("framework", "section", F.coalesce("subsection", F.lit("")).alias("subsection"), "expected")
    star = F.col("picked") == "*"
    low = F.when(star, 1).otherwise(F.split_part("picked", F.lit("-"), F.lit(1)).try_cast("int"))
    high = F.when(star, F.col("expected")).otherwise(F.split_part("picked", F.lit("-"), F.lit(2)).try_cast("int"))
    ranged = (
        many.join(sizes, ["framework", "section", "subsection"])
        .withColumns({"low": low, "high": F.least(high, F.col("expected"))})
        .filter("low <= high")
        .withColumn("number", F.explode(F.sequence("low", "high")))
    )
    group = F.when(F.col("subsection") != "", F.concat_ws(".", "section", "subsection")).otherwise(F.col("section"))
    items = ranged.select("framework", "option", F.concat_ws(".", group, "number").alias("item"))
    return items.unionByName(single.select("framework", "option", F.col("selector").alias("item")))


def config_selectors(config: DataFrame) -> DataFrame:
    """(framework, option, selector) of a configuration."""
    options = config.select(F.col("survey_key").alias("framework"), F.explode("not_applicable").alias("option", "list"))
    return options.select("framework", "option", F.explode("list").alias("selector"))
