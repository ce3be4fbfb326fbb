"""Tabular exports of relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmap.functions import text
from crossmap.functions.relations import sheet_colour
from crossmap.operators.sizes import gather
from crossmap.operators.verdicts import output_relations
from crossmap.sources.schemas import RELATION_COLUMNS
from crossmap.sources.tables import write_versioned

# Report headings, in order.
HEADINGS = (
    "Framework A", "ID A", "Title A", "Framework B", "ID B", "Title B",
    "Semantic Score", "Coverage A→B", "Coverage B→A", "Confidence", "Relation Type", "Justification",
)
GLOBAL_SHEET, REMOVED_SHEET, PAIR_SHEET = "Global", "Removed", "Mapping Results"


def _sheet(rows: DataFrame, name) -> DataFrame:
    columns = [F.col(source).alias(heading) for source, heading in zip(RELATION_COLUMNS, HEADINGS)]
    return output_relations(rows).select(
        name.alias("sheet"), sheet_colour(F.col("relation_type")).alias("colour"), *columns
    )


def report_table(kept: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Long report: every relation on the sheet of its pair and on the global one.

    A sheet's name is short; pairs whose names would be equal are numbered.
    """
    names = ["Framework A", "Framework B"]
    sheets = _sheet(kept, F.lit(GLOBAL_SHEET))
    pairs = sheets.select(*names).distinct().withColumn("_name", text.sheet_name(*map(F.col, names)))
    nth = F.row_number().over(Window.partitionBy("_name").orderBy(*names))
    numbered = pairs.select(*names, F.when(nth > 1, F.concat_ws(" ", "_name", nth.cast("string"))).otherwise(F.col("_name")).alias("_own"))
    report = sheets.join(numbered, names).withColumn("sheet", F.explode(F.array("_own", "sheet"))).select(sheets.columns)
    return report if removed is None else report.unionByName(_sheet(removed, F.lit(REMOVED_SHEET)))


def pair_report(kept: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Report of a single framework pair: one sheet of results, one of removed rows."""
    report = _sheet(kept, F.lit(PAIR_SHEET))
    return report if removed is None else report.unionByName(_sheet(removed, F.lit(REMOVED_SHEET)))


def write_report(report: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder per sheet."""
    writer = gather(report, "sheet").write.mode(mode).partitionBy("sheet")
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(fmt).save(path)


def write_rows(rows: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Candidates or relations, one folder per framework pair."""
    gathered = gather(rows, "framework_A", "framework_B")
    gathered.write.mode(mode).partitionBy("framework_A", "framework_B").format(fmt).save(path)


def export_relations(relations: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """All relations of a run with their output columns, marked with the version."""
    write_versioned(output_relations(relations), path, mode=mode, fmt=fmt)
