"""Stored lists of best targets, brought up to date after some rows have changed.

A row's list holds its k best targets of one framework from the threshold up. After a change

- rows that changed or are new are scored against all targets;
- targets that changed or are new are scored against all rows, and what is good enough joins the lists;
- a list that has lost a member, and was full, may have to take in a target that was never stored: its row is
  scored against all targets, unless enough new members reach at least the score of the list's old last one;
- everything else stays. A list that was not full held all targets from the threshold up, so nothing else can enter.

The result is that of a whole new run; only the cells named are scored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmap.operators.candidates import PAIR, select_candidates
from crossmap.operators.sizes import broadcast_if_small, cut

#: (vectors, pairs) to cells, for a table of rows in any framework.
Score = Callable[[DataFrame, DataFrame], DataFrame]
ROW = ["framework", "pos"]
LIST = [*PAIR, "pos_A"]


def row_marks(vectors: DataFrame) -> DataFrame:
    """(framework, pos, mark): a fingerprint of the content of each row."""
    return vectors.select(*ROW, F.xxhash64(*sorted(name for name in vectors.columns if name not in ROW)).alias("mark"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(framework, pos, gone, fresh) from two tables of marks: rows whose old content is gone, and rows with new content."""
    old, new = before.withColumnRenamed("mark", "_old"), after.withColumnRenamed("mark", "_new")
    both = old.join(new, ROW, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select(*ROW, F.col("_old").isNotNull().alias("gone"), F.col("_new").isNotNull().alias("fresh"))


def _name(*columns: str) -> Column:
    """A framework name that stands for a side of the repair."""
    return F.to_json(F.struct(*columns))


def _scored(score: Score, asking: DataFrame, targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cells between rows that ask, in the frameworks `asks`, and targets, in the frameworks `target`; pairs has both names."""
    rows = asking.withColumnRenamed("asks", "framework").unionByName(targets.withColumnRenamed("target", "framework"))
    named = pairs.select(F.col("asks").alias("framework_A"), F.col("target").alias("framework_B"))
    cells = score(rows, named).withColumnsRenamed({"framework_A": "asks", "framework_B": "target"})
    return cells.join(broadcast_if_small(pairs), ["asks", "target"]).select(*PAIR, "pos_A", "pos_B", "semantic_score")


class Repaired:
    """The lists after a change, and how many cells were scored for them, by framework pair."""

    def __init__(self, selected: DataFrame, counts: DataFrame):
        self.selected, self.counts = selected, counts


def repaired(selected: DataFrame, vectors: DataFrame, changed: DataFrame, pairs: DataFrame, score: Score, threshold: float, k: int) -> Repaired:
    """Lists (framework_A, framework_B, pos_A, pos_B, semantic_score, rank) of rows before a change, repaired for the rows after it."""
    pairs = pairs.select(*PAIR)
    changed = cut(changed)
    gone, fresh = (changed.filter(name).select(*ROW) for name in ("gone", "fresh"))
    content = [name for name in vectors.columns if name not in ROW]
    fresh_rows = vectors.join(fresh, ROW, "left_semi")

    def side(rows: DataFrame, letter: str) -> DataFrame:
        return rows.withColumnsRenamed({name: f"{name}_{letter}" for name in ROW})

    # Targets with new content meet all rows, those with new content too.
    targets = pairs.select(_name("framework_B").alias("target"), _name("framework_A").alias("asks"), *PAIR)
    asking = vectors.withColumn("asks", _name(F.col("framework").alias("framework_A"))).select("asks", "pos", *content)
    new = fresh_rows.withColumn("target", F.concat(F.lit("+"), _name(F.col("framework").alias("framework_B")))).select("target", "pos", *content)
    met = targets.withColumn("target", F.concat(F.lit("+"), "target"))
    joining = cut(_scored(score, asking, new, met))

    # What is left of the lists of unchanged rows, and which lists are short of members.
    old = selected.join(side(gone, "A"), ["framework_A", "pos_A"], "left_anti").join(pairs, PAIR, "left_semi")
    lost = old.join(side(gone, "B").withColumn("_lost", F.lit(True)), ["framework_B", "pos_B"], "left")
    last = lost.groupBy(*LIST).agg(F.count("*").alias("_size"), F.count("_lost").alias("_lost"), F.min("semantic_score").alias("_last"))
    short = last.filter((F.col("_size") == k) & (F.col("_lost") > 0))
    regained = joining.join(short, LIST).filter(F.col("semantic_score") > F.col("_last")).groupBy(*LIST).agg(F.count("*").alias("_new"))
    short = short.join(regained, LIST, "left").filter(F.coalesce("_new", F.lit(0)) < F.col("_lost")).select(*LIST)
    whole = side(fresh, "A").join(pairs, "framework_A").select(*LIST)
    rescored = cut(short.unionByName(whole).distinct())

    # Rows that have to see all targets ask in the name of their framework pair.
    again = rescored.join(side(vectors, "A"), ["framework_A", "pos_A"]).select(_name(*PAIR).alias("asks"), F.col("pos_A").alias("pos"), *(F.col(f"{c}_A").alias(c) if c in ROW else F.col(c) for c in content))
    every = vectors.withColumn("target", _name(F.col("framework").alias("framework_B"))).select("target", "pos", *content)
    meets = pairs.select(_name("framework_B").alias("target"), _name(*PAIR).alias("asks"), *PAIR)
    asked = broadcast_if_small(rescored.select(*PAIR).distinct())
    meets = meets.join(asked, PAIR, "left_semi")
    cells = _scored(score, again, every.join(broadcast_if_small(meets.select("target").distinct()), "target", "left_semi"), meets)

    kept = lost.filter("_lost IS NULL").select(*LIST, "pos_B", "semantic_score").unionByName(joining.select(*LIST, "pos_B", "semantic_score"))
    kept = kept.join(rescored, LIST, "left_anti").unionByName(cells.select(*LIST, "pos_B", "semantic_score"))
    return Repaired(select_candidates(kept, threshold, k), _counts(vectors, fresh, rescored, pairs))


def _counts(vectors: DataFrame, fresh: DataFrame, rescored: DataFrame, pairs: DataFrame) -> DataFrame:
    """(framework_A, framework_B, rescored, total): cells that a repair scores, and those of a whole run."""
    def sizes(rows: DataFrame, letter: str, name: str) -> DataFrame:
        return rows.groupBy(F.col("framework").alias(f"framework_{letter}")).agg(F.count("*").alias(name))

    whole = rescored.groupBy(*PAIR).agg(F.count("*").alias("_whole"))
    found = pairs.join(sizes(vectors, "A", "_a"), "framework_A", "left").join(sizes(vectors, "B", "_b"), "framework_B", "left")
    found = found.join(sizes(fresh, "B", "_new"), "framework_B", "left").join(whole, PAIR, "left").na.fill(0, ["_a", "_b", "_new", "_whole"])
    return found.select(*PAIR, (F.col("_whole") * F.col("_b") + F.col("_a") * F.col("_new")).alias("rescored"), (F.col("_a") * F.col("_b")).alias("total"))
