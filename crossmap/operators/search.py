"""Search of titles by a regular expression through an index of their trigrams.

The index has a row for each different run of three characters of a title, in small letters. A pattern tells which runs every match has to hold: a list of
clauses that all have to be met, each a list of alternatives, each a set of runs. Rows that hold them are candidates, which
the pattern itself then checks. A pattern that tells nothing, or that cannot be read here, is searched for in all titles.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.operators.views import search_candidates

ROW = ["framework", "pos"]
Clause = list[frozenset[str]]


def title_index(requirements: DataFrame) -> DataFrame:
    """(gram, framework, pos)"""
    title = F.lower("title")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(title) - 2, F.lit(1))), lambda i: F.substring(title, i, F.lit(3)))
    return requirements.select(F.explode(F.array_distinct(grams)).alias("gram"), *ROW).filter(F.length("gram") == 3)


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _clauses(parsed) -> list[Clause]:
    """What every match of a parsed pattern holds."""
    parser = re._constants
    out, run = [], ""

    def end() -> None:
        nonlocal run
        if len(run) >= 3:
            out.append([_grams(run)])
        run = ""

    for kind, value in parsed:
        if kind is parser.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        end()
        if kind is parser.SUBPATTERN:
            out += _clauses(value[3])
        elif kind in (parser.MAX_REPEAT, parser.MIN_REPEAT, parser.POSSESSIVE_REPEAT) and value[0] > 0:
            out += _clauses(value[2])
        elif kind is parser.ATOMIC_GROUP:
            out += _clauses(value)
        elif kind is parser.BRANCH:
            ways = [_clauses(way) for way in value[1]]
            if all(ways):
                # Of each alternative, its first clause that is a plain set of runs stands for it.
                plain = [next((clause[0] for clause in way if len(clause) == 1), None) for way in ways]
                if all(plain):
                    out.append(plain)
    end()
    return out


def required_grams(pattern: str) -> list[Clause] | None:
    """The clauses of a pattern; None if it has none that an index can use."""
    try:
        parsed = re._parser.parse(pattern, re.IGNORECASE)
    except (re.error, OverflowError, RecursionError):
        return None
    if parsed.state.flags & re.VERBOSE:
        return None
    return _clauses(parsed) or None


def titles_that_may_match(index: DataFrame, clauses: list[Clause]) -> DataFrame:
    """(framework, pos) of the titles that hold an alternative of every clause."""
    def holding(grams: frozenset[str]) -> DataFrame:
        found = index.filter(F.col("gram").isin(*sorted(grams))).groupBy(*ROW).agg(F.count("*").alias("_n"))
        return found.filter(F.col("_n") == len(grams)).select(*ROW)

    met = [reduce(DataFrame.union, map(holding, clause)).distinct() for clause in clauses]
    return reduce(lambda a, b: a.join(b, ROW, "left_semi"), met)


def search_indexed(candidates: DataFrame, index: DataFrame, min_score: float, pattern: str) -> DataFrame:
    """What search_candidates gives, for candidates with positions and an index of their titles."""
    clauses = required_grams(pattern)
    if clauses is None:
        return search_candidates(candidates, min_score, pattern)
    found = titles_that_may_match(index, clauses)
    kept = candidates
    for letter in "AB":
        side = found.select(F.col("framework").alias(f"framework_{letter}"), F.col("pos").alias(f"pos_{letter}"), F.lit(True).alias(f"_may_{letter}"))
        kept = kept.join(side, [f"framework_{letter}", f"pos_{letter}"], "left")
    kept = kept.filter("_may_A OR _may_B").select(*candidates.columns)
    return search_candidates(kept, min_score, pattern)
