"""Wording of a scoring request, made from the response's fields and the rules of relations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crossmap.functions.relations import THRESHOLD_COVERAGE, THRESHOLD_EQUIVALENCE, THRESHOLD_PARTIAL

#: Fields of a verdict: name, kind and meaning.
FIELDS = (
    ("coverage_A_to_B", "number 0..1", "part of requirement B that requirement A fulfils"),
    ("coverage_B_to_A", "number 0..1", "part of requirement A that requirement B fulfils"),
    ("confidence", "number 0..1", "certainty of the two numbers"),
    ("relation_type", "string", "see the table of relations"),
    ("justification", "string", "short reason"),
)
TASK = "Rate how far the requirements of each numbered pair fulfil each other."
COUNT, FORMAT = "Number of pairs: %d", "Reply with JSON alone."
ONE_REPLY = "One object with these fields:"
MANY_REPLY = "One object whose field results is an array of %d objects, one for each pair in their order, with these fields:"


def _relations(eq: float, cov: float) -> list[str]:
    """The rules of the relation type as a table, from the same thresholds that classify with."""
    a, b = FIELDS[0][0], FIELDS[1][0]
    return [
        f"equivalence | {a} >= {eq} and {b} >= {eq}",
        f"A_covers_B | {a} >= {cov} > {b}",
        f"B_covers_A | {b} >= {cov} > {a}",
        f"partial | otherwise, {a} >= {THRESHOLD_PARTIAL} or {b} >= {THRESHOLD_PARTIAL}",
        "no_link | otherwise",
    ]


def instructions(eq: float = THRESHOLD_EQUIVALENCE, cov: float = THRESHOLD_COVERAGE) -> str:
    return "\n".join([TASK, "", "relation | condition", *_relations(eq, cov)])


def _reply(opening: str) -> str:
    return "\n".join([FORMAT, opening, *(f"{name} ({kind}): {meaning}" for name, kind, meaning in FIELDS)])


def request_text(blocks: Column, n: Column, head: str) -> Column:
    """Whole request: instructions, number of pairs, the numbered pairs and the form of the reply."""
    reply = F.when(n == 1, _reply(ONE_REPLY)).otherwise(F.format_string(_reply(MANY_REPLY), n))
    return F.concat_ws("\n\n", F.lit(head), F.format_string(COUNT, n), blocks, reply)
