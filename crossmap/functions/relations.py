"""Relation type, colours and thresholds as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relation types, thresholds and colours.
RELATION_TYPES = ("equivalence", "A_covers_B", "B_covers_A", "partial", "no_link")
THRESHOLD_EQUIVALENCE = 0.85
THRESHOLD_COVERAGE = 0.75
THRESHOLD_PARTIAL = 0.4
MIN_CONFIDENCE = 0.40
CONFIRM_THRESHOLD = 0.75
SEMANTIC_THRESHOLD = 0.40
TOP_K = 5
BATCH_SIZE = 10
MEDIAN_BASELINE = 0.60
MEDIAN_SENSITIVITY = 0.25
MAX_DELTA = 0.10
EQUIVALENCE_RANGE = (0.70, 0.95)
COVERAGE_RANGE = (0.60, 0.90)
SHEET_COLOURS = {
    "equivalence": "C6EFCE",
    "A_covers_B": "FFEB9C",
    "B_covers_A": "FFEB9C",
    "partial": "FFDDC1",
    "no_link": "FFC7CE",
}
SHEET_COLOUR_OTHER = "FFFFFF"
REVIEW_COLOURS = {
    "equivalence": "#27ae60",
    "A_covers_B": "#3498db",
    "B_covers_A": "#e67e22",
    "partial": "#f39c12",
    "no_link": "#95a5a6",
}
REVIEW_COLOUR_OTHER = "#999"


def relation_type(cov_a: Column, cov_b: Column, eq: Column | None = None, cov: Column | None = None) -> Column:
    """Type of a relation from both coverages; the first rule that holds wins."""
    eq = F.lit(THRESHOLD_EQUIVALENCE) if eq is None else eq
    cov = F.lit(THRESHOLD_COVERAGE) if cov is None else cov
    return (
        F.when((cov_a >= eq) & (cov_b >= eq), "equivalence")
        .when((cov_a >= cov) & (cov_b < cov), "A_covers_B")
        .when((cov_b >= cov) & (cov_a < cov), "B_covers_A")
        .when(F.greatest(cov_a, cov_b) >= THRESHOLD_PARTIAL, "partial")
        .otherwise("no_link")
    )


def _lookup(colours: dict[str, str], other: str, kind: Column) -> Column:
    table = F.create_map(*(F.lit(part) for item in colours.items() for part in item))
    return F.coalesce(F.try_element_at(table, kind), F.lit(other))


def sheet_colour(kind: Column) -> Column:
    return _lookup(SHEET_COLOURS, SHEET_COLOUR_OTHER, kind)


def review_colour(kind: Column) -> Column:
    return _lookup(REVIEW_COLOURS, REVIEW_COLOUR_OTHER, kind)


def threshold_delta(median: Column) -> Column:
    """Shift of the thresholds for a pair whose scores have this median."""
    shift = (median - F.lit(MEDIAN_BASELINE)) * F.lit(MEDIAN_SENSITIVITY)
    return F.greatest(F.lit(-MAX_DELTA), F.least(F.lit(MAX_DELTA), shift))


def shifted(base: float, delta: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return exact_round(F.greatest(F.lit(low), F.least(F.lit(high), F.lit(base) + delta)), 3)


def shorter_score(score: Column, digits: int, known: int) -> Column:
    """What `round` gives for a score within [0, 1] that has `known` decimals at most, 12 or fewer, by whole numbers alone."""
    step = 10 ** (known - digits)
    whole = F.rint(score * float(10**known)).cast("bigint") + step // 2
    return F.floor(whole / F.lit(step)) / float(10**digits)


def exact_round(value: Column, digits: int) -> Column:
    """Value rounded on its exact binary amount, which can differ from `round` at a five."""
    return F.regexp_replace(F.format_number(value, digits), ",", "").cast("double")
