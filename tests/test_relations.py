import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.operators import cleanup, thresholds
from crossmap.operators import verdicts as V

BOUNDARY = [
    (0.85, 0.85, "equivalence"), (0.85, 0.84, "partial"), (0.80, 0.80, "partial"), (0.75, 0.74, "A_covers_B"),
    (0.74, 0.75, "B_covers_A"), (0.40, 0.00, "partial"), (0.39, 0.39, "no_link"),
]


def test_relation_type_boundaries(spark):
    rows = spark.createDataFrame(BOUNDARY, ["a", "b", "kind"])
    found = rows.withColumn("found", R.relation_type(F.col("a"), F.col("b")))
    assert found.filter("kind <> found").count() == 0


@pytest.mark.parametrize("median, delta, eq, cov", [
    (0.60, 0.0, 0.85, 0.75), (0.70, 0.025, 0.875, 0.775), (0.40, -0.05, 0.80, 0.70), (1.00, 0.10, 0.95, 0.85),
    (0.00, -0.10, 0.75, 0.65),
])
def test_adaptive_thresholds(spark, median, delta, eq, cov):
    rows = spark.createDataFrame([("a", "b", median)] * 3, ["framework_A", "framework_B", "semantic_score"])
    found = thresholds.adaptive_thresholds(rows).first()
    assert (found["delta"], found["thresh_eq"], found["thresh_cov"]) == (delta, eq, cov)


def test_thresholds_without_candidates_are_the_bases(spark):
    none = spark.createDataFrame([], "framework_A STRING, framework_B STRING, semantic_score DOUBLE")
    pairs = spark.createDataFrame([("a", "b")], ["framework_A", "framework_B"])
    found = thresholds.adaptive_thresholds(none, pairs=pairs).first()
    assert (found["n"], found["thresh_eq"], found["thresh_cov"]) == (0, 0.85, 0.75)


def test_one_given_threshold_is_only_a_base(spark):
    rows = spark.createDataFrame([("a", "b", 0.70)], ["framework_A", "framework_B", "semantic_score"])
    found = thresholds.resolve_thresholds(rows, eq=0.8).first()
    assert (found["thresh_eq"], found["thresh_cov"]) == (0.825, 0.775)
    found = thresholds.resolve_thresholds(rows, eq=0.8, cov=0.7).first()
    assert (found["thresh_eq"], found["thresh_cov"]) == (0.8, 0.7)


def test_cleanup_boundaries_and_partition(spark):
    rows = spark.createDataFrame(
        [("partial", 0.40), ("partial", 0.39), ("no_link", 0.99), ("equivalence", 1.0)], ["relation_type", "confidence"]
    )
    kept, removed = cleanup.cleanup(rows)
    assert sorted(map(tuple, kept.collect())) == [("equivalence", 1.0), ("partial", 0.40)]
    assert sorted(map(tuple, removed.collect())) == [("no_link", 0.99), ("partial", 0.39)]


def test_counts_keep_types_that_do_not_occur(spark):
    rows = spark.createDataFrame([("partial",), ("partial",)], ["relation_type"])
    assert dict(map(tuple, cleanup.relation_counts(rows).collect())) == {
        "equivalence": 0, "A_covers_B": 0, "B_covers_A": 0, "partial": 2, "no_link": 0,
    }


def test_confirm_keeps_the_first_pass_where_there_is_no_second(spark):
    columns = "framework_A STRING, framework_B STRING, id_A STRING, id_B STRING, coverage_A_to_B DOUBLE, coverage_B_to_A DOUBLE, confidence DOUBLE, justification STRING"
    first = spark.createDataFrame([("a", "b", "1", "1", 0.9, 0.9, 0.8, "one"), ("a", "b", "1", "2", 0.9, 0.1, 0.8, "one")], columns)
    second = spark.createDataFrame([("a", "b", "1", "1", 0.6, 0.7, 0.9, "")], columns)
    found = {row["id_B"]: row for row in V.confirm(first, second).collect()}
    assert (found["1"]["coverage_A_to_B"], found["1"]["coverage_B_to_A"], found["1"]["confidence"]) == (0.75, 0.8, 0.85)
    assert (found["1"]["relation_type"], found["1"]["justification"]) == ("partial", "one")
    assert (found["2"]["coverage_A_to_B"], found["2"]["relation_type"]) == (0.9, "A_covers_B")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, scores):
    import numpy as np

    rows = spark.createDataFrame([("a", "b", float(s)) for s in scores], ["framework_A", "framework_B", "semantic_score"])
    found = thresholds.score_distribution(rows).first()
    assert found["n"] == len(scores)
    for name, wanted in (
        ("mean", np.mean(scores)), ("median", np.median(scores)), ("q25", np.percentile(scores, 25)),
        ("q75", np.percentile(scores, 75)), ("p90", np.percentile(scores, 90)),
    ):
        assert abs(found[name] - round(float(wanted), 4)) < 1.01e-4 if name == "mean" else found[name] == round(float(wanted), 4)
