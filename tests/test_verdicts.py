import json

import pytest
from pyspark.sql import functions as F

from crossmap.functions import text
from crossmap.operators import candidates as C
from crossmap.operators import verdicts as V

GOOD = {"coverage_A_to_B": 0.5, "coverage_B_to_A": 0.6, "confidence": 0.7, "relation_type": "partial", "justification": "why"}


def parse(spark, n, raw):
    requests = spark.createDataFrame([("a", "b", 0, n)], "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT")
    responses = spark.createDataFrame([("a", "b", 0, raw)] if raw is not None else [], "framework_A STRING, framework_B STRING, batch_no BIGINT, raw STRING")
    verdicts, failed = V.parse_responses(requests, responses)
    return verdicts.orderBy("idx").collect(), failed.count()


def batch(*results):
    return json.dumps({"results": results})


def test_valid_batch(spark):
    found, failed = parse(spark, 2, batch(GOOD, {**GOOD, "confidence": 1, "extra": [1]}))
    assert failed == 0 and [(r["idx"], r["confidence"]) for r in found] == [(0, 0.7), (1, 1.0)]


def test_numbers_as_text_are_accepted(spark):
    found, failed = parse(spark, 1, json.dumps({**GOOD, "coverage_A_to_B": "0.8"}))
    assert failed == 0 and found[0]["coverage_A_to_B"] == 0.8


def test_missing_justification_is_empty(spark):
    found, _ = parse(spark, 1, json.dumps({k: v for k, v in GOOD.items() if k != "justification"}))
    assert found[0]["justification"] == ""


@pytest.mark.parametrize("n, raw", [
    (2, batch(GOOD)), (2, batch(GOOD, {**GOOD, "coverage_A_to_B": 1.2})), (2, batch(GOOD, {**GOOD, "relation_type": "other"})),
    (2, batch(GOOD, {**GOOD, "confidence": "0.8d"})), (2, batch(GOOD, {k: v for k, v in GOOD.items() if k != "confidence"})),
    (2, "not json"), (1, batch(GOOD)), (2, json.dumps(GOOD)), (1, None), (1, json.dumps({**GOOD, "confidence": -0.1})),
    (1, json.dumps({**GOOD, "confidence": "NaN"})), (2, json.dumps({"results": None})), (1, ""),
])
def test_a_bad_answer_fails_the_whole_batch(spark, n, raw):
    assert parse(spark, n, raw) == ([], 1)


def test_requests_have_one_or_many_wording(spark):
    requirements = spark.createDataFrame(
        [(f, str(i), f"{f}{i}", "text", ["tag"], i) for f in "ab" for i in range(12)] + [("a", "3", "last", "", [], 99)],
        "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT",
    )
    found = spark.createDataFrame(
        [("a", "b", str(i), str(i), i, i, 1, 1 - i / 100, "x", "y") for i in range(11)],
        "framework_A STRING, framework_B STRING, id_A STRING, id_B STRING, pos_A BIGINT, pos_B BIGINT, rank INT, semantic_score DOUBLE, title_A STRING, title_B STRING",
    )
    many, one = V.build_requests(found, requirements).orderBy("batch_no").collect()
    assert (many["n"], one["n"]) == (10, 1)
    assert "Number of pairs: 10" in many["text"] and "an array of 10 objects" in many["text"]
    assert "0.85" in many["text"] and "0.75" in many["text"]
    assert "--- Paire 1 ---\nA (a [tag]): a0\ntext" in many["text"] and "A (a): last\n(sans description)" in many["text"]
    assert "Number of pairs: 1\n" in one["text"] and "One object with" in one["text"] and "a10" in one["text"]


def test_retry_leaves_out_answered_candidates(spark):
    batched = spark.createDataFrame(
        [("a", "b", b, i) for b in range(2) for i in range(3)], "framework_A STRING, framework_B STRING, batch_no BIGINT, idx BIGINT"
    )
    failed = spark.createDataFrame([("a", "b", 1, 3)], "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT")
    again = V.retry_batches(failed, batched)
    assert sorted((r["retry_of"], r["retry_idx"], r["idx"]) for r in again.collect()) == [(1, 0, 0), (1, 1, 0), (1, 2, 0)]
    assert again.select("batch_no").distinct().count() == 3
    answered = spark.createDataFrame([("a", "b", 1, 2)], "framework_A STRING, framework_B STRING, batch_no BIGINT, idx BIGINT")
    assert V.retry_batches(failed, batched, answered).count() == 2


def test_second_rounds_of_requests(spark):
    requirements = spark.createDataFrame(
        [(f, str(i), f"{f}{i}", "", [], i) for f in "ab" for i in range(4)],
        "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT",
    )
    found = spark.createDataFrame(
        [("a", "b", str(i), str(i), i, i, 1, 0.5 + i / 10, "x", "y") for i in range(4)],
        "framework_A STRING, framework_B STRING, id_A STRING, id_B STRING, pos_A BIGINT, pos_B BIGINT, rank INT, semantic_score DOUBLE, title_A STRING, title_B STRING",
    )
    batched = V.assign_batches(found, 3)
    failed = spark.createDataFrame([("a", "b", 0, 3)], "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT")
    single = V.retry_requests(failed, batched, requirements).collect()
    assert [r["n"] for r in single] == [1, 1, 1] and all(r["batch_no"] < 0 for r in single)
    assert sorted(r["text"].split("): ")[1].split("\n")[0] for r in single) == ["a1", "a2", "a3"]
    scored = V.classify(batched.selectExpr(
        "*", "CASE WHEN pos_A < 2 THEN 0.75D ELSE 0.7D END AS coverage_A_to_B", "0.1D AS coverage_B_to_A", "0.9D AS confidence", "'' AS justification"
    ))
    again = V.confirmation_requests(scored, requirements).collect()
    assert [(r["batch_no"], r["n"]) for r in again] == [(0, 2)]
    assert again[0]["text"].index("a1") < again[0]["text"].index("a0")


def test_an_answer_delivered_twice_counts_once(spark):
    keys = ("a", "b", 0)
    requests = spark.createDataFrame([(*keys, 1)], "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT")
    raw = '{"coverage_A_to_B": 0.5, "coverage_B_to_A": 0.5, "confidence": 0.5, "relation_type": "partial"}'
    responses = spark.createDataFrame([(*keys, raw), (*keys, raw)], "framework_A STRING, framework_B STRING, batch_no BIGINT, raw STRING")
    verdicts, failed = V.parse_responses(requests, responses)
    assert verdicts.count() == 1 and failed.count() == 0


def test_pairs_without_thresholds_are_classified_with_the_basic_ones(spark):
    scored = spark.createDataFrame([("a", "b", 0.8, 0.1), ("a", "c", 0.8, 0.1)], "framework_A STRING, framework_B STRING, coverage_A_to_B DOUBLE, coverage_B_to_A DOUBLE")
    limits = spark.createDataFrame([("a", "b", 0.95, 0.85)], "framework_A STRING, framework_B STRING, thresh_eq DOUBLE, thresh_cov DOUBLE")
    assert {r["framework_B"]: r["relation_type"] for r in V.classify(scored, limits).collect()} == {"b": "partial", "c": "A_covers_B"}


def test_texts_go_to_their_batch_once(spark):
    """Each row that is shuffled holds one text; candidates without one of their texts are left out of their batch, null texts out of its blocks."""
    requirements = spark.createDataFrame(
        [(f, str(i), f"{f}{i}" if i != 4 else None, "text " * 400, ["tag"], i) for f in "ab" for i in range(9)],
        "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT",
    )
    listed = [("a", "b", str(i), str(8 - i), i // 5, i % 5) for i in range(9)] + [("a", "b", "x", "1", 0, 5), ("a", "b", "1", None, 0, 6), ("a", "b", "x", "y", 2, 0), ("a", "b", "2", "3", 0, 1)]
    found = spark.createDataFrame(listed, "framework_A STRING, framework_B STRING, id_A STRING, id_B STRING, batch_no BIGINT, idx BIGINT")
    made = V.build_requests(found, requirements)
    got = {r["batch_no"]: r for r in made.collect()}
    assert {b: r["n"] for b, r in got.items()} == {0: 6, 1: 4}
    whole = V._with_texts(found, requirements).withColumn("_number", F.col("idx") + 1).select("batch_no", "idx", text.pair_block(F.col("_number")).alias("block")).collect()
    for b, r in got.items():
        blocks = [x["block"] for x in sorted((x for x in whole if x["batch_no"] == b and x["block"] is not None), key=lambda x: (x["idx"], x["block"]))]
        assert "\n\n".join(blocks) in r["text"] and len(blocks) == r["text"].count("--- Paire")
    assert "title_A" not in (plan := made._jdf.queryExecution().optimizedPlan().toString()) and plan.count("Join ") == 1


def test_candidates_without_titles_are_the_same_rows(spark):
    rows = spark.createDataFrame(
        [(f, str(i % 7), f"title {f} {i % 3}", f"word{i % 4} word{i % 5} other", ["t"], i) for f in "abc" for i in range(20)],
        "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT",
    )
    named, plain = (C.candidates(rows, threshold=0.15, k=5, digits=4, titles=titles) for titles in (True, False))
    assert "title_A" not in plain.columns and sorted(map(tuple, named.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
