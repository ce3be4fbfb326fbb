import pytest

from crossmap.operators import validate


def test_sections_of_identifiers(spark):
    requirements = spark.createDataFrame(
        [("f", i) for i in ("1.1.1", "1.1.2", "2.1.1", "3.1.1", "4.1", "4.2", "5", "CIS-1.1")], ["framework", "id"]
    )
    expected = spark.createDataFrame([("f", "1.1", 2), ("f", "2", 3), ("f", "4", 1), ("f", "9", 1), ("f", "0", 0)], ["framework", "section", "expected"])
    sections, report = validate.validate_counts(requirements, expected)
    found = {r["section"]: (r["expected"], r["parsed"], r["status"]) for r in sections.collect()}
    assert found == {
        "1.1": (2, 2, "equal"), "2": (3, 1, "missing"), "3.1": (0, 1, "over"), "4": (1, 2, "over"), "5": (0, 1, "over"),
        "9": (1, 0, "missing"), "0": (0, 0, "equal"), "CIS-1": (0, 1, "over"),
    }
    row = report.first()
    assert (row["total_expected"], row["total_parsed"], row["missing"], row["over"], row["ok"], row["difference"]) == (7, 8, 2, 4, False, 1)
    shown = validate.shown_sections(sections, 2).first()
    assert (shown["missing_sections"], shown["over_sections"]) == (["2", "9"], ["3.1", "4"])


def test_unregistered_frameworks_are_not_validated(spark):
    requirements = spark.createDataFrame([("f", "1"), ("g", "1")], ["framework", "id"])
    expected = spark.createDataFrame([("f", "1", 1)], ["framework", "section", "expected"])
    sections, report = validate.validate_counts(requirements, expected)
    assert [r["framework"] for r in report.collect()] == ["f"] and report.first()["ok"]
    assert {r["framework"] for r in sections.collect()} == {"f"}


@pytest.mark.parametrize("selector, items", [
    ("9.3", ["9.3"]), ("10.*", ["10.1", "10.2"]), ("9.4-5", ["9.4", "9.5"]), ("9.4-9", ["9.4", "9.5"]),
    ("3.2.*", ["3.2.1", "3.2.2", "3.2.3"]), ("3.2.2-3", ["3.2.2", "3.2.3"]), ("3.2.1", ["3.2.1"]),
])
def test_selectors(spark, selector, items):
    sections = spark.createDataFrame(
        [("f", "9", None, 5), ("f", "10", None, 2), ("f", "3", "2", 3)], "framework STRING, section STRING, subsection STRING, expected INT"
    )
    selectors = spark.createDataFrame([("f", "no", selector)], ["framework", "option", "selector"])
    assert sorted(r["item"] for r in validate.expand_na(selectors, sections).collect()) == items


def test_counts_are_looked_up_through_the_survey_key(spark):
    from crossmap.sources import dimension

    requirements = spark.createDataFrame([("iso27001", "5.1"), ("iso27001", "5.2")], ["framework", "id"])
    expected = spark.createDataFrame([("iso27001-2022", "5", 2), ("unknown-1", "1", 1)], ["framework", "section", "expected"])
    report = validate.validate_counts(requirements, dimension.by_key(expected, dimension.framework_dim(spark)))[1]
    assert {r["framework"]: (r["total_parsed"], r["ok"]) for r in report.collect()} == {"iso27001": (2, True), "unknown-1": (0, False)}


def test_all_sections_are_listed_without_a_limit(spark):
    sections = spark.createDataFrame([("f", f"{i:02}", "missing") for i in range(40)], ["framework", "section", "status"])
    assert len(validate.shown_sections(sections, None).first()["missing_sections"]) == 40
    assert len(validate.shown_sections(sections).first()["missing_sections"]) == 20
