import numpy as np

from crossmap.operators import reports, views

RELATION = (
    "framework_A STRING, framework_B STRING, id_A STRING, id_B STRING, title_A STRING, title_B STRING, semantic_score DOUBLE, "
    "coverage_A_to_B DOUBLE, coverage_B_to_A DOUBLE, confidence DOUBLE, relation_type STRING, justification STRING, pos_A BIGINT, rank INT"
)


def relations(spark):
    return spark.createDataFrame([
        ("a", "b", "1", "x", "<T>", "Été", 0.5, 0.435, 1.0, 0.9, "partial", "it's", 0, 1),
        ("a", "b", "2", "y", "Backup", None, 0.9, 0.9, 0.9, 0.3, "equivalence", None, 1, 1),
        ("a", "c", "1", "z", "Back. up", "zz", 0.7, 0.1, 0.1, 0.9, "strange", "", 0, 1),
    ], RELATION)


def test_search_is_a_pattern_without_letter_case(spark):
    found = {r["id_B"] for r in views.search_candidates(relations(spark), 0.0, "back.?.?up").collect()}
    assert found == {"y", "z"}
    assert {r["id_B"] for r in views.search_candidates(relations(spark), 0.0, "éTÉ").collect()} == {"x"}
    assert {r["id_B"] for r in views.search_candidates(relations(spark), 0.7).collect()} == {"y", "z"}


def test_relation_filter(spark):
    assert views.filter_relations(relations(spark), ["partial", "strange"], 0.9).count() == 2
    assert views.filter_relations(relations(spark)).count() == 3
    assert [r["id_B"] for r in views.by_score(relations(spark)).collect()] == ["y", "z", "x"]


def test_review_rows_are_numbered_over_all_pairs(spark):
    state = spark.createDataFrame([(1, True), (7, True)], ["row", "checked"])
    rows = views.review_rows(relations(spark), state).orderBy("row").collect()
    assert [(r["row"], r["id_B"], r["checked"]) for r in rows] == [(0, "y", False), (1, "x", True), (2, "z", False)]
    assert [r["colour"] for r in rows] == ["#27ae60", "#f39c12", "#999"]
    assert rows[1]["title_A"] == "&lt;T&gt;" and rows[1]["justification"] == "it&#x27;s" and rows[0]["justification"] == ""
    assert rows[1]["label"] == "0.50 → 0.43/1.00"
    progress = views.review_progress(views.review_rows(relations(spark), state)).first()
    assert tuple(progress) == (3, 1, 2, 33)


def test_progress_of_nothing(spark):
    empty = views.review_rows(relations(spark).limit(0))
    assert tuple(views.review_progress(empty).first()) == (0, 0, 0, 0)


def test_histogram_equals_numpy(spark):
    scores = [((i * 37) % 101) / 101 for i in range(400)]
    rows = spark.createDataFrame([("a", "b", s) for s in scores] + [("a", "c", 0.5)] * 3, ["framework_A", "framework_B", "semantic_score"])
    found = views.score_histogram(rows).orderBy("bin")
    counts, edges = np.histogram(scores, bins=30)
    mine = found.filter("framework_B = 'b'").collect()
    assert [r["n"] for r in mine] == counts.tolist()
    assert np.allclose([r["low"] for r in mine], edges[:-1], atol=1e-6)
    counts, _ = np.histogram([0.5] * 3, bins=30)
    assert [r["n"] for r in found.filter("framework_B = 'c'").collect()] == counts.tolist()


def test_report_sheets_are_written_by_folder(spark, tmp_path):
    kept, removed = relations(spark).filter("confidence >= 0.5"), relations(spark).filter("confidence < 0.5")
    report = reports.report_table(kept, removed)
    assert {r["sheet"]: r["count"] for r in report.groupBy("sheet").count().collect()} == {"a b": 1, "a c": 1, "Global": 2, "Removed": 1}
    assert report.columns[2:] == list(reports.HEADINGS)
    reports.write_report(report, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert back.count() == 5 and back.filter("sheet = 'Removed'").count() == 1
    reports.write_rows(kept, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).filter("framework_B = 'c'").count() == 1
    single = reports.pair_report(kept, removed)
    assert {r["sheet"] for r in single.select("sheet").distinct().collect()} == {"Mapping Results", "Removed"}


def test_pairs_with_equal_short_names_have_sheets_of_their_own(spark):
    from crossmap.operators import reports

    names = ["anssiHygieneGuideV2", "anssiHygieneGuideV3"]
    rows = spark.createDataFrame(
        [(name, "1", "t", "dora", "2", "u", 0.5, 0.9, 0.9, 0.9, "equivalence", "j") for name in names],
        "framework_A STRING, id_A STRING, title_A STRING, framework_B STRING, id_B STRING, title_B STRING, semantic_score DOUBLE, "
        "coverage_A_to_B DOUBLE, coverage_B_to_A DOUBLE, confidence DOUBLE, relation_type STRING, justification STRING",
    )
    found = {(r["sheet"], r["Framework A"]) for r in reports.report_table(rows).collect()}
    assert found == {("anssiHygiene dora", names[0]), ("anssiHygiene dora 2", names[1]), ("Global", names[0]), ("Global", names[1])}
