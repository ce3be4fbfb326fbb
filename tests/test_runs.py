import pytest
from pyspark.sql import functions as F

from crossmap.operators import reports
from crossmap.operators.ordering import PAIR
from crossmap.plans import bindings as B
from crossmap.plans import stored
from crossmap.plans.mapping import mapping_totals, run_mapping
from crossmap.sources import tables
from crossmap.sources.schemas import RELATION_COLUMNS
from crossmap.streaming import arrivals

SF_DIR = "/root/testdata/sf0.001"


def test_requirements_round_trip(spark, tmp_path):
    rows = B.document_requirements(spark, SF_DIR)
    tables.write_requirements(rows, str(tmp_path / "p"))
    back = tables.read_requirements(spark, str(tmp_path / "p"))
    assert back.exceptAll(rows.select(back.columns)).count() == 0 and back.count() == rows.count()
    spark.createDataFrame([("f", "1", "T")], ["framework", "id", "title"]).write.json(str(tmp_path / "j"))
    row = tables.read_requirements(spark, str(tmp_path / "j"), "json").first()
    assert (row["description"], row["tags"]) == ("", [])


def test_versions(spark, tmp_path):
    rows, path = spark.range(3).toDF("x"), str(tmp_path / "v")
    tables.write_versioned(rows, path, version="1")
    with pytest.raises(tables.OutdatedTable):
        tables.read_versioned(spark, path, version="2")
    tables.write_versioned(rows.limit(1), path, version="2")
    assert tables.read_versioned(spark, path, version="2").count() == 1
    rows.write.parquet(str(tmp_path / "plain"))
    assert tables.read_versioned(spark, str(tmp_path / "plain")).count() == 3


def test_second_run_adds_nothing(spark, tmp_path):
    folder, requirements, vectors = str(tmp_path / "s"), B.vector_requirements(spark, SF_DIR), B.vectors(spark, SF_DIR)
    options = {"threshold": 0.2, "k": 5}
    few = requirements.filter("framework < '3'")
    first = stored.update_candidates(few, folder, vectors.filter("framework < '3'"), **options).count()
    assert stored.update_candidates(few, folder, vectors.filter("framework < '3'"), **options).count() == first
    files = spark.read.parquet(f"{folder}/candidates").count()
    assert files == first
    whole = stored.update_candidates(requirements, folder, vectors, **options)
    plain = run_mapping(requirements, vectors, **options)["candidates"]
    assert sorted(map(tuple, whole.select(*PAIR, "pos_A", "pos_B").collect())) == sorted(map(tuple, plain.select(*PAIR, "pos_A", "pos_B").collect()))
    again = stored.update_candidates(few, folder, vectors, force=True, **options)
    assert again.count() == whole.count()
    assert stored.stored(spark, folder, stored.CANDIDATES, 0.3, 5).count() == 0


def test_rows_of_an_unfinished_run_are_ignored(spark, tmp_path):
    folder, requirements, vectors = str(tmp_path / "s"), B.vector_requirements(spark, SF_DIR), B.vectors(spark, SF_DIR)
    found = stored.update_candidates(requirements, folder, vectors, threshold=0.2)
    n = found.count()
    broken = found.limit(50).withColumns({"threshold": F.lit(0.2), "k": F.lit(5), "run": F.lit("run-9999-died")})
    tables.write_versioned(broken, f"{folder}/candidates", keys=["run"])
    assert stored.stored(spark, folder, stored.CANDIDATES, 0.2, 5).count() == n


def judge(requests):
    """Fails the first batch of each pair, answers the rest with the same verdict."""
    verdict = '{"coverage_A_to_B": 0.9, "coverage_B_to_A": 0.2, "confidence": 0.8, "relation_type": "no_link"}'
    many = F.concat(F.lit('{"results": ['), F.array_join(F.array_repeat(F.lit(verdict), F.col("n").cast("int")), ","), F.lit("]}"))
    raw = F.when(F.col("n") == 1, verdict).when(F.col("batch_no") == 0, "broken").otherwise(many)
    return requests.select(*PAIR, "batch_no", raw.alias("raw"))


def test_whole_run(spark):
    requirements, vectors = B.vector_requirements(spark, SF_DIR), B.vectors(spark, SF_DIR)
    found = run_mapping(requirements, vectors, judge=judge, sources=["0", "1"], targets=["1", "2"], threshold=0.2)
    assert sorted(map(tuple, found["pairs"].collect())) == [("0", "1"), ("0", "2"), ("1", "2")]
    n = found["candidates"].count()
    assert found["relations"].count() == n > 0
    assert {r["relation_type"] for r in found["relations"].select("relation_type").distinct().collect()} == {"A_covers_B"}
    assert found["kept"].count() == n and found["removed"].count() == 0
    assert found["report"].count() == 2 * n
    totals = dict(map(tuple, mapping_totals(requirements, found["pairs"], found["candidates"], found["kept"], found["removed"]).collect()))
    assert totals["frameworks"] == 10 and totals["pairs"] == 3 and totals["candidates"] == totals["kept"] == n and totals["removed"] == 0
    short = run_mapping(requirements, vectors, sources=["0"], targets=["1"], threshold=0.2)
    assert set(short) == {"pairs", "candidates", "reduction"}
    loose = run_mapping(requirements, vectors, judge=judge, sources=["0"], targets=["1"], threshold=0.2, skip_cleanup=True)
    assert "removed" not in loose


def test_judged_pairs_are_not_judged_again(spark, tmp_path):
    folder, requirements, vectors = str(tmp_path / "s"), B.vector_requirements(spark, SF_DIR), B.vectors(spark, SF_DIR)
    asked = spark.sparkContext.accumulator(0)

    def counting(requests):
        asked.add(requests.count())
        return judge(requests)

    with pytest.raises(ValueError):
        stored.update_relations(requirements, folder, counting, 0.2)
    stored.update_candidates(requirements, folder, vectors, sources=["0"], targets=["1"], threshold=0.2)
    first = stored.update_relations(requirements, folder, counting, 0.2).count()
    before = asked.value
    assert first > 0 and before > 0
    assert stored.update_relations(requirements, folder, counting, 0.2).count() == first and asked.value == before
    stored.update_candidates(requirements, folder, vectors, sources=["0"], targets=["1", "2"], threshold=0.2)
    more = stored.update_relations(requirements, folder, counting, 0.2)
    assert more.filter("framework_B = '1'").count() == first and more.filter("framework_B = '2'").count() > 0
    assert asked.value > before


def test_export_is_marked_with_the_version(spark, tmp_path):
    relations = B.vector_relations(spark, SF_DIR)
    reports.export_relations(relations, str(tmp_path / "all"))
    back = tables.read_versioned(spark, str(tmp_path / "all"), fmt="json")
    assert set(back.columns) == set(RELATION_COLUMNS) and back.count() == relations.count()


def document(title, words):
    items = "".join(f'  {i}_label: "{word}"\n' for i, word in enumerate(words, 1))
    return f"1:\n  title: {title}\n{items}"


def test_arriving_documents(spark, tmp_path):
    inbox, folder = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def run():
        stream = arrivals.arriving_documents(spark, str(inbox))
        writer = arrivals.map_arrivals(stream, folder, str(tmp_path / "cp"), threshold=0.4)
        assert writer.trigger(availableNow=True).start().awaitTermination(120)
        return {(r["framework_A"], r["framework_B"]) for r in stored.stored(spark, folder, stored.CANDIDATES).collect()}

    (inbox / "a.yaml").write_text(document("t", ["asset list", "backup plan"]))
    (inbox / "b.yaml").write_text(document("t", ["asset list", "other"]))
    assert run() == {("a", "b")}
    (inbox / "c.yaml").write_text(document("t", ["backup plan"]))
    assert run() == {("a", "b"), ("a", "c"), ("b", "c")}
    assert spark.read.parquet(f"{folder}/candidates_done").count() == 3


def test_pairs_of_changed_requirements_are_done_again(spark, tmp_path):
    schema = "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT"

    def rows(text):
        return spark.createDataFrame([("a", "1", "access control", "", [], 0), ("b", "1", text, "", [], 0)], schema)

    folder = str(tmp_path)
    assert stored.update_candidates(rows("access control"), folder, threshold=0.3).count() == 1
    assert stored.update_candidates(rows("backup tapes"), folder, threshold=0.3).count() == 0
    assert stored.update_candidates(rows("access control"), folder, threshold=0.3).count() == 1


def test_unreadable_results_are_not_taken_for_missing_ones(spark, tmp_path):
    (tmp_path / "candidates_done").mkdir()
    with pytest.raises(Exception):
        stored.finished_pairs(spark, str(tmp_path), "candidates")
    assert stored.finished_pairs(spark, str(tmp_path / "none"), "candidates") is None
