"""Stored matrices: reuse, versions, and what a reader skips."""

from pathlib import Path
from tempfile import mkdtemp

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.operators import pairs as P
from crossmap.operators import similarity
from crossmap.plans import bindings as B
from crossmap.plans import matrices, stored
from crossmap.sources import tables
from tests.test_similarity import rows

SF_DIR = "/root/testdata/sf0.001"
SETTINGS = {"threshold": 0.2, "k": 5}


def made(spark, folder, end="4", change=False):
    requirements, vectors = (df.filter(F.col("framework") < end) for df in (B.vector_requirements(spark, SF_DIR), B.vectors(spark, SF_DIR)))
    if change:
        vectors = vectors.withColumn("embedding", F.when(F.col("framework") == "1", F.reverse("embedding")).otherwise(F.col("embedding")))
    stored.update_candidates(requirements, folder, vectors, **SETTINGS)
    return vectors, matrices.update_matrices(vectors, folder, **SETTINGS, rows=32)


def test_matrices_are_kept_while_their_candidates_are(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(ValueError):
        matrices.update_matrices(B.vectors(spark, SF_DIR), folder)
    vectors, n = made(spark, folder)
    assert n == 6 and made(spark, folder)[1] == 0
    assert made(spark, folder, "5")[1] == 4
    vectors, n = made(spark, folder, "5", change=True)
    assert n == 4  # the pairs of the framework that has changed
    pairs = matrices.stored_sample(spark, folder, **SETTINGS).select("framework_A", "framework_B").distinct()
    cells = rows(similarity.matrix_cells(matrices.stored_grids(spark, folder, **SETTINGS)).withColumn("score", F.round("score", 6)))
    wanted = similarity.matrix_cells(similarity.similarity_matrix(vectors, pairs)).withColumn("score", F.round("score", 6))
    assert pairs.count() == 10 and cells == rows(wanted)


def test_candidates_made_again_leave_no_matrix(spark, tmp_path):
    folder = str(tmp_path)
    vectors, _ = made(spark, folder, "2")
    stored.update_candidates(B.vector_requirements(spark, SF_DIR).filter("framework < '2'"), folder, vectors, force=True, **SETTINGS)
    assert matrices.stored_sample(spark, folder, **SETTINGS).count() == 0
    assert matrices.update_matrices(vectors, folder, **SETTINGS) == 1


def test_another_version_is_refused(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    monkeypatch.setattr(matrices, "VERSION", "0")
    made(spark, folder, "2")
    with pytest.raises(tables.OutdatedTable):
        matrices.stored_grids(spark, folder, **SETTINGS).count()


def test_an_update_that_died_is_not_read(spark, tmp_path):
    folder = str(tmp_path)
    made(spark, folder, "2")
    whole = matrices.stored_grids(spark, folder, **SETTINGS).count()
    half = spark.read.parquet(f"{folder}/{matrices.GRIDS}").limit(1).withColumn("written", F.lit("9999"))
    half.write.mode("append").partitionBy("_v").parquet(f"{folder}/{matrices.GRIDS}")
    assert matrices.stored_grids(spark, folder, **SETTINGS).count() == whole


def test_a_reader_of_one_pair_skips_most_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(matrices, "GROUP_BYTES", 1 << 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    folder = str(tmp_path)
    made(spark, folder, "8")
    found = matrices.stored_grids(spark, folder, **SETTINGS, pair=("2", "5"), positions=(0, 100), least=0.1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(framework_A,2)" in plan and "GreaterThanOrEqual(high_A,0)" in plan and "GreaterThanOrEqual(high,0.1)" in plan
    groups = [pq.ParquetFile(file).metadata.row_group(i) for file in Path(folder, matrices.GRIDS).rglob("*.parquet") for i in range(pq.ParquetFile(file).num_row_groups)]

    def may_hold(group):
        ends = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        return all(ends[name].min <= value <= ends[name].max for name, value in (("framework_A", "2"), ("framework_B", "5")))

    held = [may_hold(group) for group in groups]
    assert len(groups) >= 8 and 0 < sum(held) <= len(held) / 2
    assert found.count() > 0 and found.filter("framework_A <> '2' OR framework_B <> '5' OR high < 0.1 OR low_A > 100").count() == 0


def test_a_store_grows_with_the_vectors_and_not_with_the_cells(spark, tmp_path):
    """Ten frameworks of 400 rows: 7.2 million cells, which were 57 MB on disk."""
    folder = str(tmp_path)
    vectors = spark.range(4000).select(
        (F.col("id") % 10).cast("string").alias("framework"), F.col("id").alias("pos"),
        F.array(*(F.sin(F.col("id") * (i + 1)) for i in range(8))).cast("array<float>").alias("embedding"))
    texts = vectors.select("framework", "pos", F.col("pos").cast("string").alias("id"), F.lit("").alias("title"), F.lit("").alias("description"), F.array().cast("array<string>").alias("tags"))
    stored.update_candidates(texts, folder, vectors, **SETTINGS)
    assert matrices.update_matrices(vectors, folder, **SETTINGS) == 45
    size = sum(file.stat().st_size for name in (matrices.GRIDS, matrices.TILES) for file in Path(folder, name).rglob("*.parquet"))
    assert size < 1_000_000
    grids = matrices.stored_grids(spark, folder, **SETTINGS)
    assert grids.agg(F.sum(F.size("scores"))).first()[0] == 45 * 400 * 400
    plain = similarity.similarity_matrix(vectors, spark.createDataFrame([("2", "7")], "framework_A string, framework_B string"))
    one = matrices.stored_grids(spark, folder, **SETTINGS, pair=("2", "7"), positions=(0, 900), least=0.5)
    assert one.filter("high < 0.5 OR low_A > 900").count() == 0
    same = similarity.matrix_cells(matrices.stored_grids(spark, folder, **SETTINGS, pair=("2", "7"))).withColumn("score", F.round("score", 6))
    assert rows(same) == rows(similarity.matrix_cells(plain).withColumn("score", F.round("score", 6)))


def test_strips_are_made_without_their_cells_leaving_the_task(spark, monkeypatch):
    """The ranges of grids come from the tasks that score them, as the grids themselves would give them."""
    vectors = spark.range(120).select(
        (F.col("id") % 3).cast("string").alias("framework"), F.col("id").alias("pos"),
        F.array(*(F.when(F.col("id") == 5, F.lit(float("nan"))).when(F.col("id") == 8, 0.0).otherwise(F.sin(F.col("id") * (i + 1))) for i in range(8))).cast("array<float>").alias("embedding"))
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    grids = similarity.similarity_matrix(vectors, pairs, rows=16)
    ends = grids.select("framework_A", "framework_B", F.get("pos_A", F.lit(0)).alias("first_A"), F.get("pos_B", F.lit(0)).alias("first_B"), *matrices._ends())
    strips = similarity.matrix_strips(vectors, pairs, rows=16)
    assert rows(strips.withColumns({x: F.col(x).cast("string") for x in ("low", "high")})) == rows(ends.withColumns({x: F.col(x).cast("string") for x in ("low", "high")}))
    monkeypatch.setattr(similarity, "similarity_matrix", None)
    folder = mkdtemp(prefix="run-")
    assert made(spark, folder)[1] == 6


def test_a_score_is_cut_as_round_does(spark):
    values = [0.0, 1.0, 0.5, 0.1234565, 0.123456499999, 0.1234575, 0.000000499999, 0.0000005, 0.999999500001, None] + [round(i / 999983, 12) for i in range(0, 999983, 97)]
    scores = spark.createDataFrame([(x,) for x in values], "score double")
    assert scores.filter(~R.shorter_score(F.col("score"), 6, 12).eqNullSafe(F.round("score", 6))).count() == 0
