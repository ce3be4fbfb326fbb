import numpy as np
import pytest
from pyspark.sql import functions as F

from crossmap.functions import tiles
from crossmap.operators import candidates as C
from crossmap.operators import pairs as P
from crossmap.operators import similarity, views
from crossmap.plans import bindings as B

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()))


def hot_vectors(spark):
    """Three frameworks; one has most of the rows, and a third of all rows are copies."""
    rng = np.random.default_rng(7)
    found = []
    for framework, n in (("a", 40), ("big", 300), ("c", 35)):
        for pos in range(n):
            vector = rng.normal(size=6) if pos % 3 else np.ones(6)
            found.append((framework, pos, [float(x) for x in vector]))
    found.append(("c", 35, [0.0] * 6))
    return spark.createDataFrame(found, "framework STRING, pos BIGINT, embedding ARRAY<DOUBLE>")


def brute_force(df, threshold, k):
    groups = {}
    for framework, pos, vector in df.collect():
        groups.setdefault(framework, []).append((pos, np.array(vector)))
    found = []
    names = sorted(groups)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            for pos_a, u in groups[a]:
                scored = []
                for pos_b, v in groups[b]:
                    length = np.linalg.norm(u) * np.linalg.norm(v)
                    scored.append((-round(float(u @ v / length), 9) if length else 0.0, pos_b))
                best = [s for s in sorted(scored) if -s[0] >= threshold][:k]
                found += [(a, b, pos_a, pos_b, -score, rank + 1) for rank, (score, pos_b) in enumerate(best)]
    return sorted(found)


@pytest.mark.parametrize("tile_rows", [7, 64, 4096])
def test_tile_size_does_not_change_the_result(spark, tile_rows):
    vectors = hot_vectors(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    cells = similarity.cosine_cells(vectors, pairs, 0.4, 5, rows=tile_rows, digits=9)
    found = rows(C.select_candidates(cells, 0.4, 5).select(
        "framework_A", "framework_B", "pos_A", "pos_B", F.round("semantic_score", 9), "rank"
    ))
    assert found == brute_force(vectors, 0.4, 5)


def test_shuffled_tiles_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", 0)
    vectors = hot_vectors(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    cells = similarity.cosine_cells(vectors, pairs, 0.4, 5, rows=40, digits=9)
    found = rows(C.select_candidates(cells, 0.4, 5).select(
        "framework_A", "framework_B", "pos_A", "pos_B", F.round("semantic_score", 9), "rank"
    ))
    assert found == brute_force(vectors, 0.4, 5)


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_rounding_can_lift_a_score_to_the_threshold(digits):
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(600, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    tile = (np.arange(len(unit)), unit, unit.astype(np.float32))
    found = {(int(r), int(c)) for rows_, columns, _ in tiles.dense_best(tile, tile, 0.2, 3, digits) for r, c in zip(rows_, columns)}
    exact = np.round(unit @ unit.T, digits)
    order = np.argsort(-exact, axis=1, kind="stable")[:, :3]
    wanted = {(i, int(j)) for i in range(len(unit)) for j in order[i] if exact[i, j] >= 0.2}
    assert wanted <= found


def test_rough_pass_keeps_what_double_precision_needs():
    rng = np.random.default_rng(3)
    near = rng.normal(size=(1, 32)) + rng.normal(size=(700, 32)) * 1e-5
    mixed = np.vstack([near, rng.normal(size=(300, 32)), np.tile(near[:1], (200, 1))])
    unit = mixed / np.linalg.norm(mixed, axis=1, keepdims=True)
    tile = (np.arange(len(unit)), unit, unit.astype(np.float32))
    found = {}
    for r, c, s in tiles.dense_best(tile, tile, 0.3, 5, 12):
        for row, column, score in zip(r, c, s):
            found.setdefault(int(row), []).append((-float(score), int(column)))
    exact = np.round(np.einsum("id,jd->ij", unit, unit), 12)
    for row in range(len(unit)):
        wanted = sorted((-float(x), j) for j, x in enumerate(exact[row]) if x >= 0.3)[:5]
        got = sorted(found.get(row, []))[:5]
        assert [j for _, j in got] == [j for _, j in wanted] or np.allclose([x for x, _ in got], [x for x, _ in wanted], atol=2e-12, rtol=0)


def test_term_tiles_equal_token_join(spark):
    words = spark.createDataFrame(
        [(f, p, [f"w{(p * i + len(f)) % 9}" for i in range(1, 2 + p % 6)]) for f in ("x", "yy", "zzz") for p in range(30)],
        "framework STRING, pos BIGINT, terms ARRAY<STRING>",
    ).withColumn("weight", F.lit(1))
    weights = words.select("framework", "pos", F.explode("terms").alias("t")).groupBy("framework", "pos", "t").agg(F.count("*").alias("w"))
    norms = weights.groupBy("framework", "pos").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = weights.join(norms, ["framework", "pos"])
    a, b = weights.alias("a"), weights.alias("b")
    wanted = (
        a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.framework") < F.col("b.framework")))
        .groupBy("a.framework", "b.framework", "a.pos", "b.pos", "a.norm", "b.norm").agg(F.sum(F.col("a.w") * F.col("b.w")).alias("dot"))
        .select(F.col("a.framework"), F.col("b.framework"), F.col("a.pos"), F.col("b.pos"), F.round(F.col("dot") / (F.col("a.norm") * F.col("b.norm")), 9).alias("s"))
        .filter("s >= 0.3")
    )
    pairs = P.framework_pairs(P.frameworks_of(words))
    cells = similarity.term_cells(words, pairs, 0.3, 10**6, rows=8, digits=9)
    assert rows(cells) == rows(wanted)


def test_wide_vocabulary_is_worked_off_in_slices(monkeypatch):
    import pyarrow as pa

    def cell(words):
        members = pa.StructArray.from_arrays([pa.array(range(len(words))), pa.array(words)], names=["pos", "payload"])
        return pa.ListArray.from_arrays([0, len(words)], members)[0]

    a = tiles.term_tile(cell([["p", "q", "q"], ["r", "s", "t", "u"], []]))
    b = tiles.term_tile(cell([["q", "u"], ["t", "s", "x", "p"]]))
    whole = tiles.term_scores(a, b)
    monkeypatch.setattr(tiles, "TERMS_AT_ONCE", 2)
    sliced = tiles.term_scores(a, b)
    assert np.allclose(whole, sliced) and whole[2].sum() == 0


def test_threshold_before_rank_equals_rank_before_threshold(spark):
    _, pairs = B.vector_pairs(spark, SF_DIR)
    cells = similarity.cosine_cells(B.vectors(spark, SF_DIR), pairs, -1.0, 10**6).cache()
    first = C.select_candidates(cells, 0.25, 3)
    after = C.select_candidates(cells, -1.0, 3).filter("semantic_score >= 0.25")
    assert rows(first) == rows(after)
    assert first.groupBy("framework_A", "framework_B", "pos_A").count().filter("count > 3").count() == 0


def test_matrix_grids_hold_every_cell(spark):
    vectors = hot_vectors(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    cells = similarity.matrix_cells(similarity.similarity_matrix(vectors, pairs, rows=50))
    summary = {tuple(r)[:2]: r for r in similarity.matrix_summary(vectors, pairs, rows=50).collect()}
    counted = cells.groupBy("framework_A", "framework_B").agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
    assert {(r["framework_A"], r["framework_B"], r["n"]) for r in counted} == {("a", "big", 12000), ("a", "c", 1440), ("big", "c", 10800)}
    assert all(r["low"] >= 0 and r["high"] <= 1 for r in counted)
    assert all(summary[(r["framework_A"], r["framework_B"])]["cells"] == r["n"] for r in counted)
    one = cells.filter("framework_A = 'a' AND framework_B = 'c' AND pos_A = 3 AND pos_B = 6").first()
    assert one["score"] == pytest.approx(1.0)


def test_sample_keeps_every_nth_row_and_column(spark):
    vectors = hot_vectors(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    sample = views.sample_matrix(vectors, pairs)
    big = {r["pos_B"] for r in sample.filter("framework_A = 'a'").filter("framework_B = 'big'").select("pos_B").distinct().collect()}
    assert big == set(range(0, 300, 3))
    assert sample.filter("framework_A = 'a' AND framework_B = 'c'").count() == 40 * 36


def test_pluggable_encoder(spark):
    requirements = B.document_requirements(spark, SF_DIR)

    def encoder(texts):
        return np.stack([[len(t), t.count("e"), t.count("a"), 1.0] for t in texts])

    vectors = similarity.embed(requirements, encoder)
    assert vectors.count() == requirements.count()
    found = C.candidates(requirements, encoder=encoder, threshold=0.9, k=2)
    assert found.count() > 0
    assert found.groupBy("framework_A", "framework_B", "pos_A").count().filter("count > 2").count() == 0


def test_cells_are_merged_inside_a_task(spark):
    import numpy as np

    from crossmap.operators import similarity

    source = np.random.default_rng(4)
    rows = [(name, i, source.normal(size=6).tolist()) for name in "ab" for i in range(64)]
    vectors = spark.createDataFrame(rows, "framework STRING, pos BIGINT, embedding ARRAY<DOUBLE>")
    pairs = spark.createDataFrame([("a", "b")], ["framework_A", "framework_B"])
    cells = similarity.cosine_cells(vectors, pairs, -1.0, 3, rows=8).collect()
    unit = {name: np.array([v / np.linalg.norm(v) for n, _, v in rows if n == name]) for name in "ab"}
    scores = unit["a"] @ unit["b"].T
    wanted = {(i, int(j)) for i in range(64) for j in np.argsort(-scores[i])[:3]}
    assert wanted <= {(c["pos_A"], c["pos_B"]) for c in cells}
    assert len(cells) <= 64 * 3 * 4  # runs of tiles of B for a tile of A, not one set of cells for each of 8 tiles


@pytest.mark.parametrize("k", [1, 3])
def test_what_a_row_has_kept_is_its_floor_in_the_next_tile(k, monkeypatch):
    """Cells below the k-th best of the tiles before are not scored again, and ties go by position."""
    monkeypatch.setattr(tiles, "GROUPS", 4)
    source = np.random.default_rng(3)
    raw = [np.round(source.normal(size=(40, 4))) for _ in range(4)]
    units = [x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9) for x in raw]
    made = [(np.arange(40) + 100 * i, u, u.astype(np.float32)) for i, u in enumerate(units)]
    seen = []

    def cells(a, b, floors):
        for rows_, columns, kept in tiles.dense_best(a, b, floors, k, 9):
            seen.append((floors.copy(), rows_, kept))
            yield rows_, columns, kept

    job = tiles.cell_job(lambda batches, read: (("g", "a", "b", made[0], b) for b in made[1:]), None, cells, k, 0.2)
    found = sorted((r["pos_A"], r["pos_B"], r["semantic_score"]) for batch in job([]) for r in batch.to_pylist())
    wanted = []
    for i in range(40):
        scored = sorted((-round(float(units[0][i] @ b[1][j]), 9), int(b[0][j])) for b in made[1:] for j in range(40))
        wanted += [(i, pos, -s) for s, pos in scored if -s >= 0.2][:k]
    assert [x[:2] for x in found] == [x[:2] for x in sorted(wanted)] and all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(found, sorted(wanted)))
    assert all((kept >= floors[rows_]).all() for floors, rows_, kept in seen) and max(f.max() for f, _, _ in seen) > 0.5
