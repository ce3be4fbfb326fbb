"""Tiles around pivots against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossmap.operators import candidates as C
from crossmap.operators import pairs as P
from crossmap.operators import pivots, similarity
from tests.test_similarity import brute_force, hot_vectors, rows


def clustered(spark, clusters=12, spread=0.05, sizes=(("a", 150), ("big", 500), ("c", 120)), width=8):
    """Frameworks whose vectors lie around few directions; one framework has most rows, and a third of it are copies."""
    source = np.random.default_rng(11)
    centres = source.normal(size=(clusters, width))
    found = []
    for framework, n in sizes:
        for pos in range(n):
            vector = centres[pos % clusters] + source.normal(size=width) * spread
            if framework == "big" and pos % 3 == 0:
                vector = centres[0]
            found.append((framework, pos, [float(x) for x in vector]))
    found += [("c", 500, [0.0] * width), ("a", 501, [0.0] * width)]
    return spark.createDataFrame(found, "framework STRING, pos BIGINT, embedding ARRAY<DOUBLE>").repartition(3)


def found(vectors, threshold, k=5, tile_rows=16):
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    cells = similarity.cosine_cells(vectors, pairs, threshold, k, rows=tile_rows, digits=9)
    return rows(C.select_candidates(cells, threshold, k).select(
        "framework_A", "framework_B", "pos_A", "pos_B", F.round("semantic_score", 9), "rank"))


@pytest.mark.parametrize("held", [similarity.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("make, threshold", [(clustered, 0.9), (clustered, 0.3), (hot_vectors, 0.4)])
def test_near_tiles_give_the_whole_result(spark, monkeypatch, held, make, threshold):
    monkeypatch.setattr(similarity, "PRUNED_FROM", 1)
    monkeypatch.setattr(similarity, "FEWEST_ROWS", 8)
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", held)
    vectors = make(spark)
    assert found(vectors, threshold) == brute_force(vectors, threshold, 5)


def test_most_pairs_of_clustered_tiles_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(similarity, "FEWEST_ROWS", 8)
    vectors = clustered(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    report = similarity.pruned_tiles(vectors, pairs, 0.9, rows=16, digits=9).collect()
    kept, skipped = sum(r["kept"] for r in report), sum(r["skipped"] for r in report)
    assert len(report) == 3 and skipped > 2 * kept > 0
    everything = similarity.pruned_tiles(vectors, pairs, -0.5, rows=16, digits=9).collect()
    assert sum(r["skipped"] for r in everything) == 0 and sum(r["kept"] for r in everything) == kept + skipped


def test_no_score_of_a_skipped_pair_reaches_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(similarity, "FEWEST_ROWS", 8)
    vectors = clustered(spark, spread=0.3)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    layout, dimension = similarity._dense_layout(vectors, 16, None)
    placed, near, chosen = pivots.tiled(vectors, layout.counts, 16, dimension)
    members = {}
    for row in placed.collect():
        vector = np.array(row["embedding"])
        length = np.linalg.norm(vector)
        members.setdefault((row["framework"], row["block"]), []).append(vector / length if length else vector)
    assert sum(map(len, members.values())) == vectors.count() and max(map(len, members.values())) <= 2 * 16 + 8
    for threshold in (0.2, 0.6, 0.95):
        skipped = pivots.tile_pairs(near, pairs, chosen, threshold).filter("NOT kept").collect()
        for row in skipped:
            a, b = (np.array(members.get((row[f"framework_{x}"], row[f"block_{x}"]), [])) for x in "AB")
            assert not a.size or not b.size or (a @ b.T).max() < threshold


def test_a_tile_of_b_moves_once_for_several_pairs(spark, monkeypatch):
    """Rows of the shuffled path: each tile of B passes each group of held tiles once."""
    monkeypatch.setattr(similarity, "FEWEST_ROWS", 8)
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(similarity, "MOST_COPIES", 1)
    vectors = clustered(spark)
    pairs = P.framework_pairs(P.frameworks_of(vectors))
    paired = similarity._dense_pairs(vectors, pairs, 16, None)
    passing = paired.rows.filter("side = 1")
    met = passing.agg(F.sum(F.size("partners"))).first()[0]
    assert passing.count() * (similarity.HELD_TILES - 1) < met


def test_vectors_without_direction_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PRUNED_FROM", 1)
    zeros = spark.createDataFrame([(f, i, [0.0, 0.0]) for f in "ab" for i in range(5)], "framework STRING, pos BIGINT, embedding ARRAY<DOUBLE>")
    assert found(zeros, 0.1) == [] == found(zeros.limit(0), 0.1)
    assert len(found(zeros, 0.0)) == 25
