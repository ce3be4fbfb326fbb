"""Repaired lists against whole new runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossmap.operators import candidates as C
from crossmap.operators import pairs as P
from crossmap.operators import repair, similarity, term_join
from tests.test_similarity import rows
from tests.test_term_join import worded

DENSE = "framework STRING, pos BIGINT, embedding ARRAY<DOUBLE>"


def dense(seed=1, n=60):
    source = np.random.default_rng(seed)
    return {(f, pos): tuple(np.round(source.normal(size=4), 2).tolist()) for f, size in (("a", n), ("big", 4 * n), ("c", n)) for pos in range(size)}


def edited(before, share, seed=5):
    """A copy with rows changed, removed and added, among them copies of other rows."""
    source = np.random.default_rng(seed)
    after = dict(before)
    for key in list(before):
        draw = source.random()
        if draw < share:
            after[key] = tuple(np.round(source.normal(size=4), 2).tolist())
        elif draw < 1.5 * share:
            del after[key]
        elif draw < 2 * share:
            after[(key[0], 1000 + key[1])] = before[list(before)[int(source.integers(len(before)))]]
    return after


def table(spark, listed):
    return spark.createDataFrame([(f, pos, list(v)) for (f, pos), v in listed.items()], DENSE).repartition(3)


def dense_score(threshold, k):
    return lambda vectors, pairs: similarity.cosine_cells(vectors, pairs, threshold, k, rows=50, digits=6)


def whole(vectors, pairs, score, threshold, k):
    return C.select_candidates(score(vectors, pairs), threshold, k)


def plain(selected):
    return rows(selected.select("framework_A", "framework_B", "pos_A", "pos_B", F.round("semantic_score", 6), "rank"))


@pytest.mark.parametrize("share", [0.0, 0.01, 0.2])
@pytest.mark.parametrize("threshold, k", [(0.5, 5), (0.97, 3), (0.1, 1)])
def test_repaired_lists_equal_a_whole_run(spark, share, threshold, k):
    before = dense()
    old, new = table(spark, before), table(spark, edited(before, share))
    pairs = P.framework_pairs(P.frameworks_of(old))
    score = dense_score(threshold, k)
    changed = repair.changes(repair.row_marks(old), repair.row_marks(new))
    found = repair.repaired(whole(old, pairs, score, threshold, k), new, changed, pairs, score, threshold, k)
    assert plain(found.selected) == plain(whole(new, pairs, score, threshold, k))
    counts = found.counts.agg(F.sum("rescored"), F.sum("total")).first()
    assert counts[0] == 0 if share == 0 else counts[0] < counts[1] * (0.3 if share < 0.1 else 2)


def test_changes_of_rows(spark):
    old = table(spark, {("a", 1): (1.0,), ("a", 2): (2.0,), ("a", 3): (3.0,)})
    new = table(spark, {("a", 1): (1.0,), ("a", 2): (5.0,), ("b", 3): (3.0,)})
    assert rows(repair.changes(repair.row_marks(old), repair.row_marks(new))) == [("a", 2, True, True), ("a", 3, True, False), ("b", 3, False, True)]


def test_a_full_list_that_regains_members_is_not_rescored(spark):
    """The lost member is replaced by a better new one, so nothing that was not stored can enter."""
    before = {("a", 0): (1.0, 0.0), ("b", 0): (1.0, 0.1), ("b", 1): (1.0, 0.3), ("b", 2): (1.0, 0.5)}
    after = {key: value for key, value in before.items() if key != ("b", 1)} | {("b", 3): (1.0, 0.0)}
    worse = {key: value for key, value in before.items() if key != ("b", 1)} | {("b", 3): (1.0, 0.9)}
    old = table(spark, before)
    pairs = P.framework_pairs(P.frameworks_of(old))
    score = dense_score(0.5, 2)
    for now, cells in ((after, 1), (worse, 1 + 3)):
        new = table(spark, now)
        changed = repair.changes(repair.row_marks(old), repair.row_marks(new))
        found = repair.repaired(whole(old, pairs, score, 0.5, 2), new, changed, pairs, score, 0.5, 2)
        assert plain(found.selected) == plain(whole(new, pairs, score, 0.5, 2))
        assert found.counts.first()["rescored"] == cells


def test_word_counts(spark):
    old = worded(spark, n=40).select("framework", "pos", "terms")
    new = old.filter("pos % 11 <> 3").withColumn("terms", F.when(F.col("pos") % 13 == 1, F.array(F.lit("s1"), F.lit("the"))).otherwise(F.col("terms")))
    pairs = P.framework_pairs(P.frameworks_of(old))

    def score(words, named):
        sizes = similarity.framework_sizes(words.select("framework"))
        return term_join.term_cells(words, named, 0.3, 4, sizes, digits=6)

    changed = repair.changes(repair.row_marks(old), repair.row_marks(new))
    found = repair.repaired(whole(old, pairs, score, 0.3, 4), new, changed, pairs, score, 0.3, 4)
    assert plain(found.selected) == plain(whole(new, pairs, score, 0.3, 4))
