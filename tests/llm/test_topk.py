import random

import numpy as np
import pytest

from crossmap.llm import topk
from tests.llm import data


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "q") for row in rows], "vec_id bigint, embedding array<double>, score string")


def brute(rows, every=20, k=20):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for query in sorted({i for i, _ in good if i % every == 0}):
        own = max(v for i, v in good if i == query)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in good if i != query)[:k]
        out += [(query, rank + 1, i, -score) for rank, (score, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, every=20, k=20):
    table = topk.integer_vectors(vectors(spark, rows))
    return sorted(tuple(r) for r in topk.top_k(table.filter(table.vec_id % every == 0), table, k).collect())


def some(n, width=8, seed=1, zeros=0.0):
    source = random.Random(seed)
    return [(i, [0.0 if source.random() < zeros else source.gauss(0, 0.2) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("zeros", [0.0, 0.5, 0.95])
def test_dense_and_sparse(spark, zeros):
    rows = some(400, zeros=zeros)
    assert found(spark, rows) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 37)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rows = some(300, seed=2)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0]), (7, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (8, [-0.001, 0.0]),
            (20, []), (40, [1.0, 2.0]), (9, [3.0, 3.0]), (9, [3.0, 3.0]), (40, [0.0, 1.0]), (60, [1e6, 1e6])]
    assert found(spark, rows) == brute(rows)


def test_ties_and_few_candidates(spark):
    rows = [(i, [0.5, 0.5]) for i in range(100)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:3]) == brute(rows[:3]) and found(spark, rows[:1]) == []
    assert found(spark, [(1, [1.0])]) == [] == topk.top_k(*[topk.integer_vectors(vectors(spark, rows).limit(0))] * 2).collect()
