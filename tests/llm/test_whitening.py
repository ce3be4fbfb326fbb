from fractions import Fraction

import numpy as np
import pytest

from crossmap.llm import feast, whitening
from tests.llm import data

NAN, INF = float("nan"), float("inf")


def symmetric(n, seed=1, spread=1.0):
    source = np.random.default_rng(seed)
    turned, _ = np.linalg.qr(source.standard_normal((n, n)))
    values = np.sort(source.random(n) * spread)[::-1]
    return turned * values @ turned.T


CASES = [symmetric(64), symmetric(30, 2, 1e-20), symmetric(17, 3, 1e20), np.eye(20), np.diag([5, 5, 5, 5, 5, 1, 1.0]), np.diag([1, 1e-3, 1e-6, 1e-9, 0]), np.ones((6, 6)),
         np.diag([3.0, 3 - 1e-9, 3 - 2e-9, 1, 0.5, 0.1]), np.zeros((3, 3)), np.array([[2.0]])]


@pytest.mark.parametrize("case", range(len(CASES)))
@pytest.mark.parametrize("k", [1, 4, 30])
def test_eigenpairs(case, k):
    a = CASES[case]
    values, vectors = feast.greatest(a, k)
    wanted = np.linalg.eigvalsh(a)[::-1][:k]
    size = np.abs(wanted).max() or 1.0
    assert np.allclose(values, wanted, rtol=0, atol=1e-12 * size) and len(values) == min(k, len(a))
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * size
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-7)


def test_inertia_counts():
    a = symmetric(40, 5)
    values = np.linalg.eigvalsh(a)
    shifts = np.linspace(-0.1, 1.1, 50)
    assert feast.above(*feast.tridiagonal(a), shifts).tolist() == [int((values > s).sum()) for s in shifts]


def test_a_missed_pair_is_noticed():
    """A count that the projection cannot confirm is an error, not a result with a component less."""
    with pytest.raises(ArithmeticError):
        feast.eigenpairs(np.diag([3.0, 2, 1]), 1.5, 3.5, 3)


def brute(rows, scale=256):
    """(n, deviations by row, whitened by row, explained) of rows (vec_id, vector), with numpy's own eigenvectors."""
    x = [[int(np.floor(scale * float(v))) for v in vector] for _, vector in rows]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    centred = np.array(fit, float) - mean
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    return n, deviations, (np.array(x, float) - mean) @ vectors / np.sqrt(values), values / np.trace(covariance)


def whitened(spark, rows):
    table = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "vec_id bigint, embedding array<double>, component int")
    return whitening.whiten(table).collect()


def assert_equal(found, rows):
    n, deviations, white, share = brute(rows)
    place = {i: at for at, (i, _) in enumerate(rows)}
    assert sorted((row["vec_id"], row["component"]) for row in found) == sorted((i, c) for i, _ in rows for c in range(1, 5))
    signs = {}
    for row in found:
        at, c = place[row["vec_id"]], row["component"] - 1
        assert row["n"] == n and row["deviation"] == deviations[at]
        assert abs(row["explained"] - share[c]) <= 1e-9 * share[c] and row["identity_error"] < 1e-9
        assert abs(abs(row["whitened"]) - abs(white[at, c])) < 1e-8
        if abs(white[at, c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(row["whitened"]) == np.sign(white[at, c]))
    assert all(len(x) == 1 for x in signs.values())


def some(n, width=12, seed=2, stretch=1.0):
    source = np.random.default_rng(seed)
    return (source.standard_normal((n, width)) * np.linspace(stretch, 0.1, width)).tolist()


@pytest.mark.parametrize("stretch", [0.3, 5.0, 1e9])
def test_whole_result(spark, stretch):
    vectors = some(300, stretch=stretch)
    rows = [(i, vector) for i, vector in enumerate(vectors + vectors[:50] + [vectors[0]] * 200)]
    if stretch < 1e9:
        assert_equal(whitened(spark, rows), rows)
    else:  # deviations beyond 64 bits
        found = whitened(spark, rows)
        assert all(row["deviation"] is None for row in found) and all(row["identity_error"] < 1e-9 for row in found)


def test_table(spark):
    rows = [(i, [float(x) for x in v]) for i, v in data.columns("embeddings", "vec_id", "embedding")]
    assert_equal(whitened(spark, rows), rows)


def test_odd_rows(spark):
    good = some(40, width=5)
    rows = [(i, vector) for i, vector in enumerate(good)]
    odd = [(100, None), (101, [1.0, None, 1.0]), (102, [NAN, 1.0]), (103, [INF, 1.0]), (104, [])]
    zero = [(105, [-0.0, 0.0, 0.0, 0.0, 0.0]), (106, [0.0, -0.0, 0.0, 0.0, 0.0])]
    assert_equal(whitened(spark, rows + odd + zero), rows + zero)
    found = whitened(spark, [(None, good[0]), (1, good[1]), (1, good[1]), *((i, v) for i, v in enumerate(good[2:], 2))])
    assert {row["vec_id"] for row in found} == {None, *range(1, 40)} and {row["n"] for row in found} == {40} and len(found) == 41 * 4


def test_lengths_apart_and_few_vectors(spark):
    long, short = some(30, width=6), some(20, width=3, seed=9)
    found = whitened(spark, [*enumerate(long), *enumerate(short, 100)])
    assert {(row["vec_id"] >= 100, row["n"], row["component"]) for row in found} == {*((False, 30, c) for c in range(1, 5)), *((True, 20, c) for c in range(1, 4))}
    one = whitened(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert [(row["whitened"], row["deviation"], row["explained"], row["identity_error"]) for row in one] == [(None, 0, 0.0, 0.0)] * 4
    two = whitened(spark, [(1, [0.5, 0.25]), (2, [0.0, 0.25])])
    assert sorted((row["vec_id"], row["component"], row["whitened"]) for row in two if row["component"] == 1) == [(1, 1, 1.0), (2, 1, -1.0)]
    assert {row["whitened"] for row in two if row["component"] == 2} == {None}


def test_large_entries(spark):
    rows = [(i, [x * 1e300 for x in vector]) for i, vector in enumerate(some(60, width=5))]
    found, plain = whitened(spark, rows), whitened(spark, [(i, [x / 1e300 * 2.0**40 for x in v]) for i, v in rows])
    for a, b in zip(sorted(found), sorted(plain)):
        assert a["deviation"] is None and abs(a["whitened"] - b["whitened"]) < 1e-6 and a["identity_error"] < 1e-9


def test_empty_table(spark):
    assert whitened(spark, []) == [] == whitened(spark, [(1, None), (2, [])])
