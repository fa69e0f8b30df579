import random
from fractions import Fraction

import numpy as np
import pytest

from textgrain.llm.whitening import (
    characteristic_polynomial,
    component,
    fit_whitening,
    isolated_root,
    lifted,
    modular_polynomials,
    primes_beyond,
    roots_above,
    whiten,
)


def by_expansion(matrix):
    """Coefficients of det(z - matrix) by the traces of powers, in fractions."""
    size = len(matrix)
    found, work = [Fraction(1)], [[Fraction(0)] * size for _ in range(size)]
    for k in range(1, size + 1):
        for i in range(size):
            work[i][i] += found[-1]
        work = [[sum(matrix[i][t] * work[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
        found.append(-sum(work[i][i] for i in range(size)) / k)
    return [int(c) for c in reversed(found)]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_polynomial_is_exact(spark, size):
    source = random.Random(size)
    rows = [[source.randint(-(10**9), 10**9) for _ in range(size)] for _ in range(size + 1)]
    matrix = [[sum(r[i] * r[j] for r in rows) for j in range(size)] for i in range(size)]
    assert characteristic_polynomial(spark, matrix) == by_expansion(matrix)
    primes = primes_beyond(2**40)
    zero = [[0] * size for _ in range(size)]
    assert lifted(modular_polynomials(zero, primes).tolist(), primes) == [0] * size + [1]


def test_roots_are_counted_and_isolated():
    polynomial = [1]
    for root in (0, 3, 3, 5, 10**12):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    assert [roots_above(polynomial, p) for p in (0, 2, 3, 4, 5, 10**12)] == [4, 4, 2, 2, 1, 0]
    for number, root, before, count in ((1, 10**12, 0, 1), (2, 5, 1, 1), (3, 3, 2, 2), (4, 3, 2, 2)):
        value, scale, above, held = isolated_root(polynomial, number, 10**12)
        assert abs(Fraction(value, 2**scale) - root) <= Fraction(root, 2**139)
        assert (above, held) == (before, count)


def test_equal_roots_give_orthogonal_components():
    matrix = [[9 if i == j else 0 for j in range(4)] for i in range(4)]
    matrix[3][3] = 4
    polynomial = by_expansion(matrix)
    found = [component(matrix, polynomial, k, 1) for k in (1, 2, 3, 4)]
    assert [value for value, _ in found] == [9.0, 9.0, 9.0, 4.0]
    basis = np.array([vector for _, vector in found])
    assert np.abs(basis @ basis.T - np.eye(4)).max() < 1e-14


def brute(vectors, count):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n = len(x)
    centred = x - x.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:count]
    deviation = [sum(int(n * v - s) ** 2 for v, s in zip(row, x.sum(0))) for row in x]
    return n, deviation, centred @ basis[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_rows_equal_a_plain_decomposition(spark):
    source = np.random.default_rng(3)
    good = (source.normal(size=(300, 12)) * np.linspace(1, 3, 12) + 0.5).astype(np.float32)
    rows = [(i, [float(v) for v in vec]) for i, vec in enumerate(good)]
    rows += [rows[7], (None, rows[9][1])]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0, 2.0]), (905, [])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS vec", "3 AS n").repartition(5)
    got = whiten(table, fit_whitening(table)).collect()
    n, deviation, whitened, explained = brute([v for _, v in rows], 8)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    expected = {}
    for (key, _), d, w in zip(rows, deviation, whitened):
        expected.setdefault(key, []).append((d, w))
    signs = {}
    for row in got:
        d, w = expected[row.vec_id][0]
        k = row.component - 1
        assert row.deviation == d
        assert row.explained == pytest.approx(explained[k], rel=1e-9)
        signs.setdefault(k, np.sign(row.whitened * w[k]) if abs(w[k]) > 1e-6 else 1)
        assert row.whitened == pytest.approx(signs[k] * w[k], abs=1e-8)
        assert 0 <= row.identity_error < 1e-9


def test_few_rows_few_dimensions_and_no_variance(spark):
    schema = "vec_id long, embedding array<double>"
    empty = spark.createDataFrame([(1, None)], schema)
    assert whiten(empty, fit_whitening(empty)).count() == 0
    assert whiten(empty.limit(0), fit_whitening(empty.limit(0))).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25, 1.0])], schema)
    got = whiten(one, fit_whitening(one)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got, key=lambda r: r.component)] == [(k, 1, 0, 0.0, 0.0, 0.0) for k in (1, 2, 3)]
    two = spark.createDataFrame([(1, [0.0, 1.0, 0.0]), (2, [2.0, 1.0, 0.0])], schema)
    got = {(r.vec_id, r.component): (r.whitened, r.explained) for r in whiten(two, fit_whitening(two)).collect()}
    assert got[1, 1] == (-1.0, 1.0) and got[2, 1] == (1.0, 1.0)
    assert got[1, 2] == got[2, 3] == (0.0, 0.0)


def test_huge_components(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1e9, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whiten(table, fit_whitening(table)).collect()}
    assert len(got) == 6 and got[1, 1].deviation is None
    assert got[1, 1].whitened == pytest.approx(1.5**0.5) and got[1, 1].identity_error < 1e-9
