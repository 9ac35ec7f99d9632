"""Whitening against exact fractions and a plain eigenvector computation."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from labelmill.llm import whitening

VECTORS = "vec_id long, embedding array<float>"


def clustered(seed, rows, dimension):
    """Vectors around few directions, with copies; entries are exact in 32 bits."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        near = [rng.gauss(0, 1 + k % 3) + (k == i % 4) * 5 for k in range(dimension)]
        out.append((i, [float(np.float32(c)) for c in near]))
    return out + [(rows + i, out[i % 7][1]) for i in range(rows // 3)]


def plain(rows):
    """n, sums, exact covariance of the different whole vectors."""
    fit = sorted({tuple(math.floor(256 * c) for c in v) for _, v in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n for j in range(d)] for i in range(d)]
    return n, sums, np.array([[float(c) for c in row] for row in cov])


@pytest.mark.parametrize("scale", [1.0, 2.0**14, 2.0**40])
def test_matches_plain_computation(spark, scale):
    """Small entries, and ones whose squares need more than 64 bits."""
    rows = [(i, [c * scale for c in v]) for i, v in clustered(1, 60, 6)]
    got = whitening.whitened_vectors(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    n, sums, cov = plain(rows)
    values, directions = np.linalg.eigh(cov)
    assert len(got) == len(rows) * 4 and {r.n for r in got} == {n}
    vectors = dict(rows)
    for r in got:
        x = [math.floor(256 * c) for c in vectors[r.vec_id]]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert r.deviation == (deviation if deviation < 1 << 63 else None)
        value = values[-r.component]
        assert math.isclose(r.explained, value / np.trace(cov), rel_tol=1e-9)
        turned = sum((a - s / n) * v for a, s, v in zip(x, sums, directions[:, -r.component]))
        assert math.isclose(abs(r.whitened), abs(turned) / math.sqrt(value), rel_tol=1e-6, abs_tol=1e-8)
        assert 0 <= r.identity_error < 1e-9


def test_sums_of_pieces_are_exact():
    rng = np.random.default_rng(2)
    values = rng.integers(-(2**50), 2**50, (40, 3))
    for part in (values, values >> 40):
        found = whitening.squares_of(part)
        for i in range(3):
            assert found[i, i] == sum(int(a) ** 2 for a in part[:, i])
            for j in range(i + 1, 3):
                assert found[i, j] == sum((int(a) + int(b)) ** 2 for a, b in zip(part[:, i], part[:, j]))
    for number in (0, 5, -5, 1 << 200, -(1 << 200) - 1):
        assert sum(d << whitening.DIGIT_BITS * k for k, d in enumerate(whitening.digits(number))) == number


def test_unusable_rows_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]),
        (7, []), (None, [1.5, -1.0]), (8, [-2.0, 0.001]), (8, [-2.0, 0.001]),
    ]
    got = whitening.whitened_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.component, r.vec_id or 0) for r in got) == [(k, i) for k in (1, 2) for i in (0, 1, 8, 8)]
    assert {r.n for r in got} == {3} and all(r.identity_error < 1e-9 for r in got)


def test_without_spread(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], VECTORS)
    for r in whitening.whitened_vectors(same).collect():
        assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], VECTORS)
    got = whitening.whitened_vectors(line).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in got)
    assert all(r.explained == pytest.approx(float(r.component == 1), abs=1e-9) for r in got)


def test_empty_and_other_columns(spark):
    rows = [(1, [1e308, 0.0], 5, "a"), (2, [-1e308, 1.0], 6, "b"), (3, [0.0, 0.5], 7, "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string")
    got = whitening.whitened_vectors(frame).collect()
    assert sorted({r.vec_id for r in got}) == [1, 2, 3] and {r.n for r in got} == {3}
    assert whitening.whitened_vectors(frame.limit(0)).count() == 0
    assert whitening.whitened_vectors(spark.createDataFrame([(1, None)], VECTORS)).count() == 0
