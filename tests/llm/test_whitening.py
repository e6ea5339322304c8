"""Whitening against a plain reckoning of the same numbers, exact where they are whole."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cirrolake.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component int, v string, whitened double"


def frame(spark, vectors, ids=None, parts=3, kind="float"):
    rows = [(n if ids is None else ids[n], v, 1, "v", 2.0) for n, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind)).repartition(parts)


def plain(vectors, most=32):
    """n, deviations, whitened rows, explained shares of usable vectors, as whole numbers and fractions."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    away = [[Fraction(n * c - s, n) for c, s in zip(r, sums)] for r in x]
    v = [[sum(r[i] * r[j] for r in away) / n for j in range(d)] for i in range(d)]
    exact = np.array([[float(c) for c in line] for line in v])
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    centred = np.array([[float(c) for c in r] for r in away])
    return n, deviations, centred @ vectors / np.sqrt(values), values / float(sum(v[i][i] for i in range(d)))


def check(spark, vectors, good=None, **how):
    good = list(range(len(vectors))) if good is None else good
    found = whitening.whitened(frame(spark, vectors, **how)).collect()
    n, deviations, white, explained = plain([vectors[i] for i in good])
    assert len(found) == n * len(explained) and {r.n for r in found} == {n}
    got = {(r.vec_id, r.component): r for r in found}
    for k, share in enumerate(explained):
        column = np.array([got[i, k + 1].whitened for i in good])
        sign = np.sign(column @ white[:, k])
        assert np.allclose(column, sign * white[:, k], atol=1e-9)
        assert all(got[i, k + 1].explained == pytest.approx(share, rel=1e-9) for i in good)
    assert [int(got[i, 1].deviation) for i in good] == deviations
    (error,) = {r.identity_error for r in found}
    w = np.array([[got[i, k + 1].whitened for k in range(len(explained))] for i in good])
    assert error == pytest.approx(np.abs(np.cov(w.T, bias=True) - np.eye(len(explained))).max(), abs=1e-12) and error < 1e-9


def normal(n, d, seed=1, spread=lambda i: 1 + i):
    rng = random.Random(seed)
    return [[rng.gauss(0.3, spread(i)) for i in range(d)] for _ in range(n)]


def as_float(vectors):
    return [[float(np.float32(c)) for c in v] for v in vectors]


def test_like_a_plain_reckoning(spark):
    check(spark, as_float(normal(200, 6)))


def test_more_dimensions_than_components(spark):
    check(spark, as_float(normal(120, 40)))


def test_bad_vectors_are_left_out(spark):
    good = as_float(normal(30, 3))
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [-1e30, 0.0, 0.0], [1.0, 2.0], [1.0] * 4]
    check(spark, [*bad, *good], good=list(range(len(bad), len(bad) + 30)))


def test_repeated_rows_and_null_ids(spark):
    vectors = as_float(normal(10, 2))
    found = whitening.whitened(frame(spark, vectors * 3, ids=[None, *range(9)] * 3)).collect()
    assert len(found) == 60 and {r.n for r in found} == {30}
    assert all(len({(r.whitened, r.deviation) for r in found if (r.vec_id, r.component) == (i, 1)}) == 1 for i in [None, *range(9)])


def test_no_usable_rows(spark):
    for vectors in ([], [None, [], [float("nan")]]):
        assert whitening.whitened(spark.createDataFrame([(0, v, 1, "", 1.0) for v in vectors], SCHEMA)).collect() == []


def test_components_without_variance(spark):
    rng = random.Random(3)
    vectors = [[a, 2 * a, 7.0] for a in (float(rng.randrange(100)) for _ in range(40))]
    found = whitening.whitened(frame(spark, vectors)).collect()
    assert {r.component for r in found if r.whitened is None} == {2, 3}
    assert all(r.explained == (r.component == 1) and r.identity_error < 1e-12 for r in found)
    single = whitening.whitened(frame(spark, [[1.0, 2.0]])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.identity_error) for r in single] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]


def test_large_entries_stay_exact(spark):
    """Products beyond 2^53, and sums beyond 2^63."""
    rng = random.Random(4)
    check(spark, [[rng.uniform(-1e14, 1e14), rng.uniform(-1, 1) * 1e12, rng.gauss(0, 1e13)] for _ in range(50)], kind="double")


def test_product_is_exact():
    rng = np.random.default_rng(1)
    for most in (5, 1 << 21, 1 << 55):
        x = rng.integers(-most, most, (300, 4))
        assert (whitening.product(x) == x.astype(object).T @ x.astype(object)).all()


def residuals(a, values, x):
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    size = np.abs(a).max()
    return float(np.abs(a @ x - x * values).max() / size), float(np.abs(x.T @ x - np.eye(len(a))).max())


def rotated(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    q = whitening.near_orthonormal(q.astype(np.longdouble))
    return (q * np.array(values, np.longdouble)) @ q.T, q


def test_vectors_are_right_to_double_precision():
    values = [2.0**-i for i in range(30)]
    a, q = rotated(values)
    found, x = whitening.eigenvectors(a)
    assert max(residuals(a, found, x)) < 1e-17
    assert np.allclose(found.astype(float), values, rtol=0, atol=1e-17)
    assert np.abs(np.abs((q * x).sum(0)) - 1).max() < 1e-16 and np.abs(x[:, :8] - q[:, :8] * np.sign((q * x).sum(0))[:8]).max() < 1e-16


@pytest.mark.parametrize("gap", [1e-4, 1e-7, 1e-9, 1e-11, 0.0])
def test_clusters(gap):
    """Eigenvalues closer than float32 can tell, several to a cluster."""
    values = sorted([1 + i * gap for i in range(5)] + [0.5, 0.5 + gap, 0.1] + [2 + gap * 3 * i for i in range(4)], reverse=True)
    a, q = rotated(values, 2)
    found, x = whitening.eigenvectors(a)
    assert max(residuals(a, found, x)) < 1e-17
    if gap:
        assert np.abs(x - q * np.sign((q * x).sum(0))).max() < 2e-18 / gap


def test_zero_and_diagonal_matrices():
    values, x = whitening.eigenvectors(np.zeros((3, 3)))
    assert values.tolist() == [0, 0, 0] and (x == np.eye(3)).all()
    values, x = whitening.eigenvectors(np.diag([1.0, 5.0, 5.0, 0.0]))
    assert values.tolist() == [5, 5, 1, 0]
