import math

import numpy as np
import pytest

from loomdex.llm import whitening


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    return (q * np.asarray(values, float)) @ q.T


SPECTRA = {
    "spread": np.linspace(1, 64, 64), "falling": 10.0 ** -np.arange(12), "one": [3.0], "two": [5.0, 1.0],
    "equal": [2.0] * 6, "groups": [9.0] * 3 + [4.0] * 3 + [1.0] * 10, "lone": [1e6] + [1.0] * 15, "zeros": [7.0, 3.0] + [0.0] * 6,
    "near": [1.0, 1.0 + 1e-9, 2.0, 2.0 + 1e-12, 5.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components_are_those_of_a_dense_solver(name):
    spectrum = np.sort(np.asarray(SPECTRA[name], float))[::-1]
    a = symmetric(spectrum)
    a = (a + a.T) / 2
    wanted = min(8, len(a))
    values, vectors = whitening.components(a, wanted)
    scale = np.linalg.norm(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:wanted], rtol=0, atol=1e-13 * scale)
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * scale
    assert np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-13)


def test_all_components_rebuild_the_matrix():
    a = symmetric(np.random.default_rng(3).normal(size=30))
    values, vectors = whitening.components(a, 30)
    assert np.allclose((vectors * values) @ vectors.T, a, atol=1e-12)


def test_diagonal_and_tied_matrices():
    values, vectors = whitening.components(np.diag([1.0, 3.0, 2.0]), 3)
    assert values.tolist() == [3, 2, 1] and np.abs(vectors).tolist() == [[0, 0, 1], [1, 0, 0], [0, 1, 0]]
    values, _ = whitening.components(np.array([[0.0, 1.0], [1.0, 0.0]]), 2)
    assert np.allclose(values, [1, -1])


def test_polar_factor_is_the_sign():
    a = symmetric([3.0, 1e-6, -1e-9, -2.0])
    values, vectors = np.linalg.eigh((a + a.T) / 2)
    assert np.allclose(whitening.polar_factor((a + a.T) / 2), (vectors * np.sign(values)) @ vectors.T, atol=1e-6)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_rows_as_in_brute_force(spark):
    rng = np.random.default_rng(1)
    data = (rng.normal(size=(400, 12)) * np.linspace(0.05, 0.6, 12) + 0.3).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)]
    odd = [(500, None, 0), (501, [float("nan")] * 12, 0), (502, [None] + [0.1] * 11, 0), (503, [float("inf")] * 12, 0), (504, [], 0), (505, [1.0], 0)]
    got = whitening.whitened_rows(vectors_of(spark, rows + odd)).collect()
    x = np.floor(1024 * data.astype(float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    far = x - total / n
    spread = far.T @ far / n
    values, basis = np.linalg.eigh(spread)
    values, basis = values[::-1][:8], basis[:, ::-1][:, :8]
    expected = far @ basis / np.sqrt(values)
    z = np.zeros((n, 8))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r.vec_id], total))
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(spread), rel_tol=1e-9) and r.identity_error < 1e-9
    assert len(got) == 8 * n
    assert np.allclose(z * np.sign((z * expected).sum(axis=0)), expected, atol=1e-8)
    assert np.isclose(got[0].identity_error, np.abs(np.cov(z.T, bias=True) - np.eye(8)).max(), atol=1e-11)


def test_defined_cases(spark):
    whole = whitening.whitened_rows
    assert whole(vectors_of(spark, [])).collect() == []
    assert whole(vectors_of(spark, [(1, None, 0), (2, [None], 0)])).collect() == []
    lone = whole(vectors_of(spark, [(1, [0.5, 0.25], 0)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in lone] == [(c, 1, 0, None, None, None) for c in (1, 2)]
    line = whole(vectors_of(spark, [(1, [0.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [2.0, 0.0], 0), (4, [1.0, 0.0], 0)])).collect()
    first = sorted(abs(r.whitened) for r in line if r.component == 1)
    assert np.allclose(first, [0, 0, math.sqrt(2), math.sqrt(2)]) and {r.whitened for r in line if r.component == 2} == {None}
    assert all(r.identity_error < 1e-12 for r in line) and {r.explained for r in line} == {1.0, 0.0}
    huge = whole(vectors_of(spark, [(1, [3e38, 0.0], 0), (2, [-3e38, 0.5], 0), (3, [1.0, 1.0], 0)])).collect()
    assert len(huge) == 6
    clash = vectors_of(spark, [(1, [0.0], 0), (2, [1.0], 0)]).selectExpr("*", "1 as x", "2 as z", "3 as n", "4 as deviation", "5 as v")
    assert [round(r.whitened) for r in whole(clash).orderBy("vec_id").collect()] in ([-1, 1], [1, -1])


def test_extremes_have_no_wrapped_numbers(spark):
    rows = [(i, [1e30 if i % 2 else -1e30] * 4, 0) for i in range(50)]
    got = whitening.whitened_rows(vectors_of(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} and all(r.whitened is None or abs(abs(r.whitened) - 1) < 1e-9 for r in got)
