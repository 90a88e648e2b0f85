import numpy as np
import pytest

from kerbflow.llm import whitening as W


def matrix(kind, n, seed=1):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {"random": rng.random(n) * 10, "repeated": np.repeat([1.0, 2.0, 3.0, 4.0], n // 4), "close": 1 + 1e-9 * rng.random(n),
              "wide": 10.0 ** -np.arange(n), "low rank": np.r_[np.zeros(n - 3), 1, 2, 3], "equal": np.ones(n), "zero": np.zeros(n),
              "both signs": rng.standard_normal(n)}[kind]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("n", [4, 12, 64])
@pytest.mark.parametrize("kind", ["random", "repeated", "close", "wide", "low rank", "equal", "zero", "both signs"])
def test_components_are_eigenvectors_to_double_precision(kind, n):
    v = matrix(kind, n)
    values, vecs = W.spectral_components(v)
    size = max(np.linalg.norm(v), 1e-300)
    assert np.abs(values - np.sort(np.linalg.eigvalsh(v))[::-1]).max() <= 1e-13 * n * size
    assert np.linalg.norm(v @ vecs - vecs * values) <= 1e-13 * n * size
    assert np.linalg.norm(vecs.T @ vecs - np.eye(n)) <= 1e-13 * n


def test_polar_factor_has_eigenvalues_of_one():
    a = matrix("both signs", 20)
    u = W.polar_factor(a)
    assert np.linalg.norm(u @ u - np.eye(20)) < 1e-12
    h = u.T @ a
    assert np.linalg.norm(h - h.T) < 1e-12 and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-12


def vectors(n=700, d=10, seed=4):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * 0.1 + rng.standard_normal(d)).astype(np.float32)


def test_rows_match_brute_force(spark):
    c = vectors()
    bad = [(900, None), (901, []), (902, [float("nan")] * 10), (903, [1.0] * 9 + [None]), (904, [float("inf")] * 10), (905, [0.0] * 3), (906, [1e30] * 10)]
    rows = [(int(i) if i else None, [float(x) for x in v]) for i, v in enumerate(c)] + [(5, [float(x) for x in c[5]])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows + bad], "vec_id long, embedding array<float>, whitened double").repartition(6)
    got = W.whiten(df).collect()
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    white = y @ u / np.sqrt(e)
    want = sorted((i is None, i or 0, k + 1, n, int(d), round(abs(w), 7)) for (i, _), d, ws in zip(rows, ((n * x - s) ** 2).sum(axis=1), white)
                  for k, w in enumerate(ws[:8]))
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n, r.deviation, round(abs(r.whitened), 7)) for r in got) == want
    for k in range(8):
        mine = {(r.explained, r.identity_error) for r in got if r.component == k + 1}
        assert len(mine) == 1 and abs(mine.pop()[0] - e[k] / e.sum()) < 1e-12
    error = got[0].identity_error
    assert 0 <= error < 1e-10
    by = {k: [r.whitened for r in sorted((r for r in got if r.component == k), key=lambda r: (r.vec_id is None, r.vec_id or 0))] for k in range(1, 9)}
    cov = np.cov(np.array([by[k] for k in range(1, 9)]), bias=True)
    assert abs(np.abs(cov - np.eye(8)).max() - error) < 1e-12


def test_few_dimensions_constant_ones_and_nothing(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, [float(rng.random()), 1.0, float(rng.random())]) for i in range(50)], "vec_id long, embedding array<float>")
    assert {r.component for r in W.whiten(df).collect()} == {1, 2}          # the constant dimension has no component
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    for empty in (same, same.limit(0), spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")):
        out = W.whiten(empty)
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_64_bits_on_the_way(spark):
    far = [(i, [float(v)]) for i, v in enumerate([2.0 ** 21, -2.0 ** 21] * 2 + [1.0])]
    got = {r.vec_id: r.deviation for r in W.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()}
    x = [int(1024 * v[0]) + 100_000 for _, v in far]
    for i, v in enumerate(x):
        exact = (5 * v - sum(x)) ** 2
        assert got[i] == (exact if exact < 2 ** 63 else None)
    assert None in got.values() or max(got.values()) > 2 ** 60
