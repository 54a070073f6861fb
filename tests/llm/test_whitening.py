import numpy as np
import pytest

from anchorline.llm import whitening as wh

DDL = "vec_id long, embedding array<float>"


def plain(x, k=32):
    """Whitened rows, explained shares and variances by numpy's own solver."""
    c = x - x.mean(axis=0)
    v = c.T @ c / len(x)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    k = int((e > 1e-12 * e[0]).sum())
    return c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v)


def steps(rows):
    return np.floor(64 * np.array(rows, np.float32).astype(float)) + 1_000_000


def result(df):
    p = df.toPandas()
    k = p.component.max()
    p = p.sort_values(["vec_id", "component"])
    return p, p.whitened.to_numpy().reshape(-1, k)


def gaussian(n, d, seed=1, scale=None):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * (scale if scale is not None else np.linspace(1, 4, d))) @ np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize("n,d", [(500, 40), (90, 3), (2, 5), (20, 33)])
def test_against_a_plain_solver(spark, n, d):
    rows = gaussian(n, d).astype(np.float32).astype(float).tolist()
    p, y = result(wh.op12(spark.createDataFrame(list(enumerate(rows)), DDL).repartition(7)))
    want, explained = plain(steps(rows))
    assert y.shape == want.shape
    assert np.abs(y * np.sign((y * want).sum(axis=0)) - want).max() < 1e-8
    assert np.allclose(p.explained.to_numpy()[: len(explained)], explained, rtol=1e-9)
    assert p.identity_error.nunique() == 1 and p.identity_error[0] < 1e-9 and set(p.n) == {n}
    x = steps(rows).astype(int).tolist()
    sums = [sum(c) for c in zip(*x)]
    assert p.deviation.to_numpy().reshape(n, -1)[:, 0].tolist() == [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]


def test_dropped_rows_nulls_short_vectors_and_repeats(spark):
    rows = [(i, r) for i, r in enumerate(gaussian(60, 4).astype(np.float32).astype(float).tolist())]
    odd = [(70, None), (71, [1.0, None, 1.0, 1.0]), (72, [float("nan")] * 4), (73, [float("-inf"), 0.0, 0.0, 0.0])]
    more = [(80, [1.0]), (81, []), rows[0], (None, rows[3][1])]
    p = wh.op12(spark.createDataFrame(rows + odd + more, DDL)).toPandas()
    kept = [r for _, r in rows + more]
    want, _ = plain(steps([[*r, 0, 0, 0, 0][:4] for r in kept]))
    assert len(p) == want.size and set(p.n) == {64} and p.vec_id.isna().sum() == 4
    assert len(p[p.vec_id == 0]) == 8 and p.identity_error[0] < 1e-9
    assert np.allclose(np.sort(np.abs(p.whitened)), np.sort(np.abs(want.ravel())))


def test_without_variance_there_are_no_rows(spark):
    assert wh.op12(spark.createDataFrame([], DDL)).count() == 0
    assert wh.op12(spark.createDataFrame([(1, [0.5, 0.5])] * 4, DDL)).count() == 0
    assert wh.op12(spark.createDataFrame([(1, []), (2, [])], DDL)).count() == 0
    assert wh.op12(spark.createDataFrame([(1, None)], DDL)).count() == 0
    # a constant and a repeated dimension
    rows = [(i, [float(i % 7), 2.0, float(i % 7), float(i % 3)]) for i in range(42)]
    p, y = result(wh.op12(spark.createDataFrame([(*r, 1) for r in rows], DDL + ", n int")))
    want, _ = plain(steps([r for _, r in rows]))
    assert y.shape == want.shape == (42, 2) and np.abs(np.abs(y) - np.abs(want)).max() < 1e-8


def test_the_tree_of_factors_holds_the_whole(spark, monkeypatch):
    monkeypatch.setattr(wh, "FAN", 2)
    rows = gaussian(300, 5).astype(np.float32).astype(float).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), DDL).repartition(11)
    got = wh.usable(df)
    mean = wh.mean_of(got)
    r = wh.factor(got, mean)
    c = steps(rows) - steps(rows).mean(axis=0)
    assert mean.sums == tuple(steps(rows).sum(axis=0).astype(int).tolist())
    assert np.allclose(r.T @ r, c.T @ c)


def test_bidiagonal_form():
    r = np.triu(np.random.default_rng(2).normal(size=(9, 9)))
    a, b, p = wh.bidiagonal(r)
    product = p.T @ r.T @ r @ p
    assert np.allclose(p.T @ p, np.eye(9)) and np.allclose(np.diag(product, 1), a[:-1] * b)
    assert np.abs(np.triu(product, 2)).max() < 1e-12


@pytest.mark.parametrize("values", [
    np.logspace(0, -12, 20), np.ones(12), np.array([1.0, 1.0, 1.0, 0.5, 0.5, 0.1]), np.array([1, 1 - 1e-9, 1 - 2e-9, 0.3]), np.array([3.0]), np.array([2.0, 1.0, 0, 0]),
])
def test_spectrum_graded_repeated_and_singular(values):
    rng = np.random.default_rng(3)
    d = len(values)
    u, v = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    r = np.linalg.qr(u @ np.diag(values) @ v.T, mode="r")
    got, vectors = wh.spectrum(r)
    assert np.allclose(np.sqrt(got), values, rtol=1e-10, atol=1e-14 * values[0])
    kept = vectors[got > 1e-24 * got[0]]
    assert np.abs(vectors @ vectors.T - np.eye(d))[: len(kept), : len(kept)].max() < 1e-8
    for s, z in zip(got, vectors):
        assert np.linalg.norm(r.T @ (r @ z) - s * z) < 1e-10 * values[0] ** 2


def test_dqds_keeps_small_values_accurate():
    a, b = np.logspace(0, -9, 25), np.logspace(0, -9, 25)[:-1] * 0.3
    want = np.linalg.svd(np.diag(a[::1]) + np.diag(b, 1), compute_uv=False) ** 2
    got = wh.dqds(a, b)
    assert np.allclose(got, want, rtol=1e-6) and np.allclose(got.prod(), (a * a).prod(), rtol=1e-12)


def test_deviation_beyond_64_bits_is_null():
    assert wh.deviations(np.array([[2**31, 2**31], [3_000_000_000, 3_000_000_000]])) == [None, None]
    assert wh.deviations(np.array([[2**31, 2**30], [3, 4]])) == [2**62 + 2**60, 25]
