import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lectern.llm import whitening
from lectern.llm.whitening import Spectrum, rank_one, secular_roots, whiten


def rebuilt(values, basis):
    return (basis * values) @ basis.T


@given(st.integers(0, 10_000), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_secular_roots(seed, m):
    rng = np.random.default_rng(seed)
    poles = np.sort(rng.choice([1e-6, 1.0, 1e6], m) * rng.random(m) + np.arange(m) * 1e-3)
    weights = rng.random(m) ** 4 * rng.choice([1e-9, 1.0, 1e9])
    roots, diff = secular_roots(poles, weights)
    want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
    scale = max(poles[-1], weights.sum())
    assert np.allclose(roots, want, rtol=0, atol=1e-13 * m * scale)
    assert np.allclose(diff, poles[None, :] - roots[:, None], rtol=0, atol=1e-13 * m * scale)


@pytest.mark.parametrize("kind", ["random", "repeated", "low rank", "equal poles", "zero"])
def test_rank_one_updates_equal_the_scatter(kind):
    rng = np.random.default_rng(3)
    width = 9
    x = rng.normal(size=(60, width))
    if kind == "repeated":
        x = np.repeat(x[:5], 12, axis=0)
    if kind == "low rank":
        x = x[:, :3] @ rng.normal(size=(3, width))
    if kind == "equal poles":
        x = np.concatenate([np.eye(width)] * 6 + [x[:2]])
    if kind == "zero":
        x[:] = 0
    values, basis = np.empty(0), np.empty((width, 0))
    for row in x:
        values, basis = rank_one(values, basis, row)
    want = x.T @ x
    size = max(np.abs(want).max(), 1)
    assert np.abs(rebuilt(values, basis) - want).max() < 1e-12 * size
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), rtol=0, atol=1e-12)
    assert basis.shape[1] <= np.linalg.matrix_rank(x) or kind in ("random", "equal poles")


def test_combined_spectra_are_that_of_all_rows():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 6)) * [9, 5, 3, 1, 0.1, 0.01] + 1e5
    parts = []
    for piece in np.array_split(x, [3, 40, 41, 600]):
        found = Spectrum(0, np.zeros(6))
        for block in np.array_split(piece, 3):
            if len(block):
                found.add(block)
        parts.append(found)
    one = parts[0]
    for other in parts[1:]:
        one.combine(other.n, other.mean, (other.basis * np.sqrt(other.values)).T)
    centred = x - x.mean(axis=0)
    assert one.n == len(x) and np.allclose(one.mean, x.mean(axis=0), rtol=1e-13)
    assert np.allclose(rebuilt(one.values, one.basis), centred.T @ centred, rtol=0, atol=1e-6)


def brute(vectors, k=8):
    """deviation and whitened values, up to the sign of a component."""
    x = np.floor(np.asarray(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    v = (y.T.astype(object) @ y.astype(object) / n**3).astype(np.float64)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return (y * y).sum(axis=1), (y / n) @ axes / np.sqrt(values), values / np.trace(v)


def table(spark, vectors):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_whiten_equals_numpy(spark, parts):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 12)) @ rng.normal(size=(12, 12))
    x[::3] = x[0]  # a third of the rows is one vector
    rows = whiten(table(spark, x.tolist()).repartition(parts)).collect()
    deviation, white, explained = brute(x)
    assert len(rows) == 900 * 8 and {r.n for r in rows} == {900}
    got = np.zeros_like(white)
    for r in rows:
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        got[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_given_table_and_repeated_runs(spark):
    given_rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = whiten(given_rows).collect()
    vectors = [r.embedding for r in given_rows.orderBy("vec_id").collect()]
    deviation, white, _ = brute(vectors)
    got = np.zeros_like(white)
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id]
    assert np.abs(np.abs(got) - np.abs(white)).max() < 1e-7


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (None, [2.0, -1.0], "a"), (3, None, "a"), (4, [None, 1.0], "a"), (5, [nan, 1.0], "a"),
        (6, [inf, 1.0], "a"), (7, [], "a"), (8, [1.0, 2.0, 3.0], "a"), (9, [0.5, 0.25], "a"), (10, [1e300, 0.0], "a"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    got = whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)]
    assert {r.n for r in got} == {4}
    assert whiten(df.limit(0)).collect() == []
    assert whiten(df.filter("vec_id = 1")).collect() == []  # no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r.component for r in whiten(line).collect()} == {1}


def test_a_deviation_beyond_a_long_is_null():
    y = np.array([[1 << 40, 1 << 40], [3, 4]], np.int64)
    assert whitening._deviations(y).to_pylist() == [None, 25]
