import numpy as np
import pytest
from pyspark.sql import functions as F

from terrazone.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int"


def brute(vectors):
    """Whitened entries, shares, deviations and n from a dense decomposition."""
    x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        white = (x - s / n) @ axes / np.sqrt(values)
    return white, values / values.sum(), ((n * x - s) ** 2).sum(1), n


def compare(rows, vectors, wanted):
    white, shares, deviation, n = brute(vectors)
    for k in range(wanted):
        own = sorted((r for r in rows if r["component"] == k + 1), key=lambda r: r["vec_id"])
        got = np.array([r["whitened"] for r in own])
        assert len(own) == len(vectors) and {r["n"] for r in own} == {n}
        assert min(np.abs(got - white[:, k]).max(), np.abs(got + white[:, k]).max()) < 1e-8
        assert [r["deviation"] for r in own] == deviation.tolist()
        assert all(abs(r["explained"] - shares[k]) < 1e-10 for r in own)
    assert {r["identity_error"] for r in rows} and rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("n, size", [(300, 16), (40, 3), (500, 64)])
def test_against_a_dense_decomposition(spark, n, size):
    draw = np.random.default_rng(n)
    vectors = (draw.standard_normal((n, size)) @ draw.standard_normal((size, size)) / size + 0.3).round(3)
    vectors[n // 2:] = vectors[:n - n // 2]  # repeated vectors count once in the fit
    df = spark.createDataFrame([(i, v.tolist(), 7) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(out.collect(), vectors, min(4, size))


@pytest.mark.parametrize("size, spread", [(1, 0), (2, 1), (33, 0), (64, 6), (90, 3)])
def test_components_of_matrices(size, spread):
    draw = np.random.default_rng(size)
    q = np.linalg.qr(draw.standard_normal((size, size)))[0]
    want = np.sort(np.logspace(0, -spread, size) if spread else np.repeat([2.0, 1.0], [size // 2, size - size // 2]))[::-1]  # many equal ones, too
    values, vectors = whitening.components(q * want @ q.T)
    assert np.allclose(values, want, atol=1e-13) and np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-12)
    assert np.allclose(q * want @ q.T @ vectors, vectors * values, atol=1e-12)
    few, some = whitening.components(q * want @ q.T, 3)
    assert np.allclose(few, want[:3]) and some.shape == (size, min(3, size))


def test_polar_factor_is_the_matrix_sign():
    draw = np.random.default_rng(0)
    q = np.linalg.qr(draw.standard_normal((12, 12)))[0]
    values = np.r_[draw.uniform(0.1, 5, 5), -draw.uniform(1e-6, 5, 7)]
    assert np.allclose(whitening.polar_factor(q * values @ q.T), q * np.sign(values) @ q.T, atol=1e-9)


def test_invalid_vectors_lengths_and_clashing_names(spark):
    nan = float("nan")
    rows = [(1, None, 0), (2, [1.0, nan], 0), (3, [1.0, None], 0), (4, [], 0), (5, [float("inf"), 0.0], 0),
            (6, [0.5, 0.0], 0), (None, [0.5, 0.0], 0), (7, [-0.5, 0.25], 0), (7, [-0.5, 0.25], 0), (8, [0.0, -0.0], 0), (9, [1.0], 0), (10, [3.0], 0)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("x")).withColumn("x", F.lit(0))).collect()
    two = [r for r in out if r["vec_id"] not in (9, 10)]
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in two) == sorted((k, c, 3) for k in (0, 6, 7, 7, 8) for c in (1, 2))
    one = {r["vec_id"]: r for r in out if r["vec_id"] in (9, 10)}
    assert [one[9]["whitened"], one[10]["whitened"], one[9]["deviation"], one[9]["explained"]] == [-1.0, 1.0, 512**2, 1.0]
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9


def test_equal_vectors_large_entries_and_empty_table(spark):
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(3)], SCHEMA)).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, 0.0, None)}
    large = whitening.whiten(spark.createDataFrame([(i, [1e9 * i, 1.0 * i], 0) for i in range(4)], SCHEMA)).collect()
    assert all(r["deviation"] is None for r in large) and len(large) == 8
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []


def test_the_fit_is_independent_of_partitions(spark):
    draw = np.random.default_rng(5)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(draw.standard_normal((200, 8)))]
    a, b = ({(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(p)).collect()} for p in (1, 7))
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)
