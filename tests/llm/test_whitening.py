"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest

from tessera.llm import whitening as W


def expected(vectors, wanted=8):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    keep = [k for k in np.argsort(-values)[:wanted] if values[k] > 1e-10 * values.max()]
    return n, ((n * x - sums) ** 2).sum(axis=1), centred @ directions[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def frame(spark, vectors):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")


def check(out, fitted, error, vectors):
    n, deviation, whitened, explained = expected(vectors)
    rows = sorted(out.selectExpr("row.vec_id", "deviation", "whitened").collect())
    got = np.array([r[2] for r in rows]).reshape(len(rows), -1)
    assert fitted.n == n and [r[1] for r in rows] == deviation.tolist()
    assert got.shape == whitened.shape
    assert np.allclose(fitted.values / fitted.trace, explained, rtol=1e-9)
    assert np.abs(got * np.sign((got * whitened).sum(axis=0)) - whitened).max(initial=0) < 1e-7
    assert error is None or error < 1e-9


def test_query_on_messy_vectors(spark, messy_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{messy_dir}/embeddings.parquet").collect()]
    rows = [(i, v + [0.0] * (6 - len(v))) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    n, deviation, whitened, explained = expected([v for _, v in rows])
    got = W.op13_feast_whitening(spark, messy_dir).collect()
    assert len(got) == 6 * len(rows) and {r["n"] for r in got} == {len(rows)}
    key = lambda i, d, c, w: (i is None, i or 0, d, c, round(abs(w), 6))
    want = sorted(key(i, int(d), c + 1, y[c]) for (i, _), d, y in zip(rows, deviation, whitened, strict=True) for c in range(6))
    have = sorted(key(r["vec_id"], r["deviation"], r["component"], r["whitened"]) for r in got)
    assert [w[:4] for w in want] == [h[:4] for h in have]
    assert max(abs(w[4] - h[4]) for w, h in zip(want, have, strict=True)) < 1e-5
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("width, n, rank", [(3, 50, 3), (20, 400, 20), (20, 400, 4), (12, 6, 12), (64, 900, 64)])
def test_against_eigendecomposition(spark, width, n, rank):
    rng = np.random.default_rng(width + rank)
    vectors = (rng.standard_normal((n, rank)) @ rng.standard_normal((rank, width)) if rank < width else rng.standard_normal((n, width))).astype(np.float32)
    if rank < width:
        vectors = np.round(vectors, 0)
    check(*W.whiten(frame(spark, vectors.tolist())), vectors)


def test_equal_eigenvalues_share_an_interval(spark):
    vectors = np.concatenate([np.eye(12), -np.eye(12)])
    out, fitted, error = W.whiten(frame(spark, vectors.tolist()))
    assert np.allclose(fitted.values, fitted.values[0]) and len(fitted.values) == 8
    assert error < 1e-10 and np.allclose(fitted.components @ fitted.components.T, np.eye(8), atol=1e-12)
    assert out.count() == 24


def test_equal_vectors_and_none_have_no_components(spark):
    for vectors in ([[0.5, 0.25]], [[0.5, 0.25]] * 40, [[]], [[], []], []):
        out, fitted, error = W.whiten(frame(spark, vectors))
        assert len(fitted.values) == 0 and error is None
        assert [list(r) for r in out.select("deviation", "whitened").collect()] == [[0, []]] * len(vectors)


def test_large_deviations_are_exact_or_null(spark):
    vectors = [[1e6, 0.0], [-1e6, 1.0], [3e5, 2.0]]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((3 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    out, _, _ = W.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"))
    assert [r[0] for r in out.orderBy("row.vec_id").select("deviation").collect()] == [e if e < 1 << 63 else None for e in exact]
    assert any(e >= 1 << 63 for e in exact)


@pytest.mark.parametrize("spectrum", [np.arange(1, 31) / 7, np.r_[np.ones(10), 1 + 1e-4 * np.arange(20)], np.r_[np.zeros(25), [1, 1, 1, 2, 2]], np.r_[np.full(20, 1e-3), [1e6, 2e3, 5, 5, 5, 4.9999, 4, 3, 2, 1]]])
def test_feast_finds_every_component(spark, spectrum):
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    cov = (basis * spectrum) @ basis.T
    cov = (cov + cov.T) / 2
    values, vectors = W.feast(spark, cov, 8)
    want = np.sort(spectrum)[::-1][:8]
    want = want[want > 0]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9, atol=1e-12 * want[0])
    assert np.allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-9)
    assert np.abs(cov @ vectors.T - vectors.T * values).max() < 1e-11 * want[0]


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for d in (1, 2, 3, 17):
        a = rng.standard_normal((d, d))
        a = a + a.T
        diagonal, off = W.tridiagonal(a)
        values = np.linalg.eigvalsh(a)
        shifts = np.concatenate([values - 1e-9, values + 1e-9, [-100.0, 100.0]])
        assert W.count_above(diagonal, off, shifts).tolist() == [int((values > s).sum()) for s in shifts]
        low, high = W.bracket(diagonal, off, d)
        assert np.allclose(low, values[::-1], atol=1e-11) and np.allclose(high, values[::-1], atol=1e-11)
