"""Whitening: spectra against numpy's eigensolver, and the operator end to end."""

from __future__ import annotations

import math

import numpy as np
import pytest

from candlewick.llm import whitening
from candlewick.llm.queries import op12
from candlewick.llm.whitening import Spectrum, add_outer
from tests.conftest import SF01


def _spectrum(x):
    s = Spectrum.empty(x.shape[1])
    for v in x:
        s.add(v)
    return s


def _same(s, x):
    c = x - x.mean(0)
    scatter = c.T @ c
    size = max(1.0, np.abs(scatter).max())
    assert np.abs(s.basis.T @ s.basis - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(s.basis * s.values @ s.basis.T - scatter).max() < 1e-11 * size
    assert np.abs(np.sort(s.values) - np.linalg.eigvalsh(scatter)).max() < 1e-11 * size
    assert np.allclose(s.mean, x.mean(0)) and s.n == len(x)


CASES = {
    "random": lambda r: r.normal(size=(300, 12)) * np.logspace(0, 4, 12),
    "fewer rows than dimensions": lambda r: r.normal(size=(5, 12)),
    "one row": lambda r: r.normal(size=(1, 12)),
    "equal rows": lambda r: np.ones((7, 12)),
    "copies": lambda r: np.repeat(r.normal(size=(9, 12)), 20, axis=0),
    "coarse grid, equal eigenvalues": lambda r: r.integers(-1, 2, (200, 12)).astype(float),
    "axes": lambda r: np.vstack([np.eye(12), -np.eye(12)] * 3),
    "a constant dimension": lambda r: np.hstack([r.normal(size=(60, 11)), np.full((60, 1), 3.0)]),
}


@pytest.mark.parametrize("case", CASES)
def test_rank_one_updates_equal_the_eigendecomposition(case):
    x = CASES[case](np.random.default_rng(5))
    _same(_spectrum(x), x)


def test_merged_and_weighted_spectra():
    x = np.random.default_rng(1).normal(size=(90, 10)) @ np.diag(np.arange(10.0))
    a, b = _spectrum(x[:50]), _spectrum(x[50:])
    a.merge(Spectrum.unpack(b.pack()))
    _same(a, x)
    a.merge(Spectrum.empty(10))
    empty = Spectrum.empty(10)
    empty.merge(a)
    _same(empty, x)
    w = Spectrum.empty(10)
    for v, c in zip(x[:4], (3, 1, 5, 2)):
        w.add(v, c)
    _same(w, np.repeat(x[:4], (3, 1, 5, 2), axis=0))


def test_one_update_on_a_diagonal():
    values, basis = add_outer(np.array([1.0, 1.0, 2.0]), np.eye(3), np.array([1.0, 1.0, 0.0]), 1.0)
    assert np.allclose(values, [1, 2, 3]) and np.allclose(basis * values @ basis.T, [[2, 1, 0], [1, 2, 0], [0, 0, 2]])


def test_op12_equals_brute_force(spark):
    kept = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()
            if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)}
    ids = sorted(kept)
    x = np.floor(1024 * np.array([kept[i] for i in ids], float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    rows = op12(spark, SF01).collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    at = {i: k for k, i in enumerate(ids)}
    got = np.empty((n, 8))
    for r in rows:
        i, k = at[r.vec_id], r.component - 1
        got[i, k] = r.whitened
        assert r.deviation == int(r.deviation_exact) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        assert abs(r.explained / (e[k] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9
    want = y @ q / np.sqrt(e)
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.0, 0.75]), (3, [0.1, nan]), (4, [0.1, inf]), (5, [None, 0.1]),
            (6, None), (7, []), (8, [0.1, 0.2, 0.3]), (9, [-0.5, 0.125])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS whitened", "2 AS n", "3 AS part")
    out = whitening.report(spark, df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == [(i, c) for i in (0, 1, 1, 9) for c in (1, 2)][:2] + [
        (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)]
    x = np.array([[512, 256], [512, 256], [0, 768], [-512, 128]], float)
    e = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert all(abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12 for r in out)
    w = np.array([[r.whitened for r in sorted(out, key=lambda r: (r.vec_id or 0)) if r.component == c] for c in (1, 2)])
    assert np.abs(w @ w.T / 4 - np.eye(2)).max() < 1e-9
    model = whitening.fit(spark, df)
    kept = whitening.transform(spark, df, model)
    assert kept.columns == ["vec_id", "embedding", "n", "part", "deviation", "deviation_exact", "whitened"] and kept.count() == 4


def test_tables_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.report(spark, spark.createDataFrame([], schema)).count() == 0
    assert whitening.report(spark, spark.createDataFrame([(1, None)], schema)).count() == 0
    for rows in ([(1, [0.5, 0.1, 0.2])], [(i, [0.5, 0.1, 0.2]) for i in range(5)]):
        out = whitening.report(spark, spark.createDataFrame(rows, schema)).collect()
        assert len(out) == 3 * len(rows)
        assert all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, 0.0, 0) for r in out)


def test_deviation_beyond_a_long():
    x = np.array([[200_000, 0], [0, 200_000]])
    n = 10**6
    exact = whitening._exact_squares(x, n, [100_000 * n, 100_000 * n])
    assert exact == [2 * (100_000 * n) ** 2] * 2 and exact[0] > whitening.LONGEST
