"""Whitening against the dense eigenvectors of numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.llm.queries import op13_embedding_whitening
from wardlens.llm.whitening import corrections, jacobi_davidson, whiten

SF = "/root/testdata/sf0.001"


def dense(vectors, components):
    """Covariance, its leading eigenpairs and the exact deviations, from collected rows."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    far = n * x - sums
    v = (far / n).T @ (far / n) / n
    values, axes = np.linalg.eigh(v)
    return n, (far * far).sum(axis=1), far / n, v, values[::-1][:components], axes[:, ::-1][:, :components]


def compare(got, ids, vectors, components):
    n, deviation, centred, v, values, axes = dense(vectors, components)
    assert len(got) == n * len(values)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, [None] * len(values))[r.component - 1] = r
    whole = np.array([[r.whitened for r in by_id[i]] for i in ids])
    for i, d in zip(ids, deviation):
        assert {(r.n, r.deviation) for r in by_id[i]} == {(n, int(d))}
    explained = [r.explained for r in by_id[ids[0]]]
    assert np.allclose(explained, values / np.trace(v), rtol=1e-9)
    own = whole - whole.mean(axis=0)
    error = np.abs(own.T @ own / n - np.eye(len(values))).max()
    assert error < 1e-9 and abs(error - got[0].identity_error) < 1e-9
    # Eigenvectors are unique up to their sign only where eigenvalues are apart: compare residuals instead.
    found = np.linalg.lstsq(centred, whole, rcond=None)[0] * np.sqrt(values)
    assert np.abs(v @ found - found * values).max() < 1e-9 * values[0]
    apart = np.abs(np.subtract.outer(values, np.linalg.eigvalsh(v))) < 1e-6 * values[0]
    for k in np.flatnonzero(apart.sum(axis=1) == 1):
        plain = centred @ axes[:, k] / np.sqrt(values[k])
        assert min(np.abs(plain - whole[:, k]).max(), np.abs(plain + whole[:, k]).max()) < 1e-8


def test_registered_query_equals_dense_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = op13_embedding_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 32)


def make(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}")


def test_unsound_vectors_are_left_out(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(4).astype(float).tolist()) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0])]
    got = whiten(make(spark, good + bad, "array<double>")).collect()
    compare(got, [i for i, _ in good], [v for _, v in good], 32)


def test_few_directions_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a), float(b), 1.0, float(a)]) for i, (a, b) in enumerate(rng.standard_normal((20, 2)) * 9)]
    rows = [*rows, rows[0], (None, rows[1][1])]
    got = whiten(make(spark, rows, "array<double>")).collect()
    assert len(got) == 22 * 2  # neither the constant nor the repeated dimension adds a direction
    assert {r.component for r in got} == {1, 2}
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_varies(spark, rows):
    got = whiten(make(spark, rows))
    assert got.collect() == []
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_extra_columns_with_clashing_names(spark):
    rows = make(spark, [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [0.0, 0.5])])
    clash = rows.withColumns({c: F.lit(1) for c in ("x", "deviation", "w", "at", "component", "n", "whitened", "dims")})
    assert sorted(whiten(clash).collect()) == sorted(whiten(rows).collect())


@pytest.mark.parametrize("dims", [3, 40, 150])
@pytest.mark.parametrize("kind", ["flat", "falling", "singular", "repeated"])
def test_iteration_reaches_double_precision(dims, kind):
    rng = np.random.default_rng(dims)
    base, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    spectrum = {
        "flat": 1 + rng.random(dims), "falling": 0.7 ** np.arange(dims),
        "singular": np.where(np.arange(dims) < dims // 3, 2.0, 0.0), "repeated": np.repeat([5.0, 2.0, 1.0], dims)[:dims],
    }[kind]
    v = (base * spectrum) @ base.T
    passes = []
    values, axes = jacobi_davidson(lambda b: passes.append(1) or v @ b, dims, 32)
    assert np.abs(values - np.sort(spectrum)[::-1][:32]).max() < 1e-12 * spectrum.max()
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 4 * dims * 2.3e-16 * spectrum.max()
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert len(passes) < 80


def test_inner_solver_solves_the_projected_equations():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    fixed, _ = np.linalg.qr(rng.standard_normal((12, 2)))
    r = rng.standard_normal((12, 3))
    theta = np.array([0.3, -0.2, 1.0])
    got = corrections(lambda b: a @ b, theta, r, fixed, steps=40)
    p = np.eye(12) - fixed @ fixed.T
    for j in range(3):
        assert np.abs(p @ (a - theta[j] * np.eye(12)) @ p @ got[:, j] + p @ r[:, j]).max() < 1e-8
        assert np.abs(fixed.T @ got[:, j]).max() < 1e-9
