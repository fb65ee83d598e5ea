"""Whitening against numpy's own decomposition and integers of any length."""

import math

import numpy as np
import pytest

from barsmith.llm import whitening
from barsmith.llm.queries import op11_whitening
from conftest import SF_SMALL

RNG = np.random.default_rng(3)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, component string, n int")


@pytest.mark.parametrize("rank", [1, 5, 12])
def test_factor_and_jacobi_give_the_eigenvectors(rank):
    b = RNG.normal(size=(12, rank)) * 10.0 ** -np.arange(rank)
    a = b @ b.T
    factor = whitening.pivoted_cholesky(a)
    assert factor.shape[1] <= rank and np.allclose(factor @ factor.T, a, atol=1e-12 * np.abs(a).max())
    value, unit = whitening.jacobi(factor)
    assert np.allclose(unit.T @ unit, np.eye(len(value)), atol=1e-9)
    assert np.allclose(value, np.linalg.eigvalsh(a)[::-1][:len(value)], rtol=1e-6, atol=1e-15 * value[0])
    assert np.allclose(a @ unit, unit * value, atol=1e-11 * value[0])
    assert (np.diff(value) <= 0).all()


def test_factor_is_triangular_in_the_order_of_its_pivots():
    b = RNG.normal(size=(9, 9))
    factor = whitening.pivoted_cholesky(b @ b.T)
    order = [int(np.flatnonzero(factor[:, k] * (factor[:, k + 1:] == 0).all(axis=1))[0]) if k < 8 else -1 for k in range(9)]
    assert len(set(order[:8])) == 8


def test_query_equals_numpy(spark):
    got = op11_whitening(spark, SF_SMALL).toPandas()
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    x = {r.vec_id: [math.floor(1024 * c) + 100000 for c in r.embedding] for r in rows}
    n, total = len(x), [sum(col) for col in zip(*x.values())]
    assert len(got) == 8 * n and set(got.n) == {n}
    away = {i: sum((n * a - s) ** 2 for a, s in zip(v, total)) for i, v in x.items()}
    assert all(away[i] == d for i, d in zip(got.vec_id, got.deviation))
    m = np.array([x[i] for i in sorted(x)], dtype=float) - np.array(total) / n
    cov = m.T @ m / n
    value, vec = np.linalg.eigh(cov)
    value, vec = value[::-1][:8], vec[:, ::-1][:, :8]
    w = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    mine = m @ vec / np.sqrt(value)
    mine *= np.sign((mine * w).sum(axis=0))
    assert np.allclose(w, mine, atol=1e-7)
    share = got.groupby("component").explained.agg(["min", "max"])
    assert (share["min"] == share["max"]).all() and np.allclose(share["min"], value / np.trace(cov), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    c = w - w.mean(axis=0)
    assert np.allclose(c.T @ c / n, np.eye(8), atol=1e-9)


def test_unusable_vectors_take_no_part(spark):
    good = [(i, [float(a) for a in RNG.normal(size=3)], "a", "b", 1) for i in range(40)]
    good += [good[0], (None, [0.5, 0.25, 1.0], "a", "b", 1)]
    bad = [(100, None, "a", "b", 1), (101, [], "a", "b", 1), (102, [1.0, None, 2.0], "a", "b", 1), (103, [1.0, float("nan"), 2.0], "a", "b", 1),
           (104, [1.0, float("inf"), 2.0], "a", "b", 1), (105, [1.0, 2.0], "a", "b", 1), (106, [1.0, 1e300, 2.0], "a", "b", 1)]
    df = frame(spark, good + bad)
    model = whitening.fit(df)
    got = whitening.whiten(df, model, k=8).toPandas()
    assert model.n == 42 and set(got.component) == {1, 2, 3} and len(got) == 3 * 42
    assert got.id.isna().sum() == 3 and not set(got.id.dropna()) & set(range(100, 107))
    assert whitening.identity_error(df, model, 8) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "a", "b", 1)], [(i, [1.0, 2.0], "a", "b", 1) for i in range(5)], [(1, None, "a", "b", 1)]])
def test_no_variance_gives_no_row(spark, rows):
    df = frame(spark, rows)
    assert whitening.whiten(df, whitening.fit(df)).count() == 0
    assert whitening.identity_error(df, whitening.fit(df), 8) == 0.0


def test_deviations_stay_exact_beyond_64_bits():
    x = np.array([[2 ** 45, 5], [3, 2 ** 44]], dtype=np.int64)
    total = [int(s) for s in x.sum(axis=0)]
    assert whitening.deviations(x, 2, np.array(total, dtype=object)) == [sum((2 * int(a) - s) ** 2 for a, s in zip(r, total)) for r in x]
