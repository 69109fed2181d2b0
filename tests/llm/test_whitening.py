"""Operator 12 against numpy on random tables, and its defined cases."""

import math

import numpy as np
import pytest
from pyspark.sql import Row

from marketscope.llm.whitening import deviations, embedding_whitening, jacobi, pivoted_cholesky, rounds

SCHEMA = "vec_id long, embedding array<float>, n string, component string"


def brute(vectors, k=8):
    """Integer sums and numpy's symmetric eigensolver."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = np.array([[float((n * a - b) / n) for a, b in zip(row, s)] for row in x])
    values, units = np.linalg.eigh(y.T @ y / n)
    values, units = values[::-1][:k], units[:, ::-1][:, :k]
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    return n, dev, y @ units / np.sqrt(values), values, np.trace(y.T @ y / n)


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([Row(vec_id=i, embedding=v, n="x", component="y") for i, v in zip(ids, vectors)], SCHEMA)


@pytest.mark.parametrize("dim,count,offset", [(12, 200, 0.0), (9, 40, 1000.0)])
def test_whitening_matches_numpy(spark, dim, count, offset):
    rng = np.random.default_rng(dim)
    data = (rng.normal(size=(count, dim)) * np.linspace(2, 0.3, dim) + offset).astype(np.float32)
    got = embedding_whitening(frame(spark, data.tolist())).toPandas().sort_values(["vec_id", "component"])
    n, dev, white, values, trace = brute(data)
    k = min(8, dim)
    assert len(got) == count * k and set(got["n"]) == {n}
    assert got["deviation"].tolist() == [d for d in dev for _ in range(k)]
    assert got["deviation_text"].tolist() == [str(d) for d in dev for _ in range(k)]
    mine = got["whitened"].to_numpy().reshape(count, k)
    signs = np.sign((mine * white).sum(axis=0))
    assert np.allclose(mine, white * signs, atol=1e-8)
    assert np.allclose(got["explained"].to_numpy().reshape(count, k)[0], values / trace, rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    b = rng.normal(size=(15, 6))
    m = b @ b.T                                             # rank 6 of 15
    factor = pivoted_cholesky(m)
    assert factor.shape == (15, 6) and np.allclose(factor @ factor.T, m)
    values, units = jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:6]) and np.allclose(units @ units.T, np.eye(6))
    assert np.allclose(m @ units.T, units.T * values)
    for k in (0, 1, 2, 5, 8):
        seen = [(a, b) for p, q in rounds(k) for a, b in zip(p.tolist(), q.tolist())]
        assert sorted(seen) == [(a, b) for a in range(k) for b in range(a + 1, k)]


def test_exact_deviation_beyond_64_bits():
    n, x = 5_000_000_000, np.array([[1 << 40, 7], [0, 0]], dtype=np.int64)
    sums = (3 * n + 1, 7 * n)
    assert deviations(x, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]


def test_dropped_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(30, 4)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = data + data[:2] + bad
    ids = [None, 0, 0, *range(3, 30), 100, 101, *range(200, 206)]
    got = embedding_whitening(frame(spark, rows, ids)).toPandas()
    assert set(got["n"]) == {32} and len(got) == 32 * 4 and not set(range(200, 206)) & set(got["vec_id"].dropna())
    n, dev, white, values, trace = brute(data + data[:2])
    assert sorted(got["deviation"]) == sorted(d for d in dev for _ in range(4))
    assert got["whitened"].abs().sum() == pytest.approx(np.abs(white).sum())


def test_components_without_variance_are_not_returned(spark):
    line = [[float(i), 2.0 * i, 5.0] for i in range(10)]           # one direction only
    got = embedding_whitening(frame(spark, line)).toPandas()
    assert set(got["component"]) == {1} and np.allclose(got["explained"], 1.0)
    assert embedding_whitening(frame(spark, [[1.0, 2.0]] * 3)).count() == 0
    assert embedding_whitening(frame(spark, [])).count() == 0
    empty = embedding_whitening(frame(spark, [None, []]))
    assert empty.count() == 0 and empty.columns == got.columns.tolist()


def test_huge_entries_do_not_crash(spark):
    got = embedding_whitening(frame(spark, [[1e30, 0.0], [0.0, 1.0], [-1e30, 3.0]])).toPandas()
    assert got["deviation"].isna().any() and got["deviation_text"].str.len().max() > 19
