import random
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF001
from ctxanomaly.llm.whitening import OFFSET, deviations, eigen, one_sided_jacobi, pivoted_cholesky, whiten


def brute(rows):
    """The contract by numpy's symmetric eigensolver, from (vec_id, vector) rows."""
    kept = [(i, [int(np.floor(64 * c)) + OFFSET for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    points = np.array(sorted({tuple(x) for _, x in kept}))
    n, s = len(points), points.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(points.T, bias=True).reshape(len(s), len(s)))
    return kept, n, s, values[::-1], vectors[:, ::-1]


def test_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    kept, n, s, values, vectors = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = {}
    for r in whiten(table).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == {i for i, _ in kept}
    mean = np.array([float(Fraction(int(v), n)) for v in s])
    signs = None
    for i, x in kept:
        mine = got[i]
        assert sorted(mine) == list(range(1, 17))
        assert {r["n"] for r in mine.values()} == {n}
        assert {r["deviation"] for r in mine.values()} == {sum((n * a - int(b)) ** 2 for a, b in zip(x, s, strict=True))}
        w = np.array([mine[k + 1]["whitened"] for k in range(16)])
        want = (np.array(x) - mean) @ vectors[:, :16] / np.sqrt(values[:16])
        if signs is None:
            signs = np.sign(w * want)
        assert np.allclose(w, signs * want, atol=1e-9)
        assert [mine[k + 1]["explained"] for k in range(16)] == pytest.approx(list(values[:16] / values.sum()), rel=1e-9)
        assert max(r["identity_error"] for r in mine.values()) < 1e-10


def test_dropped_rows_repeats_and_other_columns(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(3)], "x") for i in range(40)]
    rows += [rows[0], rows[0], (100, rows[1][1], "copy"), (None, rows[2][1], None)]
    bad = [(200, None, "a"), (201, [1.0, None, 2.0], "a"), (202, [1.0, float("nan"), 2.0], "a"), (203, [float("inf"), 0.0, 0.0], "a"),
           (204, [], "a"), (205, [1.0, 2.0], "a"), (206, [1e300, 0.0, 0.0], "a")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, x string")
    got = whiten(df).collect()
    assert len(got) == 3 * len(rows) and {r["n"] for r in got} == {40}
    assert not {r["vec_id"] for r in got} & set(range(200, 207))
    per = {}
    for r in got:
        per.setdefault((r["vec_id"], r["component"]), set()).add((r["whitened"], r["deviation"]))
    assert all(len(v) == 1 for v in per.values())
    assert per[(100, 1)] == per[(1, 1)] and per[(None, 2)] == per[(2, 2)]


def test_directions_without_variance(spark):
    line = [(i, [0.5 * i, 1.0 * i, 7.0]) for i in range(10)]
    got = whiten(spark.createDataFrame(line, "vec_id long, embedding array<float>")).collect()
    first = [r for r in got if r["component"] == 1]
    assert all(r["explained"] == pytest.approx(1.0) and r["identity_error"] < 1e-9 for r in first)
    assert all(r["whitened"] is None and r["explained"] == 0 for r in got if r["component"] > 1)
    same = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert len(same) == 4 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in same)


def test_empty_table(spark):
    assert whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_deviation_beyond_64_bits():
    x = np.array([[2**40, 0], [3, 4]])
    assert deviations(x, 2, [0, 0]) == [None, 100]
    assert deviations(np.array([[5, 6]]), 3, [10, 20]) == [25 + 4]


def test_factors_keep_small_eigenvalues():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    want = 10.0 ** -np.arange(12)
    a = (q * want) @ q.T
    order, lower = pivoted_cholesky(a)
    assert np.allclose(lower @ lower.T, a[np.ix_(order, order)], atol=1e-15)
    assert np.allclose(lower, np.tril(lower))
    values, vectors = eigen(a)
    assert np.allclose(values, want, rtol=1e-4) and np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-12)
    assert np.abs((vectors * values) @ vectors.T - a).max() < 1e-14
    for r in (1, 2, 5):  # odd numbers of columns leave a seat empty
        values, u = one_sided_jacobi(rng.normal(size=(7, r)))
        assert np.allclose(u.T @ u, np.eye(r)) and list(values) == sorted(values, reverse=True)
