import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES


def integers(vectors):
    return [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]


def exact_scatter(xs):
    n, dim = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(dim)]
    y = [[n * x[i] - s[i] for i in range(dim)] for x in xs]
    return s, [[sum(r[i] * r[j] for r in y) // n for j in range(dim)] for i in range(dim)], [sum(v * v for v in r) for r in y]


def exact_polynomial(m):
    """Faddeev and LeVerrier in fractions: another way to det(x - m), constant first."""
    dim = len(m)
    a = np.array([[Fraction(v) for v in row] for row in m], dtype=object)
    b, out = np.zeros((dim, dim), dtype=object), [Fraction(1)]
    one = np.array([[Fraction(int(i == j)) for j in range(dim)] for i in range(dim)], dtype=object)
    for k in range(1, dim + 1):
        b = a @ b + one * out[-1]
        out.append(-sum((a @ b).diagonal()) / k)
    return [int(v) for v in reversed(out)]


def frame_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string")


@pytest.mark.parametrize("dim, rows, rank", [(1, 5, 1), (2, 9, 2), (6, 40, 6), (12, 30, 12), (7, 20, 3), (9, 4, 3)])
def test_equals_exact_brute_force(spark, dim, rows, rank):
    rng = np.random.default_rng(dim)
    vectors = rng.normal(size=(rows, dim)) / 3
    if rank < min(dim, rows - 1):
        vectors = rng.integers(-3, 4, (rows, rank)) @ rng.integers(-2, 3, (rank, dim)) / 4.0
    xs = integers(vectors)
    sums, m, deviations = exact_scatter(xs)
    n, found = whitening.fit_sums(whitening.integer_rows(frame_of(spark, vectors)))
    assert (n, found) == (rows, sums)
    got = whitening.scatter(whitening.integer_rows(frame_of(spark, vectors)), n, found)
    assert got.tolist() == m
    assert whitening.characteristic_polynomial(spark, got) == exact_polynomial(m)
    v = np.array([[float(Fraction(c, n * n)) for c in row] for row in m])
    values, eigenvectors = np.linalg.eigh(v)
    values, eigenvectors = values[::-1], eigenvectors[:, ::-1]
    k = min(whitening.COMPONENTS, sum(values > values[0] * 1e-9))
    out = whitening.whiten(frame_of(spark, vectors)).collect()
    assert len(out) == rows * k
    table = {(r["vec_id"], r["component"]): r for r in out}
    centred = np.array(xs) - np.array(sums) / n
    for c in range(1, k + 1):
        ours = np.array([table[i, c]["whitened"] for i in range(rows)])
        want = centred @ eigenvectors[:, c - 1] / math.sqrt(values[c - 1])
        sign = 1 if ours @ want > 0 else -1
        gap = min([abs(values[c - 1] - o) for j, o in enumerate(values) if j != c - 1] or [1]) / values[0]
        np.testing.assert_allclose(sign * ours, want, atol=1e-12 / max(gap, 1e-12) + 1e-9)
        for i in range(rows):
            r = table[i, c]
            assert r["n"] == n and int(r["deviation"]) == deviations[i]
            assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_equal_eigenvalues_give_an_orthonormal_basis(spark):
    vectors = [[s if i == j else 0 for i in range(5)] for j in range(5) for s in (1.0, -1.0)]
    out = whitening.whiten(frame_of(spark, vectors)).collect()
    assert len(out) == 50 and {round(r["explained"], 12) for r in out} == {0.2}
    w = np.zeros((10, 5))
    for r in out:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
    np.testing.assert_allclose(w.T @ w / 10, np.eye(5), atol=1e-12)
    assert out[0]["identity_error"] < 1e-12


def test_unusable_rows_nulls_and_repeats(spark):
    vectors = [[1, 2], [1, 2], [3, 5], [4, 1], None, [None, 1], [float("nan"), 1], [float("inf"), 1], [1, 2, 3], [], [2.0**32, 1]]
    ids = [1, 1, None, 2, 3, 4, 5, 6, 7, 8, 9]
    out = whitening.whiten(frame_of(spark, vectors, ids)).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in out) == sorted([("1", 1), ("1", 2)] * 2 + [("None", 1), ("None", 2), ("2", 1), ("2", 2)])
    assert {r["n"] for r in out} == {4}


@pytest.mark.parametrize("vectors", [[], [None], [[1, 2]], [[1, 2]] * 3, [[]]])
def test_no_variance_no_rows(spark, vectors):
    assert whitening.whiten(frame_of(spark, vectors)).collect() == []


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**31, 1], [-(2.0**31), 0.5], [7, -(2.0**30)]]
    sums, m, deviations = exact_scatter(integers(vectors))
    out = whitening.whiten(frame_of(spark, vectors)).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in out} == dict(enumerate(deviations))


def test_query_on_floats(spark, sf_dir):
    out = QUERIES["op11_embedding_whitening"](spark, sf_dir).toPandas()
    rows = [v for v in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding").toPandas()["embedding"]]
    x = np.array(integers(rows), dtype=np.float64)
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert len(out) == len(rows) * 8 and out["identity_error"].max() < 1e-9
    got = out.groupby("component")["explained"].first().to_numpy()
    np.testing.assert_allclose(got, values[:8] / values.sum(), rtol=1e-9)
    assert out["deviation"].dtype == np.int64
