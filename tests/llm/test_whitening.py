"""Whitening against numpy's own eigenvalues and against sums of Python integers."""

import numpy as np
import pytest
from fixtures import FOLDER, needs_data

from kinfold.llm.registry import QUERIES, table
from kinfold.llm.whitening import WhiteningParams, below, leading, slices, whitened

P = WhiteningParams()


def brute(rows):
    """(n, S, deviations, covariance) by Python integers; rows of one length."""
    import math

    x = [[math.floor(64 * c) + 1_000_000 for c in row] for row in rows]
    n, d = len(x), len(x[0])
    total = [sum(row[j] for row in x) for j in range(d)]
    off = [[n * row[j] - total[j] for j in range(d)] for row in x]
    v = np.array([[sum(o[i] * o[j] for o in off) / n**3 for j in range(d)] for i in range(d)])
    return n, total, [sum(a * a for a in o) for o in off], v, np.array(off, float) / n


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def check(out, rows):
    n, _, deviation, v, centred = brute([e for _, e in rows])
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(32, int((values > 1e-12 * values.sum()).sum()))
    assert len(out) == k * n
    by = {}
    for r in out:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    whole = np.array([[by[i][c]["whitened"] for c in range(1, k + 1)] for i, _ in rows])
    assert all(by[i][1]["deviation"] == deviation[j] and by[i][1]["n"] == n for j, (i, _) in enumerate(rows))
    for c in range(1, k + 1):
        assert abs(by[rows[0][0]][c]["explained"] - values[c - 1] / values.sum()) <= 1e-9
    off = np.max(np.abs(whole.T @ whole / n - np.eye(k)))
    assert off < 1e-7 and all(abs(r["identity_error"]) < 1e-7 for r in out)
    # Projection back: whitened * sqrt(e) are coordinates in an orthonormal basis of the leading space.
    if k == len(values):
        assert np.allclose((whole**2 * values[:k]).sum(axis=1), (centred**2).sum(axis=1))


@pytest.mark.parametrize("kind", ["plain", "ties", "flat", "far"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 6))
    if kind == "ties":  # three directions of exactly the same variance
        x = np.vstack([np.eye(6), -np.eye(6)] * 4)
    elif kind == "flat":
        x[:, 4] = x[:, 1]
        x[:, 5] = 0.25
    elif kind == "far":
        x = x * 0.05 + 9000
    rows = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(x)]
    check(whitened(frame(spark, [(i, e, 0) for i, e in rows]), P).collect(), rows)


def test_inertia_counts_and_slices():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(40, 40))
    v = a @ a.T
    truth = np.sort(np.linalg.eigvalsh(v))[::-1]
    for shift in (*((truth[1:] + truth[:-1]) / 2), -1.0, truth[0] + 1):
        assert below(v, shift) == int((truth < shift).sum())
    zero = np.array([[0.0, 1.0], [1.0, 0.0]])  # no usable diagonal pivot
    assert below(zero, 0.0) == 1
    for (lo, hi, above, _), e in zip(slices(v, P), truth[:32], strict=True):
        assert lo < e < hi and truth[above] == e
    values, vectors = leading(v, P)
    assert np.allclose(values, truth[:32], rtol=1e-12)
    assert np.max(np.abs(vectors @ vectors.T - np.eye(32))) < 1e-12
    assert np.max(np.abs(v @ vectors.T - vectors.T * values)) < 1e-10 * truth[0]


def test_near_ties_stay_orthogonal():
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(12, 12)))[0]
    e = np.array([5, 5 - 1e-13, 5 - 1e-9, 4, 4, 4, 3, 2, 1, 1e-3, 1e-6, 0])
    values, vectors = leading((q * e) @ q.T, P)
    assert np.allclose(values, e[:11], atol=1e-12) and np.max(np.abs(vectors @ vectors.T - np.eye(11))) < 1e-9


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (None, [0.5, -3.0]), (7, [0.1, 0.2])]
    bad = [(3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (8, [inf, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [3e38, 0.0])]
    df = spark.createDataFrame(
        [(i, e, "x", "y") for i, e in good + bad], "vec_id long, embedding array<float>, n string, component string"
    )
    out = whitened(df, P).collect()
    assert sorted((r["vec_id"] or 0) for r in out) == sorted([0, 0, 1, 1, 2, 2, 2, 2, 7, 7])
    assert {r["n"] for r in out} == {5} and all(r["identity_error"] <= 1e-9 for r in out)
    _, _, deviation, _, _ = brute([e for _, e in [(i, [float(np.float32(c)) for c in v]) for i, v in good]])
    assert {r["vec_id"]: r["deviation"] for r in out}[7] == deviation[4]
    assert whitened(df.limit(0), P).collect() == [] and whitened(df.limit(1), P).collect() == []
    assert whitened(df.filter("vec_id = 2"), P).collect() == []  # equal vectors have no variance
    assert whitened(df.filter("vec_id in (3, 4, 5)"), P).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    out = whitened(frame(spark, [(1, [0.0, 1.0], 0), (2, [3e8, 0.0], 0), (3, [0.0, 2.0], 0)]), P).collect()
    assert {r["vec_id"]: r["deviation"] is None for r in out} == {1: True, 2: True, 3: True}


@needs_data
def test_the_query_returns_every_vector(spark):
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in table(spark, FOLDER, "embeddings").collect()]
    check(QUERIES["op13_embedding_whitening"](spark, FOLDER).collect(), rows)
