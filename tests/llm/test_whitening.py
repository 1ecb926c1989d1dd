"""Whitening against exact fractions and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.common import table

SMALL = "/root/testdata/sf0.001"


def exact(vectors):
    """n, x, deviation and covariance in fractions, straight from the definition."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(size)]
    d = [[n * r[i] - s[i] for i in range(size)] for r in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in d), n ** 3) for j in range(size)] for i in range(size)]
    return n, x, [sum(v * v for v in r) for r in d], np.array([[float(c) for c in r] for r in cov]), s


def test_query_by_definition(spark):
    source = {r["vec_id"]: r["embedding"] for r in table(spark, SMALL, "embeddings").collect()}
    ids = [i for i, v in source.items() if v is not None]
    n, x, deviation, cov, s = exact([source[i] for i in ids])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = whitening.op12_whitening(spark, SMALL).collect()
    assert len(rows) == len(ids) * 32
    at = {i: k for k, i in enumerate(ids)}
    w = np.zeros((len(ids), 32))
    for r in rows:
        k, c = at[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[k])
        assert abs(r["explained"] - values[c] / np.trace(cov)) <= 1e-9 and r["identity_error"] <= 1e-9
        w[k, c] = r["whitened"]
    plain = (np.array(x) - np.array(s) / n) @ vectors[:, :32] / np.sqrt(values[:32])
    assert np.allclose(w.T @ w / n, np.eye(32), atol=1e-9)
    cross = w.T @ plain / n  # each column the same up to its sign
    assert np.allclose(np.abs(np.diag(cross)), 1, atol=1e-6)


def frame(spark, vectors, ids=None):
    rows = list(zip(ids or range(len(vectors)), vectors))
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_polarisation_is_exact(spark):
    draw = np.random.default_rng(1)
    vectors = (draw.standard_normal((40, 5)) * [1, 10, 1e-3, 1e6, 1e12]).tolist()
    rows = whitening.whole_numbers(frame(spark, vectors).repartition(3))
    n, total = whitening.sums(rows, 5)
    centre = [t // n for t in total]
    assert np.array_equal(whitening.covariance(n, total, centre, whitening.square_sums(rows, centre)), exact(vectors)[3])
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(frame(spark, vectors)).collect()}
    assert [got[i] for i in range(40)] == exact(vectors)[2]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [nan, 1.0], [1.0, None], [inf, 0.0], [0.0, 0.0], [3.0, -1.0], [3.0, -1.0], [1.0], [],
               [1e300, 0.0], [-2.0, 5.0]]
    out = whitening.whiten(frame(spark, vectors, [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, None])).collect()
    assert sorted((r["vec_id"] for r in out), key=str) == [1, 6, 7, 7, None]
    assert all(r["n"] == 5 and len(r["whitened"]) == 2 and r["identity_error"] < 1e-9 for r in out)
    clash = frame(spark, vectors[:1] + vectors[5:8]).selectExpr("*", "1 AS n", "2 AS whitened", "3 AS x")
    assert whitening.by_component(whitening.whiten(clash)).count() == 8


@pytest.mark.parametrize("vectors", [[], [[]], [None]])
def test_no_vectors(spark, vectors):
    out = whitening.by_component(whitening.whiten(frame(spark, vectors)))
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_no_variance_is_null(spark):
    out = whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert [r["whitened"] for r in out] == [[None, None]] * 3 and out[0]["identity_error"] is None
    flat = whitening.whiten(frame(spark, [[1.0, float(i)] for i in range(5)])).first()
    assert flat["whitened"][0] is not None and flat["whitened"][1] is None and flat["identity_error"] < 1e-9
    assert flat["explained"] == [1.0, 0.0]


def test_far_entries(spark):
    out = whitening.whiten(frame(spark, [[6e13, 0.0], [-6e13, 1.0], [0.0, 2.0]])).collect()
    assert len(out) == 3 and all(r["deviation"] is not None for r in out)
