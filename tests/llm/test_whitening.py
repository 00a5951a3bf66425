"""Whitening against whole-number sums taken plainly and numpy's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tarmac.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def vectors(n, size=8, seed=0, mix=True):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, size))
    if mix:
        v = v @ rng.normal(size=(size, size))
    return v.astype(np.float32)


def check(spark, rows, got, most=16):
    """Every contract column, from the rows (id, vector) that take part."""
    xs = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in rows}
    fit = sorted(set(xs.values()))
    n, size = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(size)]
    cov = np.array([[float(Fraction(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j], n * n)) for j in range(size)] for i in range(size)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(most, int((values > 1e-10 * values[0]).sum()))
    assert len(got) == kept * len(rows)
    for r in got:
        x, k = xs[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert r["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
        assert r["identity_error"] < 1e-8
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        assert abs(r["whitened"]) == pytest.approx(abs(centred @ axes[:, k]) / math.sqrt(values[k]), abs=1e-7)
    assert len({r["identity_error"] for r in got}) == 1


def test_as_computed_plainly(spark):
    v = vectors(300)
    rows = [(i, v[i]) for i in range(300)] + [(1000 + i, v[0]) for i in range(150)]  # a third of all rows is one vector
    got = whitening.whiten(frame(spark, [(i, x.tolist(), 0) for i, x in rows])).collect()
    check(spark, rows, got)


def test_more_dimensions_than_components_and_small_blocks(spark):
    v = vectors(200, 24, seed=1)
    rows = [(i, v[i]) for i in range(200)]
    s = whitening.Settings(block_rows=7)
    check(spark, rows, whitening.whiten(frame(spark, [(i, x.tolist(), 0) for i, x in rows]), settings=s).collect())


def test_odd_vectors(spark):
    v = vectors(40, 4, seed=2)
    rows = [(i, v[i]) for i in range(40)] + [(100, v[0]), (101, np.zeros(4, np.float32))]
    bad = [
        (200, None, 0), (201, [1.0, None, 0.0, 0.0], 0), (202, [1.0, float("nan"), 0.0, 0.0], 0), (203, [float("inf"), 0.0, 0.0, 0.0], 0),
        (204, [1.0, 2.0], 0), (205, [], 0), (206, [3e38, 0.0, 0.0, 0.0], 0),
    ]
    df = frame(spark, [(i, x.tolist(), 0) for i, x in rows] + bad)
    df = df.selectExpr("*", "1 AS x", "2 AS component", "'a' AS n")
    got = whitening.whiten(df).collect()
    check(spark, rows, got)
    double = frame(spark, [(i, [float(c) for c in x], 0) for i, x in rows] + [(None, [0.5] * 4, 0), (None, [0.5] * 4, 0)], "vec_id bigint, embedding array<double>, label int")
    got = whitening.whiten(double).collect()
    assert sum(r["vec_id"] is None for r in got) == 2 * 4


def test_too_little_to_scale(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0
    # One of two dimensions never moves, so there is one component.
    got = whitening.whiten(frame(spark, [(i, [float(i), 5.0], 0) for i in range(5)])).collect()
    assert len(got) == 5 and {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize("top", [1, 200, 2**20, 2**40, 2**61])
def test_scatter_is_exact(top):
    rng = np.random.default_rng(top % 97)
    x = rng.integers(-top, top, size=(150, 5))
    x[:, 3] = 7  # no bits at all
    sums, cross = whitening.scatter(x)
    own = x.tolist()
    assert sums == [sum(r[i] for r in own) for i in range(5)]
    for i in range(5):
        for j in range(i, 5):
            assert cross[i][j] == sum(r[i] * r[j] for r in own)


def test_far_values_stay_exact():
    model = whitening.Fit(3, [2**61, 5], np.eye(2), np.ones(2), 2.0)
    x = np.array([[2**61, 1], [7, 2]])
    _, deviation = whitening.whitened(x, model)
    assert deviation == [None, None]
    model = whitening.Fit(2, [10, 4], np.eye(2), np.ones(2), 2.0)
    w, deviation = whitening.whitened(np.array([[5, 3]]), model)
    assert deviation == [4] and w.tolist() == [[0.0, 1.0]]
