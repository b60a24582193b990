"""Whitening against the full covariance in exact whole numbers and its dense eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from nimbus.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component int, x string"


def brute(rows, k=16):
    xs = [(i, tuple(math.floor(64 * c) + 1000000 for c in v)) for i, v in rows]
    fit = np.array(sorted({x for _, x in xs}), dtype=np.int64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = np.array([[float(Fraction(n * int(a) - s, n)) for a, s in zip(r, sums)] for r in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    there = [j for j in range(min(k, len(sums))) if values[j] > 1e-12 * values.sum()]
    out = {}
    for i, x in xs:
        c = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), c @ vectors[:, there] / np.sqrt(values[there])))
    return n, values[there] / values.sum(), out


def check(spark, rows, extra=(), within=1e-7):
    df = spark.createDataFrame([(i, list(map(float, v)), 1, "x") for i, v in rows] + [(*e, 1, "x") for e in extra], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    n, shares, want = brute(rows)
    assert len(got) == len(rows) * len(shares)
    by = {}
    for r in got:
        assert r.n == n and abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    sign = {}
    for i, found in want.items():
        for j in range(len(shares)):
            rs = by[i][j + 1]
            assert sorted(r.deviation for r in rs) == sorted(d for d, _ in found)
            w = found[0][1][j]
            if len(rs) == 1 and abs(w) > 1e-3:
                sign.setdefault(j, np.sign(w * rs[0].whitened))
                assert abs(rs[0].whitened - sign[j] * w) < within * max(1, abs(w)), (i, j)
    return got


def test_flat_spectrum_against_dense(spark):
    """Eigenvalues of noise lie close together: the hard case."""
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((700, 64)) / 8)]
    rows += [(9000 + i, rows[3][1]) for i in range(300)]             # copies count once in the fit
    bad = [(1, None), (2, [None] * 64), (3, [float("nan")] * 64), (4, [float("inf")] * 64), (5, []), (6, [1.0, 2.0]), (7, [1e18] * 64)]
    check(spark, rows, bad, 1e-6)


def test_steep_spectrum_and_more_dimensions(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((400, 100)) * 1000 / np.arange(1, 101) ** 1.5)]
    check(spark, rows)


@pytest.mark.parametrize("dim", [1, 3, 20])
def test_few_dimensions_and_low_rank(spark, dim):
    rng = np.random.default_rng(6)
    rows = [(i, np.repeat(np.round(rng.standard_normal(2) * 100), [1, dim])[:dim]) for i in range(50)]
    check(spark, rows)


def test_zero_vectors_stay(spark):
    got = check(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.5]), (3, [-1.0, 2.0]), (None, [0.0, 0.0])])
    assert {r.vec_id for r in got} == {1, 2, 3, None}


def test_nothing_varies(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).collect() == []


def test_great_entries_stay_exact(spark):
    rows = [(1, [3e13, 1.0]), (2, [-2e12, 0.0]), (3, [5.0, 1e13])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    for i, found in brute(rows)[2].items():
        assert got[i] == (found[0][0] if found[0][0] < 1 << 63 else None)


def test_certifies_or_fails(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PASSES", 4)
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(rng.standard_normal((200, 64)))], SCHEMA)
    with pytest.raises(RuntimeError):
        whitening.whiten(df)
