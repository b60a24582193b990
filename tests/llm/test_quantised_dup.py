"""int8 tile products: bounds hold for every pair, and the whole operator equals brute force."""

from collections import Counter

import numpy as np
import pytest

from nimbus.llm import quantised_dup

SCHEMA = "vec_id long, embedding array<double>, label int, chunk string, times int"


def near(rng, base, cosine):
    """A vector at about this cosine from ``base``."""
    u = base / np.linalg.norm(base)
    w = rng.standard_normal(len(u))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def brute(rows):
    good = [k for k, (i, v, label, *_) in enumerate(rows) if i is not None and label is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, comp = Counter(), {k: k for k in good}

    def root(k):
        while comp[k] != k:
            k = comp[k]
        return k
    for p, a in enumerate(good):
        for b in good[p + 1:]:
            x, y = np.array(rows[a][1], dtype=np.float64), np.array(rows[b][1], dtype=np.float64)
            if rows[a][2] == rows[b][2] and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    r, s = sorted((root(a), root(b)))
                    comp[s] = r
    least = {}
    for k in good:
        least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    out = []
    for k, (i, *_) in enumerate(rows):
        c = least[root(k)] if k in comp else i
        out.append((i, links[k], c, c is None or c == i))
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("chunk_rows", [quantised_dup.CHUNK_ROWS, 16])
def test_against_all_pairs(spark, chunk_rows):
    rng = np.random.default_rng(1)
    rows = []

    def put(v, label):
        rows.append((1000 - len(rows), None if v is None else [None if x is None else float(x) for x in v], label, "c", 1))
    for group in range(12):
        base = rng.standard_normal(24)
        for _ in range(rng.integers(1, 9)):
            put(near(rng, base, rng.uniform(0.9, 1)) * rng.uniform(0.01, 100), group % 3)
    for t in np.linspace(0, 2, 30):                                  # a chain
        put([np.cos(t), np.sin(t)] + [0] * 22, 0)
    base = rng.standard_normal(24)
    for _ in range(40):
        put(base, 1)                                                 # copies
    for _ in range(60):
        put(near(rng, base, 0.97), 1)                                # a cloud
    put(base, None), put(base, 2), put(None, 1), put([], 1), put([0.0] * 24, 1), put([1.0] * 23 + [float("nan")], 1)
    put([1.0] * 23 + [None], 1), put([float("inf")] * 24, 1), put([1e200] * 24, 1), put([3e-200] * 24, 1), put([2.0] * 5, 1), put([4.0] * 5, 1)
    rows.append((None, base.tolist(), 1, "c", 1))
    rows.append((rows[0][0], near(rng, base, 0.97).tolist(), 1, "c", 1))      # a repeated id with another vector
    got = [tuple(r) for r in quantised_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), chunk_rows=chunk_rows)
           .select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("dim", [2, 64, 3000])
def test_no_pair_is_off_by_more_than_its_bound(dim):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.standard_normal((60, dim)), rng.standard_cauchy((60, dim)), np.eye(dim)[:2] * 1e-300])
    q, scale, rest, length = quantised_dup.quantised(v)
    exact = q.astype(np.int64) @ q.astype(np.int64).T
    assert np.array_equal(quantised_dup.products(q, q), exact)
    w = quantised_dup.scaled(v)
    u = w / np.linalg.norm(w, axis=1)[:, None]
    off = np.abs(exact * scale[:, None] * scale - u @ u.T)
    assert (off <= length[:, None] * rest + rest[:, None]).all()


def test_threshold_is_decided_in_full_precision(spark):
    """Pairs within the bound on both sides of the threshold."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(200):
        base = rng.standard_normal(64)
        rows += [(2 * k, base.tolist(), k, "c", 1), (2 * k + 1, near(rng, base, 0.93 + rng.choice([-1, 1]) * 1e-9).tolist(), k, "c", 1)]
    got = [tuple(r) for r in quantised_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
           .select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got) == sorted(brute(rows)) and 0 < sum(r[1] for r in got) < 400


def test_empty_table(spark):
    assert quantised_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    none = spark.createDataFrame([(1, None, 1, "c", 1)], SCHEMA)
    assert [tuple(r) for r in quantised_dup.near_duplicates(none).collect()] == [(1, 0, 1, True)]
