"""Near duplicates against brute force over all pairs of full shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa

from nimbus.llm import near_dup
from nimbus.llm.shingles import shingle_sets


def brute(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_sets_of_words_across_chunks():
    texts = ["A b\tc  D e\nf", "", None, "one two", " x y z w v", "a b c d e f " * 3000, "A B C D E F"]
    got = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in got] == [2, 0, 0, 1, 1, 6, 2]
    assert set(got[0]) == set(got[6]) and set(got[0]) <= set(got[5])


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for shared in (100, 240, 343):
        other = np.concatenate([base[:shared], rng.integers(0, 1 << 63, 400 - shared, dtype=np.uint64)])
        true = shared / (800 - shared)
        m = near_dup.minima([np.unique(base), np.unique(other)]) & np.uint32((1 << near_dup.BITS) - 1)
        c = 2.0 ** -near_dup.BITS
        assert abs((np.mean(m[0] == m[1]) - c) / (1 - c) - true) < 0.11


def test_whole_table_against_brute_force(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(12):
        base = r.choices(words, k=r.randrange(20, 120))
        for _ in range(r.randrange(1, 9)):
            copy = list(base)
            for _ in range(r.randrange(6)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    base = r.choices(words, k=60)                                  # a chain: neighbours link, the ends do not
    for k in range(10):
        rows.append((1000 + k, " ".join(base[:60 - 3 * k] + [f"z{j}" for j in range(3 * k)])))
    rows += [(5000 + i, rows[0][1].upper()) for i in range(40)]    # exact copies, in other case
    rows += [(6000, ""), (6001, None), (6002, " \t\n"), (6003, "one two"), (6004, "ONE  two"), (6005, "long " * 20000 + "end")]
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in rows] + [(None, rows[0][1], "n", 1), (5000, rows[0][1], "n", 1)],
                               "doc_id long, text string, key string, comp int")
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(rows) + 2
    want = brute(rows)
    for x in got:
        if x.doc_id is None:
            assert x.component_id is None and x.kept
        else:
            assert (x.n_shingles, x.component_id, x.kept) == (*want[x.doc_id], want[x.doc_id][1] == x.doc_id), x
    left = near_dup.drop_near_duplicates(df).collect()
    assert sorted(x.doc_id for x in left if x.doc_id is not None) == sorted({i for i in want if want[i][1] == i})
    assert sum(x.doc_id is None for x in left) == 1


def brute_rows(rows):
    """(n, smallest id) for each row, rows that share an id being documents each; and one set of row numbers a group."""
    found = brute(list(enumerate(t for _, t in rows)))
    groups = {}
    for k, (n, root) in found.items():
        if n and rows[k][0] is not None:
            groups.setdefault(root, set()).add(k)
    least = {root: min(rows[k][0] for k in g) for root, g in groups.items()}
    marks = [(i, found[k][0], least[found[k][1]] if found[k][0] and i is not None else i) for k, (i, _) in enumerate(rows)]
    return marks, list(groups.values())


def test_repeated_ids_with_unlike_texts(spark):
    """Rows are told apart by their texts: nothing is lost, and one row of each group stays."""
    r = random.Random(8)
    a, b, c = (" ".join(r.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(3))
    rows = [(5, a), (5, b), (9, b), (3, c + " more"), (7, c), (5, c), (7, c), (7, c), (8, a), (8, a.upper()), (11, ""), (11, ""), (None, a)]
    df = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, t1 int, stays string, id int").repartition(3)
    marks, groups = brute_rows(rows)
    got = [(x.doc_id, x.n_shingles, x.component_id) for x in near_dup.near_duplicates(df).collect()]
    key = str
    assert sorted(got, key=key) == sorted(marks, key=key)
    left = near_dup.drop_near_duplicates(df)
    assert left.columns == df.columns
    left = sorted(((x.doc_id, x.text) for x in left.collect()), key=key)
    want = [min((rows[k] for k in g), key=lambda x: x[0]) for g in groups] + [(11, ""), (11, ""), (None, a)]
    assert len(left) == len(want) and sorted(i for i, _ in left if i) == sorted(i for i, _ in want if i)
    sets = {frozenset(t.lower().split()) for _, t in left}
    assert all(any(frozenset(rows[k][1].lower().split()) in sets for k in g) for g in groups)


def test_hot_pivots_and_buckets_in_parts(spark, monkeypatch):
    """Groups larger than a part: the pivot's text goes to each, buckets are dealt over many."""
    monkeypatch.setattr(near_dup, "BUCKET_ROWS", 4)
    monkeypatch.setattr(near_dup, "GROUP_ROWS", 3)
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = r.choices(words, k=70)
    rows = []
    for k in range(60):
        copy = list(base)
        for _ in range(r.randrange(9)):
            copy[r.randrange(len(copy))] = r.choice(words)
        rows.append((100 - k, " ".join(copy)))
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(df).count() == 0
    assert near_dup.drop_near_duplicates(df).count() == 0
