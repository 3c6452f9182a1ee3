"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from churnwise.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    ids = sorted(good)
    x = np.array([good[i] for i in ids])
    out = {}
    for n, i in enumerate(ids):
        if i % 20 == 0:
            s = (x * x[n]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_vectors_without_clusters(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64)).astype(np.float32)
    x *= rng.uniform(0.5, 2, (4000, 1)).astype(np.float32)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    got, want = found(ann.report(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    for q, pairs in got.items():
        exact = (x[[i for i, _ in pairs]].astype(float) * x[q].astype(float)).sum(axis=1)
        assert np.allclose([s for _, s in pairs], exact, rtol=1e-12)
        assert [(-s, i) for i, s in pairs] == sorted((-s, i) for i, s in pairs)


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (60, 6)).astype(float)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    rows += [(100 + k, x[7].tolist(), 0) for k in range(70)]  # a large group of equal vectors
    rows += [(300, None, 0), (320, [0.0] * 6, 0), (340, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (360, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 0), (380, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 0), (400, [], 0), (420, [1.0, 2.0], 0), (None, x[3].tolist(), 0), (440, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 0), (460, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 0)]
    rows += rows[:3]
    want = brute([r for r in rows if r[0] != 420])
    got = found(ann.report(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS id", "3 AS q")))
    assert got == want  # so few vectors fill one leaf of each tree


def test_hundreds_of_ties_and_shuffled_ids(spark, monkeypatch):
    """0/1 vectors tie at nearly every cut; every leaf is searched, so ids must be exact."""
    monkeypatch.setattr(ann, "CELL_QUERIES", 7)
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2, (600, 12)), axis=0)
    x = x[x.any(axis=1)]
    ids = rng.permutation(len(x))
    rows = [(int(i), v.astype(float).tolist(), 0) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ann.nearest(df, df.where("vec_id % 20 = 0"), effort=99.0, cell_rows=64)) == brute(rows)


def test_each_length_is_a_table(spark):
    rng = np.random.default_rng(5)
    long = [(k, v.tolist(), 0) for k, v in enumerate(rng.integers(-3, 4, (50, 5)).astype(float))]
    short = [(k, v.tolist(), 0) for k, v in zip(range(100, 160), rng.integers(-3, 4, (60, 3)).astype(float))]
    got = found(ann.report(spark.createDataFrame(long + short, SCHEMA)))
    assert got == brute(long) | brute(short)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (20, [2.0, 1.0], 0), (3, [0.5, 0.5], 0)]
    assert found(ann.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert ann.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ann.report(spark.createDataFrame([(0, None, 0)], SCHEMA)).collect() == []
    assert ann.report(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).collect() == []


def test_large_leaves_and_query_blocks(spark, monkeypatch):
    """Cells smaller than a leaf, several blocks of queries: nothing that a leaf holds is lost."""
    monkeypatch.setattr(ann, "CELL_QUERIES", 5)
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(rng.normal(size=(500, 8)))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(ann.nearest(df, df.where("vec_id % 20 = 0"), effort=99.0, cell_rows=40))
    want = brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


@pytest.mark.parametrize("n", [1, 300])
def test_trees_hold_every_vector(n):
    x = np.random.default_rng(3).normal(size=(n, 5))
    forest = ann.Forest(x, float((x * x).sum(axis=1).max()), trees=3, leaf=10)
    leaves = forest.leaves(x)
    assert leaves.shape == (n, 3) and all(forest.tree_of[l] == t for row in leaves for t, l in enumerate(row))
    every = forest.search(x[:1], np.ones(len(forest.tree_of)), np.inf)[0]
    assert sorted(every) == list(range(len(forest.tree_of)))
