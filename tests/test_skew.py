"""Correctness when one key holds a third of all rows (checked against brute force)."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from churnwise.operators.links import best_links
from churnwise.operators.rollup import distinct_flag_rollup
from churnwise.operators.temporal import top_k_per_group


def test_best_links_with_a_hot_mobile(spark):
    rnd = random.Random(3)
    rows = set()
    for f in range(600):
        rows.add((f, 10_000 if f % 3 == 0 else 10_000 + rnd.randrange(1, 120), 1))  # a third link mobile 10000
        if f % 4 == 0:
            rows.add((f, 10_000 + rnd.randrange(0, 120), 2))
    rows = sorted(rows)
    got = {(r.f, r.m) for r in best_links(spark.createDataFrame(rows, "f long, m long, src int"), "f", "m", 2).collect()}
    by_f, by_m = defaultdict(list), defaultdict(list)
    for f, m, s in rows:
        by_f[f].append((f, m, s))
        by_m[m].append((f, m, s))
    top_f = {min(v, key=lambda x: (-x[1], x[2])) for v in by_f.values()}
    top_m = {x for v in by_m.values() for x in sorted(v, key=lambda x: (-x[0], x[2]))[:2]}
    assert got == {(f, m) for f, m, _ in top_f & top_m}


def test_rollup_and_top_k_with_a_hot_group(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randrange(50)}", rnd.randrange(5000), float(rnd.randrange(1000)))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = {r.g: r.n for r in distinct_flag_rollup(df, ["g"], "id", {"n": F.col("id")}).collect()}
    ref = defaultdict(set)
    for g, i, _ in rows:
        ref[g].add(i)
    assert got == {g: len(v) for g, v in ref.items()}
    top = top_k_per_group(df, "g", [F.col("v").desc(), F.col("id").asc()], 3).where(F.col("g") == "hot")
    expect = sorted(((v, i) for g, i, v in rows if g == "hot"), key=lambda x: (-x[0], x[1]))[:3]
    assert [(r.v, r.id) for r in top.orderBy("rank").collect()] == expect


def test_left_join_fanout_equals_left_join(spark):
    from churnwise.operators.existence import left_join_fanout
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "k long, x string")
    right = spark.createDataFrame([(1, 10.0)] * 50 + [(2, 20.0), (3, 30.0), (None, 0.0)], "k long, y double")
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    got = sorted((tuple(r) for r in left_join_fanout(left, right, "k").select("k", "x", "y").collect()), key=key)
    ref = sorted((tuple(r) for r in left.join(right, "k", "left").select("k", "x", "y").collect()), key=key)
    assert got == ref
