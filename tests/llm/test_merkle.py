"""Merkle manifest: a literal builder, positions against a literal append log, awkward rows."""

import hashlib
import random
import zlib

import pytest
from llm_data import awkward, documents, prose

from churnwise.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests):
    """Every level of a tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[k : k + 3]) for k in range(0, len(low), 3)])
    return levels


def climb(levels, k, now):
    proof = ""
    for level in levels[:-1]:
        a = k - k % 3
        left, right = "".join(level[a:k]), "".join(level[k + 1 : a + 3])
        proof, now, k = proof + left + right, h(left, now, right), k // 3
    return proof, now


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars); the report's rows, sorted."""
    by = {}
    for i, t, lang, s, n in rows:
        other = leaf((i, s, lang, n, t.replace("\n", "") if t is not None else None))
        by.setdefault(s, []).append((i is not None, i or 0, leaf((i, s, lang, n, t)), other, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort()
        trees[s] = tree([x[2] for x in by[s]])
    top = tree([trees[s][-1][0] for s in order]) if order else []
    out = []
    for k, s in enumerate(order):
        for j, (_, _, own, other, i) in enumerate(by[s]):
            now = other if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else own
            proof, now = climb(trees[s], j, now)
            more, now = climb(top, k, now)
            out.append((i, own, trees[s][-1][0], top[-1][0], h(proof + more), now, now == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 80, 82])
def test_positions_are_those_of_an_append_log(n):
    log, sizes = [], [0] * (merkle.height(n) + 1)
    for e in range(1, n + 1):
        for level in range(len(sizes)):
            if level == 0 or e % 3**level == 0 or e == n:
                log.append((level, sizes[level]))
                sizes[level] += 1
            else:
                break
    assert [merkle.position(level, k, n) for level, k in log] == list(range(len(log)))


def table(spark, seed=3, n=120, **more):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 9)).replace(" ", "\n" if rng.random() < 0.5 else " ") for _ in range(n)] + awkward(rng)
    sources = ["hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "Z", None, ""]) for _ in texts]
    return documents(spark, texts, sources, **more)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_a_literal_builder(spark, levels):
    docs = table(spark)
    want = brute([tuple(r) for r in docs.collect()])
    assert got(merkle.verify(merkle.manifest(docs, levels))) == want
    assert {w[-1] for w in want} == {True, False}


def test_log_holds_every_node_once_in_completion_order(spark):
    data = merkle.manifest(table(spark), 2)
    log = [r for t in data.trees.tiers for r in t.collect()]
    sizes = {r["tree"]: r["n"] for r in log}
    for k, n in sizes.items():
        own = sorted((r["position"], r["level"], r["index"]) for r in log if r["tree"] == k)
        assert [p for p, _, _ in own] == list(range(sum(merkle.width(level, n) for level in range(merkle.height(n) + 1))))


def test_rows_without_and_with_repeated_ids_and_clashing_columns(spark):
    rng = random.Random(5)
    texts = [prose(rng, 3) + "\n" for _ in range(40)] + ["same\n"] * 20
    ids = [None] * 10 + [7] * 30 + [9] * 20
    docs = documents(spark, texts, ["s"] * 60, ids=ids, clashing=True)
    for c in ("tree", "at", "n", "leaf", "digest", "block"):
        docs = docs.withColumn(c, docs["key"])
    plain = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]
    assert got(merkle.verify(merkle.manifest(docs, 2))) == brute(plain)


def test_one_document_and_none(spark):
    one = documents(spark, ["a\nb"], [None], ids=[0])
    assert got(merkle.report(one)) == brute([tuple(r) for r in one.collect()])
    assert merkle.report(documents(spark, [])).collect() == []
