"""Source mixing: exact budgets, reruns, and the mixed corpus itself."""

import random
import re

import pytest
from llm_data import awkward, documents, prose

from churnwise.llm import mix


def table(spark, seed=1, **more):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 80)) for _ in range(300)] + awkward(rng)
    sources = ["hot" if rng.random() < 0.5 else rng.choice(["a", "b", "é", None, ""]) for _ in texts]
    sources[:4] = ["tiny"] * 4
    return texts, sources, documents(spark, texts, sources, **more)


def water_fill(sizes, weights, share=1.5, most=2):
    """Share by weight; what exceeds the cap goes back and is shared among the others."""
    target, fixed, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ones = [s for s in sizes if s not in fixed]
        over = [s for s in open_ones if left * weights[s] / sum(weights[x] for x in open_ones) > most * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * weights[s] / sum(weights[x] for x in open_ones) for s in open_ones}
        for s in over:
            target[s] = most * sizes[s]
            fixed.add(s)
        left = share * sum(sizes.values()) - sum(target[s] for s in fixed)


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_budgets(spark, range_rows):
    texts, sources, docs = table(spark)
    rows = mix.plan(docs, range_rows=range_rows).collect()
    assert len(rows) == len(texts)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for t, s in zip(texts, sources):
        sizes[s] = sizes.get(s, 0) + count(t)
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    for s in order:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and abs(own[0]["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] and r["size"] == count(texts[r["doc_id"]]) for r in own)


def test_reruns_and_partitions_agree(spark):
    _, _, docs = table(spark)
    key = lambda df: sorted((r["doc_id"], r["taken"]) for r in df.collect())
    assert key(mix.plan(docs)) == key(mix.plan(docs.repartition(7), range_rows=2))


def test_materialize(spark):
    texts, sources, docs = table(spark, clashing=True)
    mixed = mix.materialize(docs)
    assert mixed.columns == [*docs.columns, "_epoch", "_words_taken"]
    plan = {r["doc_id"]: r["taken"] for r in mix.plan(docs).collect()}
    got = {}
    for r in mixed.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        assert len(words) == r["_words_taken"] and texts[r["doc_id"]].startswith(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words)
    assert got == {k: v for k, v in plan.items() if v}


def test_empty_and_wordless(spark):
    assert mix.report(documents(spark, [])).collect() == []
    rows = mix.report(documents(spark, [None, "", " "], ["a", "b", None])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 3


def test_repeated_rows_are_documents(spark):
    docs = documents(spark, ["one two three four"] * 6, ids=[5] * 6)
    rows = mix.report(docs).collect()
    assert sum(r["taken"] for r in rows) == 36 and len(rows) == 6
    assert sum(r["words_taken"] for r in mix.materialize(docs).collect()) == 36


@pytest.mark.parametrize("hot", [5, None])
def test_one_id_in_a_third_of_all_rows(spark, hot, monkeypatch):
    """Rows that share an id, or have none: each is a document, the mix is exact, and no task orders them all."""
    monkeypatch.setattr(mix, "DEALT", 7)
    rng = random.Random(9)
    texts = [prose(rng, 20) for _ in range(400)] + ["same text of six words here"] * 200 + [prose(rng, rng.randrange(1, 9)) for _ in range(300)]
    ids = [hot] * 600 + list(range(1000, 1300))
    sources = [rng.choice(["a", "b"]) for _ in texts]
    docs = documents(spark, texts, sources, ids=ids)
    assert docs.where("doc_id is null").count() == (600 if hot is None else 0)
    rows = mix.plan(docs, range_rows=10).collect()
    assert len(rows) == 900
    placed = mix.entries(docs, range_rows=10).collect()
    assert sum(r["n"] for r in placed) == 900 and sum(r["doc_id"] == hot for r in placed) < 40
    mixed = mix.materialize(docs).collect()
    for source in ("a", "b"):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"]) == sum(r["words_taken"] for r in mixed if r["source"] == source)
    # no document is taken more often than the plan says one of its size is, and none is lost from whole epochs
    most = {}
    for r in mixed:
        most[(r["doc_id"], r["source"], r["text"])] = most.get((r["doc_id"], r["source"], r["text"]), 0) + 1
    copies = {}
    for t, i, s in zip(texts, ids, sources):
        copies[(i, s, t)] = copies.get((i, s, t), 0) + 1
    assert all(most[k] <= 2 * copies[k] for k in most if k in copies)
    again = mix.materialize(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))
