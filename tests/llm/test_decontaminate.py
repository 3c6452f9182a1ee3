"""Decontamination against a plain search for windows of words."""

import hashlib
import random
import re

import pytest
from llm_data import awkward, documents, prose

from churnwise.llm import decontaminate as D

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return PATTERN.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        k = min(n, len(v))
        if not k:
            continue
        for window in {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) == window:
                    hit.update(range(i, i + k))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def make(spark):
    rng = random.Random(5)
    items = [(k, prose(rng, 25)) for k in range(8)] + [(8, "one two three"), (9, None), (10, "--"), (11, "solo"), (11, "Solo!"), (None, prose(rng, 12))]
    texts = awkward(rng)[:7] + [prose(rng, 60) for _ in range(5)]
    for k in (0, 3, 7, 13):
        w = items[k][1].split(" ")
        texts += [prose(rng, 5) + " " + " ".join(w[2:14]).upper() + ", " + prose(rng, 4), prose(rng, 5) + " " + " ".join(w[:9]) + " zzz"]
    texts += ["so ONE-two, three! and solo", items[0][1] + " " + items[1][1], "one two", "twothree one twoé three"]
    return texts, items, documents(spark, texts, clashing=True), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 300])
def test_report(spark, block_bytes):
    texts, items, docs, benchmark = make(spark)
    for r in D.report(docs, benchmark, block_bytes=block_bytes).collect():
        want = brute(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == want
        assert r["contaminated"] == (want[1] > 0) and sum(s["end"] - s["start"] for s in r["spans"]) == want[1]


def test_stage_keeps_clean_rows_whole(spark):
    texts, items, docs, benchmark = make(spark)
    left = D.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(k, t) for k, t in enumerate(texts) if not brute(t, items)[1]]


def test_empty_tables(spark):
    _, _, docs, benchmark = make(spark)
    assert D.report(docs.limit(0), benchmark).collect() == []
    assert not any(r["contaminated"] for r in D.report(docs, benchmark.limit(0)).collect())
