"""Near-duplicate groups against brute force over full shingle sets."""

import random
import re

from llm_data import awkward, documents, edited, prose

from churnwise.llm import minhash
from churnwise.llm.components import components


def brute(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    of = list(range(len(texts)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                of[y] = x
    return {k: (len(sets[k]), find(k)) for k in range(len(texts))}


def check(spark, texts, **options):
    found = minhash.near_duplicates(documents(spark, texts, clashing=True), **options).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component"]) for r in found} == brute(texts)
    assert len(found) == len(texts)


def test_awkward_texts_copies_and_chains(spark):
    rng = random.Random(1)
    texts = awkward(rng)
    base = prose(rng, 150)
    for _ in range(6):  # a chain: each a near copy of the one before
        texts.append(base)
        base = edited(rng, base, 2)
    texts += [texts[5], texts[6].upper(), texts[6].replace(" ", "\n\t ")]
    rng.shuffle(texts)
    check(spark, texts)


def test_large_group_around_the_threshold(spark):
    """Many copies of one text whose similarities lie on both sides of 0.85; small blocks, few partners."""
    rng = random.Random(2)
    base = prose(rng, 160)
    texts = [edited(rng, base, rng.randrange(12)) for _ in range(160)] + [prose(rng, 60) for _ in range(20)]
    check(spark, texts, block=16, rounds=(1, 4, None))


def test_rejected_partners_do_not_end_the_search(spark):
    """Two texts whose best estimated partners are tested and rejected still find each other, though each block
    offers one partner only in the first round."""
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        base = prose(rng, 130)
        texts += [base] + [edited(rng, base, rng.choice([3, 4, 5, 6])) for _ in range(7)]
    check(spark, texts, rounds=(1, None))


def test_stage_keeps_unlike_rows_that_share_an_id(spark):
    rng = random.Random(13)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    rows = [(5, a), (5, b), (7, c), (5, b), (8, c), (3, edited(rng, d, 1)), (9, d), (9, None), (5, None), (6, ""), (6, " "), (None, d), (None, None), (11, None)]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows], clashing=True)
    left = [(r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(docs).collect()]
    want = [(5, a), (5, b), (7, c), (3, rows[5][1]), (9, None), (5, None), (6, ""), (6, " "), (None, None), (11, None)]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_report_and_stage(spark):
    rng = random.Random(3)
    a = prose(rng, 100)
    texts = [prose(rng, 50), a, edited(rng, a, 1), None, "", a, "two words", "two words"]
    docs = documents(spark, texts, ids=[9, 4, 7, 1, 2, 8, None, None])
    rows = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.report(docs).collect()}
    assert rows[4, 96] == (4, True) and rows[8, 96] == (4, False) and rows[9, 46] == (9, True)
    assert rows[1, 0] == (1, True) and rows[2, 0] == (2, True) and rows[None, 1] == (None, True)
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in left.collect()) == sorted([("9", texts[0]), ("4", a), ("1", None), ("2", ""), ("None", "two words")])


def test_empty_table(spark):
    docs = documents(spark, [])
    assert minhash.report(docs).collect() == [] and minhash.drop_near_duplicates(docs).collect() == []


def test_estimate_is_corrected_for_chance():
    import numpy as np

    rng = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.85, 1.0):
        n = 4000
        a, b = (rng.integers(1, 2**63, n, dtype=np.uint64) for _ in range(2))
        same = round(2 * n * share / (1 + share))
        b[:same] = a[:same]
        x, y = (minhash.pack(minhash._minima(v, minhash.K)) for v in (a, b))
        assert len(x) == minhash.K // 2 and abs(minhash.estimate(x, y) - share) < 0.08


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    random.Random(4).shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
