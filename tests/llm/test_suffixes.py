"""Suffix arrays and repeated substrings against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from llm_data import awkward, documents, edited, prose

from churnwise.llm import suffixes


def test_suffix_array():
    rng = random.Random(16)
    for _ in range(8000):
        n = rng.randint(1, 40)
        s = [rng.randint(1, rng.randint(1, 4)) for _ in range(n)]
        if rng.random() < 0.4:
            s = (s[: max(1, n // 5)] * 7)[:n]
        s.append(0)
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"x" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(b), sum(map(bool, gone)), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(17)
    texts = awkward(rng)[:7] + ["é" * 900, "ab" * 700, "a" * 199, "a" * 200, "x" + "a" * 200]
    passages = [prose(rng, 60) for _ in range(4)]
    for k in range(30):  # passages with other neighbours, cut at odd bytes
        p = rng.choice(passages)
        a = rng.randrange(0, 40)
        texts.append(prose(rng, rng.randrange(0, 30)) + p[a : len(p) - rng.randrange(0, 40)] + prose(rng, rng.randrange(0, 30)))
    base = prose(rng, 200)
    texts += [edited(rng, base, rng.randrange(1, 10)) for _ in range(25)]  # near copies
    texts += [base[:201], base[1:200], "ü" + base[3:203] + "ß", passages[0] + passages[0]]
    texts += texts[20:23] + ["\0" * 210 + "q", "\0" * 205]
    return texts


@pytest.mark.parametrize("split", [suffixes.SPLIT, 1])
@pytest.mark.parametrize("length", [200, 70])
def test_removed_bytes(spark, monkeypatch, split, length):
    monkeypatch.setattr(suffixes, "BATCH", 500)
    texts = corpus()
    want = brute(texts, length)
    found = suffixes.remove_repeats(documents(spark, texts, clashing=True), length, split).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
        if r["kept"] is not None:
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_long_copies_and_missing_ids(spark):
    rng = random.Random(18)
    long = prose(rng, 9000)
    texts = [long, long + " end", None, None, long[100:400], "unlike " + prose(rng, 80)]
    found = suffixes.remove_repeats(documents(spark, texts, ids=[1, 2, None, None, None, None])).collect()
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == sorted(brute(texts, 200))


def test_empty_table(spark):
    assert suffixes.report(documents(spark, [])).collect() == []


@pytest.mark.parametrize("length", [200, 70])
def test_anchors_of_texts_longer_than_places(monkeypatch, length):
    monkeypatch.setattr(suffixes, "_POSITION", np.uint64(1023))
    rng = random.Random(20)
    passage = prose(rng, 400)
    texts = [t.encode() for t in (prose(rng, 300) + passage + prose(rng, 500) + passage, prose(rng, 3) + passage[7:], passage, "a" * 3000)]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    found: dict = {}
    n = 0
    for row, anchor, first, last, place in zip(*suffixes.anchors(raw, offsets, length)):
        for w in range(first, last + 1):
            assert offsets[row] <= w and w + length <= offsets[row + 1] and w <= place <= w + length - suffixes.ANCHOR
            assert found.setdefault(raw[w : w + length].tobytes(), (anchor, place - w)) == (anchor, place - w)
            n += 1
    assert n == sum(len(t) - length + 1 for t in texts)


@pytest.mark.parametrize("split", [2, 6])
def test_no_group_is_larger_than_split(spark, monkeypatch, split):
    rng = random.Random(21)
    line = prose(rng, 30)[:150]
    texts = [prose(rng, 8) + line + prose(rng, 8) for _ in range(60)]
    texts += [t[10:-10] + " " + prose(rng, 3) for t in texts[:15]] + [prose(rng, 6) + prose(random.Random(22), 40) + prose(rng, 6) for _ in range(12)]
    groups, dealer = [], suffixes.deal

    def deal(*args):
        dealt, crowded = dealer(*args)
        groups.append((max(r["count"] for r in dealt.groupBy("key").count().collect()), crowded.count()))
        return dealt, crowded

    monkeypatch.setattr(suffixes, "deal", deal)
    want = brute(texts, 200)
    for r in suffixes.remove_repeats(documents(spark, texts), 200, split).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
    assert sum(w[1] > 0 for w in want) > 20 and groups[0][0] <= split < groups[0][1]
