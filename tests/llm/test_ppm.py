"""Language-model scores against plain dictionaries."""

import collections
import math
import random
import re
import zlib

import pytest
from llm_data import awkward, documents, prose

from churnwise.llm import ppm


def brute(texts, ids, depth, states):
    low = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", low(t or "")) + [None] for t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids]
    words = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    counts = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    pad = lambda t: bytes([ppm.START]) * depth + (t or "").encode() + bytes([ppm.END])
    for t, h in zip(texts, held):
        if not h:
            s = pad(t)
            for p in range(depth, len(s)):
                for j in range(depth + 1):
                    counts[j][s[p - j : p]][s[p]] += 1
    ranked = sorted((-sum(v.values()), j, k) for j in range(depth + 1) for k, v in counts[j].items())
    kept = {k for _, _, k in ranked[:states]}

    def score(t):
        s, total = pad(t), 0.0
        for p in range(depth, len(s)):
            seen, left = set(), 1.0
            for j in range(depth, -1, -1):
                if s[p - j : p] not in kept:
                    continue
                new = {a: n for a, n in counts[j][s[p - j : p]].items() if a not in seen}
                n, t = sum(new.values()), len(new)
                if s[p] in new:
                    total += math.log10(left * new[s[p]] / (n + t))
                    break
                if t:
                    left *= t / (n + t)
                seen |= set(new)
            else:
                total += math.log10(left / (256 - len(seen)))
        return total

    total, distinct = sum(words.values()), len(words)
    base = [sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in t) for t in tokens]
    return [(h, len(t), sum(words[w] > 0 for w in t), total, b, score(x)) for h, t, b, x in zip(held, tokens, base, texts)]


@pytest.mark.parametrize("depth,states,block", [(5, 1 << 16, ppm.BLOCK_BYTES), (2, 40, 900), (3, 1, 1)])
def test_scores(spark, monkeypatch, depth, states, block):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block)
    monkeypatch.setattr(ppm, "SEGMENT", 64)
    rng = random.Random(14)
    texts = [prose(rng, rng.randrange(1, 40)) for _ in range(60)] + [t if t is None else t[:4000] for t in awkward(rng)]
    want = brute(texts, range(len(texts)), depth, states)
    docs = documents(spark, texts, clashing=True)
    found = ppm.report(docs, depth, states).collect()
    assert len(found) == len(texts)
    for r in found:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert math.isclose(r["base_score"], w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r["score"], w[5], rel_tol=1e-5)


def test_without_training_or_rows(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    docs = documents(spark, ["ab c"], ids=[held])
    r = ppm.report(docs).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and math.isclose(r["score"], -5 * math.log10(256), rel_tol=1e-6)
    assert ppm.report(docs.limit(0)).collect() == []
    twice = ppm.report(documents(spark, ["x y", "x y", None], ids=[None, None, None])).collect()
    assert sorted(r["n_tokens"] for r in twice) == [1, 3, 3] and {r["train_tokens"] for r in twice} == {7}


def test_probabilities_sum_to_one():
    import numpy as np

    rng = random.Random(15)
    raw = np.frombuffer(prose(rng, 500).encode(), np.uint8)
    keys, n = np.unique(ppm.runs(raw, np.array([0, len(raw)]), 2), return_counts=True)
    context, symbol = keys >> np.uint64(8), (keys & np.uint64(255)).astype(int)
    rows = [(2, int(c), int(s), int(k)) for c, s, k in zip(context, symbol, n)]
    for j in (1, 0):
        low = collections.Counter()
        for o, c, s, k in rows:
            if o == 2:
                low[c & ((1 << 8 * j) - 1), s] += k
        rows += [(j, c, s, k) for (c, s), k in low.items()]
    model = ppm.Model(*map(np.array, zip(*rows)), 2)
    assert np.allclose((10.0 ** model.tables()[1].astype(float)).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize("bucket", [ppm.BUCKET_BYTES, 2_000])
def test_every_context_counts(spark, monkeypatch, bucket):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(ppm, "BUCKET_BYTES", bucket)
    rng = random.Random(19)
    texts = [prose(rng, rng.randrange(1, 20)) for _ in range(40)] + [None, "", "é日 x", "q" * 300]
    # more contexts than any fixed table of the model held, the rare ones among them
    texts += ["".join(chr(rng.randrange(33, 1200)) for _ in range(1_200)) for _ in range(30)] + ["".join(rng.choice("abcdef") for _ in range(900)) for _ in range(20)]
    want = brute(texts, range(len(texts)), ppm.ORDER, 1 << 40)
    assert sum(w[0] for w in want) > 5
    found = ppm.report(documents(spark, texts, clashing=True)).collect()
    assert len(found) == len(texts)
    for r in found:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert math.isclose(r["base_score"], w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r["score"], w[5], rel_tol=1e-5)
