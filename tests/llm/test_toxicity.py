"""The network's gradients, held-out accuracy, and awkward inputs."""

import random
import zlib

import numpy as np
from llm_data import awkward, documents, prose

from churnwise.llm import toxicity as X
from churnwise.llm.common import chunks, text_bytes


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in X.fresh(rng).items()}
    f, c, at = rng.normal(size=(20, X.FEATURES)), rng.random((20, X.CLASSES)), rng.integers(0, 20, (6, 7))
    at[2, 4:] = -1
    at[3] = -1
    weight = rng.normal(size=6)
    g = X.backward(p, f, c, at, X.forward(p, f, c, at, keep=True)[1], weight)
    for name, value in p.items():
        i = tuple(rng.integers(0, n) for n in value.shape)
        ends = []
        for step in (1e-2, -1e-2):
            q = {k: v.copy() for k, v in p.items()}
            q[name][i] += step
            ends.append(float((X.forward(q, f, c, at) * weight).sum()))
        assert abs((ends[0] - ends[1]) / 2e-2 - g[name][i]) < 1e-2


BAD = [f"{stem}{end}" for stem in ("vexil", "grotu", "smarv") for end in ("", "a", "ing", "es", "ton", "ova")]


def corpus(rng, n):
    texts, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randrange(5, 200)).split(" ")
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() if rng.random() < 0.3 else rng.choice(BAD))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_documents(spark):
    rng = random.Random(9)
    texts, labels = corpus(rng, 900)
    extra = awkward(rng)
    docs = documents(spark, texts + extra, clashing=True)
    marks = spark.createDataFrame([(k, 0, y) for k, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in X.report(docs, marks).collect()}
    assert len(rows) == len(texts) + len(extra)
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [k for k in range(len(texts)) if rows[k]["held_out"]]
    right = sum(rows[k]["predicted"] == labels[k] for k in held)
    assert right >= 0.97 * len(held)
    # copies get equal scores; held-out labels change nothing
    n = len(texts)
    assert rows[n]["score"] == rows[n + 1]["score"] and rows[n + 7]["score"] == rows[n + 8]["score"]
    flipped = spark.createDataFrame([(k, 0, 1 - y if rows[k]["held_out"] else y) for k, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in X.report(docs, flipped).collect()}
    assert sum(again[k] != r["score"] for k, r in rows.items()) == 0 or max(abs(again[k] - r["score"]) for k, r in rows.items()) < 0.05
    left = X.drop_toxic(docs, marks)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(k for k, r in rows.items() if r["predicted"] == 0)


def test_windows_cover_whole_texts():
    """A toxic passage counts wherever it lies, and splitting a batch changes nothing."""
    rng = random.Random(10)
    model = X.Model(*corpus(rng, 400))
    clean = prose(rng, 3000).split(" ")
    texts = [" ".join(clean)]
    for at in (0, 1500, 2999):
        texts.append(" ".join([*clean[:at], "vexiling", "grotues", "smarvova", *clean[at:]]))
    raw, offsets = text_bytes(__import__("pyarrow").array(texts))
    together = model.scores(raw, offsets)
    apart = np.concatenate([model.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets, 100)])
    assert np.allclose(together, apart, atol=1e-5) and together[0] < 0.3 and (together[1:] > 0.5).all()


def test_without_labels_or_rows(spark):
    docs = documents(spark, ["a b c", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in X.report(docs, none).collect()] == [0.0, 0.0]
    assert X.report(docs.limit(0), none).collect() == []
    only = spark.createDataFrame([(0, None, 1), (1, 1, None), (None, 1, 1)], none.schema)
    assert {r["score"] for r in X.report(docs, only).collect()} <= {0.0, 1.0}
