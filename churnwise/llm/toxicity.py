"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A document is read as words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased). Each word has word inputs (its log-odds in
the training sample) and character inputs (the log-odds of its 4-byte pieces, and a learned embedding of its
bytes). Windows of 32 words, each starting 16 words after the one before, overlap over the whole text; the
network scores every window, and the document's score is its highest window score, calibrated to a probability.

Training runs in one Spark task on a bounded sample: at most `SAMPLE` rows of each label, those with the smallest
hashed ids, of documents up to `SAMPLE_CHARS` characters. Labels enter only there. The sample is split in two
halves; each half's log-odds feed the training windows of the other, so no document's own label is in its
inputs. Labels belong to documents, not windows: each round trains on a toxic document's best windows and a
clean document's worst, as the network of the round before sees them.

Scoring is one pass over the texts without a shuffle; the broadcast model is bounded by the sample.

Defined results: null and empty texts have one window without words, whose score is the network's bias;
without both labels in the sample every document gets the sample's share of label 1 (0 without any label);
repeated rows get equal scores; a document with several label rows counts once for each; a row without doc_id has
no label and is scored as held in.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwise.llm.common import LOWER, chunks, cut, field, text_bytes, words

#: Rows of each label that training may use, and the longest of their texts in characters.
SAMPLE, SAMPLE_CHARS = 2000, 8000
LENGTH, STRIDE = 32, 16
HIDDEN, ATTEND, BYTES, CLASSES = 8, 8, 4, 32
FEATURES = 5
PIECE = 4
EPOCHS, ROUNDS, RATE = 4, 3, 0.01
#: Words and pieces must occur in so many documents of the sample to have log-odds.
LEAST = 2
#: Windows scored, and documents counted, at once.
_WINDOWS, _DOCS = 2048, 100

Params = dict[str, np.ndarray]


def held_out(doc_id):
    """Documents that are never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --- inputs ----------------------------------------------------------------------------------------------


class Texts:
    """Words of a batch of texts: distinct words, and each word's number among them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = LOWER[raw]
        starts, ends, hashes, self.rows = words(self.raw, offsets)
        self.known, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.starts, self.ends = starts[first], ends[first]

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, piece) for the 4-byte pieces of each distinct word between two marks."""
        n = self.ends - self.starts + 2 - PIECE + 1
        n = np.maximum(n, 1)
        of = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) - 1
        key = np.zeros(len(of), np.uint32)
        start, end = self.starts[of], self.ends[of]
        for k in range(PIECE):
            p = start + at + k
            inside = (p >= start) & (p < end)
            byte = np.where(inside, self.raw[np.minimum(np.maximum(p, 0), len(self.raw) - 1)], 1)
            key = key * np.uint32(256) + byte.astype(np.uint32)
        return of, key

    def classes(self) -> np.ndarray:
        """Share of each byte class in each distinct word."""
        n = self.ends - self.starts
        of = np.repeat(np.arange(len(n)), n)
        at = np.repeat(self.starts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        counts = np.bincount(of * CLASSES + self.raw[at] % CLASSES, minlength=len(n) * CLASSES).reshape(-1, CLASSES)
        return (counts / np.maximum(n, 1)[:, None]).astype(np.float32)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(document of each window, word numbers of its places; -1 beyond the document's end)."""
        n = np.diff(self.rows)
        count = np.maximum(1, -(-(n - LENGTH) // STRIDE) + 1)
        of = np.repeat(np.arange(len(n)), count)
        start = self.rows[of] + STRIDE * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
        at = start[:, None] + np.arange(LENGTH)
        inside = at < self.rows[of + 1][:, None]
        word = self.word if len(self.word) else np.zeros(1, np.int64)
        return of, np.where(inside, word[np.minimum(at, len(word) - 1)], -1).astype(np.int32)


class Lexicon:
    """Log-odds of words and pieces from labelled documents."""

    def __init__(self, texts: Texts, labels: np.ndarray, docs: np.ndarray):
        of = np.repeat(np.arange(len(labels)), np.diff(texts.rows))
        use = docs[of]
        pairs = np.divmod(np.unique(of[use] * max(1, len(texts.known)) + texts.word[use]), max(1, len(texts.known)))
        y = labels[pairs[0]]
        totals = [max(1, int((docs & (labels == k)).sum())) for k in (0, 1)]
        df = [np.bincount(pairs[1][y == k], minlength=len(texts.known)) for k in (0, 1)]
        self.words, self.word_odds = self._table(texts.known, df, totals)
        word, piece = texts.pieces()
        first = np.searchsorted(word, np.arange(len(texts.known) + 1))
        found: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
        for doc in range(0, len(labels), _DOCS):  # a piece counts once a document; few documents at a time
            here = slice(*np.searchsorted(pairs[0], (doc, doc + _DOCS)))
            of, words_of = pairs[0][here], pairs[1][here]
            n = np.diff(first)[words_of]
            at = np.repeat(first[words_of] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.unique(np.repeat(of, n) << 32 | piece[at])
            keys, index = np.unique(both & 0xFFFFFFFF, return_inverse=True)
            toxic = labels[both >> 32]
            found.append(np.stack([keys, np.bincount(index, 1 - toxic, len(keys)).astype(np.int64), np.bincount(index, toxic, len(keys)).astype(np.int64)]))
        every = np.concatenate(found, axis=1)
        keys, index = np.unique(every[0], return_inverse=True)
        self.pieces, self.piece_odds = self._table(keys.astype(np.uint64), [np.bincount(index, every[1 + k], len(keys)) for k in (0, 1)], totals)

    @staticmethod
    def _table(keys: np.ndarray, df: list[np.ndarray], totals: list[int]) -> tuple[np.ndarray, np.ndarray]:
        odds = np.log((df[1] + 0.5) / (totals[1] + 1)) - np.log((df[0] + 0.5) / (totals[0] + 1))
        keep = df[0] + df[1] >= LEAST
        return keys[keep], np.clip(odds[keep] / 4, -2, 2).astype(np.float32)

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, of: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(of), np.float32)
        at = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
        return np.where(keys[at] == of, values[at], np.float32(0))

    def features(self, texts: Texts) -> np.ndarray:
        """Inputs of each distinct word, without the learned embedding."""
        n = len(texts.known)
        if not n:
            return np.zeros((0, FEATURES), np.float32)
        word, piece = texts.pieces()
        odds = self._look(self.pieces, self.piece_odds, piece.astype(np.uint64))
        first = np.searchsorted(word, np.arange(n))
        mean = np.add.reduceat(odds, first) / np.bincount(word, minlength=n)
        known = self._look(self.words, self.word_odds, texts.known)
        return np.stack([known, mean, np.maximum.reduceat(odds, first), np.log1p(texts.ends - texts.starts) / 4, known != 0], axis=1).astype(np.float32)


# --- the network -----------------------------------------------------------------------------------------


def fresh(rng: np.random.Generator) -> Params:
    d = FEATURES + BYTES
    p = {"E": rng.normal(0, 0.3, (CLASSES, BYTES)), "A": rng.normal(0, 0.3, (2 * HIDDEN, ATTEND)), "v": rng.normal(0, 0.3, ATTEND), "w": rng.normal(0, 0.3, 2 * HIDDEN), "b": np.zeros(1)}
    for k in "fb":
        p |= {f"W{k}": rng.normal(0, 0.5, (d, 3 * HIDDEN)), f"U{k}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), f"c{k}": np.zeros(3 * HIDDEN)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(p: Params, features: np.ndarray, classes: np.ndarray, at: np.ndarray, keep: bool = False):
    """Logit of each window; at: word numbers, -1 where there is none (an input of zeros, without attention)."""
    n, steps = at.shape
    x = np.concatenate([features, classes @ p["E"]], axis=1)
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])  # number -1
    states = np.empty((n, steps, 2 * HIDDEN), np.float32)
    tape = {}
    for k, order, cols in (("f", range(steps), slice(0, HIDDEN)), ("b", range(steps - 1, -1, -1), slice(HIDDEN, 2 * HIDDEN))):
        into, u = x @ p[f"W{k}"] + p[f"c{k}"], p[f"U{k}"]
        h = np.zeros((n, HIDDEN), np.float32)
        for t in order:
            g = into[at[:, t]]
            zr = _sigmoid(g[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            m = np.tanh(g[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
            if keep:
                tape[k, t] = (h, z, r, m)
            h = m + z * (h - m)
            states[:, t, cols] = h
    a = np.tanh(states @ p["A"])
    score = np.where(at >= 0, a @ p["v"], np.float32(-1e9))
    share = np.exp(score - score.max(axis=1, keepdims=True)) * (at >= 0)
    share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-9)
    pooled = np.einsum("nt,nth->nh", share, states)
    logit = pooled @ p["w"] + p["b"][0]
    return (logit, (x, states, a, share, pooled, tape)) if keep else logit


def backward(p: Params, features: np.ndarray, classes: np.ndarray, at: np.ndarray, kept: tuple, d_logit: np.ndarray) -> Params:
    x, states, a, share, pooled, tape = kept
    g = {"w": pooled.T @ d_logit, "b": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["w"]
    d_states = share[:, :, None] * d_pooled[:, None, :]
    d_share = np.einsum("nh,nth->nt", d_pooled, states)
    d_score = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
    g["v"] = np.einsum("nt,ntk->k", d_score, a)
    d_a = d_score[:, :, None] * p["v"] * (1 - a * a)
    g["A"] = np.einsum("nth,ntk->hk", states, d_a)
    d_states = d_states + d_a @ p["A"].T
    d_x = np.zeros_like(x)
    steps = at.shape[1]
    for k, order, cols in (("f", range(steps - 1, -1, -1), slice(0, HIDDEN)), ("b", range(steps), slice(HIDDEN, 2 * HIDDEN))):
        w, u = p[f"W{k}"], p[f"U{k}"]
        g[f"U{k}"], d_into = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), np.float32)
        d_h = np.zeros((len(at), HIDDEN), np.float32)
        for t in order:
            h, z, r, m = tape[k, t]
            d_h = d_h + d_states[:, t, cols]
            d_m = d_h * (1 - z) * (1 - m * m)
            d_rh = d_m @ u[:, 2 * HIDDEN :].T
            d_z = d_h * (h - m) * z * (1 - z)
            d_r = d_rh * h * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=1)
            g[f"U{k}"][:, : 2 * HIDDEN] += h.T @ d_zr
            g[f"U{k}"][:, 2 * HIDDEN :] += (r * h).T @ d_m
            np.add.at(d_into, at[:, t], np.concatenate([d_zr, d_m], axis=1))
            d_h = d_h * z + d_rh * r + d_zr @ u[:, : 2 * HIDDEN].T
        g[f"W{k}"], g[f"c{k}"] = x.T @ d_into, d_into.sum(axis=0)
        d_x += d_into @ w.T
    g["E"] = classes.T @ d_x[:-1, FEATURES:]
    return g


def _logits(p: Params, features: np.ndarray, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(at):
        return np.zeros(0, np.float32)
    return np.concatenate([forward(p, features, classes, at[k : k + _WINDOWS]) for k in range(0, len(at), _WINDOWS)])


class Model:
    def __init__(self, texts: list[str | None], labels: list[int], rows: list[int] | None = None, seed: int = 11):
        """rows: how many labelled rows of label 0 and 1 there are, for calibration (else as in the sample)."""
        y = np.asarray(labels, np.int64)
        n = [int((y == k).sum()) for k in (0, 1)]
        self.prior = n[1] / max(1, len(y))
        self.params: Params | None = None
        if not n[0] or not n[1]:
            return
        raw, offsets = text_bytes(pa.array(texts, pa.string()))
        t = Texts(raw, offsets)
        rng = np.random.default_rng(seed)
        half = np.zeros(len(y), np.int64)
        for k in (0, 1):
            half[y == k] = rng.permutation(n[k]) % 2
        self.lexicon = Lexicon(t, y, np.ones(len(y), bool))
        by_half = [Lexicon(t, y, half != k).features(t) if min(n) > 1 else self.lexicon.features(t) for k in (0, 1)]
        classes = t.classes()
        of, at = t.windows()
        # all inputs side by side: a word has a number for each half
        features, classes = np.concatenate(by_half), np.concatenate([classes, classes])
        at[at >= 0] += (half[of][:, None] * np.int32(len(t.known)) + np.zeros((1, LENGTH), np.int32))[at >= 0]
        odds = np.append(features[:, 0] + features[:, 1], np.float32(-9))  # number -1: no word
        # the first choice of windows: by their inputs
        logit = np.concatenate([np.sort(odds[at[k : k + _WINDOWS]], axis=1)[:, -3:].sum(axis=1) for k in range(0, len(at), _WINDOWS)])
        p, m, v, step = fresh(rng), {}, {}, 0
        for _ in range(ROUNDS):
            order = np.lexsort((rng.random(len(of)), -logit, of))
            nth = np.arange(len(of)) - np.searchsorted(of, np.arange(len(y)))[of]
            chosen = np.concatenate([order[nth < np.where(y[of] == 1, 1, 3)], rng.choice(np.flatnonzero(y[of] == 0), min(len(y), int((y[of] == 0).sum())), replace=False)])
            for _ in range(EPOCHS):
                rng.shuffle(chosen)
                for k in range(0, len(chosen), 128):
                    take = chosen[k : k + 128]
                    used, local = np.unique(at[take], return_inverse=True)
                    local = local.reshape(at[take].shape)
                    if used[0] < 0:
                        used, local = used[1:], local - 1
                    f, c = features[used], classes[used]
                    out, kept = forward(p, f, c, local, keep=True)
                    want = y[of[take]].astype(np.float32)
                    grads = backward(p, f, c, local, kept, ((_sigmoid(out) - want) / len(take)).astype(np.float32))
                    step += 1
                    for name, g in grads.items():
                        m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                        v[name] = 0.99 * v.get(name, 0) + 0.01 * g * g
                        p[name] = (p[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            logit = _logits(p, features, classes, at)
        best = np.full(len(y), -np.inf)
        np.maximum.at(best, of, logit)
        share = [r / s for r, s in zip(rows or n, n)]
        self.params, self.scale = p, _calibrated(best, y, np.where(y == 1, share[1], share[0]))

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        n = len(offsets) - 1
        if self.params is None or not n:
            return np.full(n, self.prior)
        t = Texts(raw, offsets)
        of, at = t.windows()
        logit = _logits(self.params, self.lexicon.features(t), t.classes(), at)
        best = np.maximum.reduceat(logit, np.searchsorted(of, np.arange(n))).astype(float)
        return _sigmoid(self.scale[0] * best + self.scale[1])


def _calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic fit with a light pull towards slope 1."""
    a, b = 1.0, 0.0
    for _ in range(30):
        q = _sigmoid(a * x + b)
        s = weight * np.maximum(q * (1 - q), 1e-6)
        g = np.array([(weight * (q - y) * x).sum() + 5 * (a - 1), (weight * (q - y)).sum() + 0.1 * b])
        h = np.array([[(s * x * x).sum() + 5, (s * x).sum()], [(s * x).sum(), s.sum() + 0.1]])
        da, db = np.linalg.solve(h, g)
        a, b = a - float(np.clip(da, -1, 1)), b - float(np.clip(db, -2, 2))
    return max(a, 0.05), b


# --- on Spark --------------------------------------------------------------------------------------------


def _fit(counts: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pickled model of all rows of the one partition: the bounded sample."""
    texts: list[str] = []
    toxic: list[int] = []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        toxic += batch.column("toxic").to_pylist()
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model(texts, toxic, counts))], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out. It is fitted in one task on
    an executor (a lost one is retried, and fits the same model); only the fitted numbers reach the driver."""
    marks = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select("doc_id", F.length(text).alias("size")).where(~held_out(F.col("doc_id")))  # texts stay where they are
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    fits = sized.where(F.col("size") <= SAMPLE_CHARS).join(marks, "doc_id").withColumn("key", F.xxhash64(F.lit("toxic"), "doc_id"))
    picked = fits.where("toxic = 0").orderBy("key", "doc_id").limit(SAMPLE).unionByName(fits.where("toxic = 1").orderBy("key", "doc_id").limit(SAMPLE))
    picked = F.broadcast(cut(picked.select("doc_id", "toxic").distinct(), "toxicity-sample"))  # at most two samples of ids
    rows = docs.select("doc_id", text.alias("text")).where(F.length("text") <= SAMPLE_CHARS).join(picked, "doc_id")
    sample = rows.orderBy("toxic", F.xxhash64("doc_id"), "doc_id", "text").limit(4 * SAMPLE).select("text", "toxic")
    totals = [max(1, counts.get(k, 0)) for k in (0, 1)]
    fitted = sample.mapInArrow(lambda b: _fit(totals, b), "model binary").first()  # of one partition
    return pickle.loads(fitted["model"]) if fitted else Model([], [], totals)


def _score(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(field(batch, "text"))
        scores = [model.value.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["row", "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score) of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lambda b: _score(shared, b), schema)


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), train(docs, labels)).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score under the threshold, with all their columns."""
    return score(docs, train(docs, labels)).where(F.col("score") < threshold).select("row.*")
