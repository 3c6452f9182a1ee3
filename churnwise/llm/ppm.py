"""Language-model scores by prediction by partial matching over bytes, beside a word unigram base.

The model is a byte-context trie of depth `ORDER`, pretrained on the corpus; it keeps every context. A text is its
UTF-8 bytes after ORDER start marks (0xFE) and before one end mark (0xFF), which UTF-8 never uses, so scores of
whole texts are probabilities of whole texts. Escapes are estimated by the number of distinct symbols seen (t of
n + t), and symbols of longer contexts are excluded from shorter ones.

A symbol's probability depends on the run of ORDER + 1 bytes up to it alone, and the counts stay distributed. One
pass writes blocks of documents; each has its distinct runs and how often each occurs in training, which
are dealt out by a hash of the last 4 bytes of the context, to a number of buckets that grows with the text. A
bucket adds up its blocks' counts and so holds all counts of its contexts of 5 and 4 bytes. Runs of 5 bytes go on,
dealt out by the last 2 bytes of the context, to buckets that hold all counts of 3 and 2 bytes, and give back the rest of the
probability of each run that no bucket of the first kind saw. Only the counts of pairs of bytes, 65,536 at most
whatever the input, reach every worker. The first buckets then answer each block's runs, and each block adds up
its documents' symbols. The symbols of a context are among those of the shorter one, so what exclusion leaves of it
follows from two sums.

With `states`, an optional bound for small memories, the trie keeps only its `states` most frequent contexts (ties:
the shorter, then the smaller), which is closed under leaving off a first or last byte. Contexts become states of an
automaton with a table of next states and a table of log10 probabilities, both of at most `states` rows of 256. What
is broadcast is the counts of the kept contexts, which has the same bound. All texts of a block step through it
together; a long text is cut in segments that each read the ORDER bytes before them, which fixes the state, so
segments add up to the whole text exactly.

The base is add-one over words. A vocabulary has no bound, so it is never broadcast: each block asks for its
distinct words in the same way, by buckets of their hashes, and gets the training counts of its own words back.

Defined results: null and empty texts have no words, one end token and the probability of an empty text; without
any training text the base is 0 and the model is uniform over bytes; a row without doc_id trains; repeated rows
get equal scores, and each trains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import chunks, cut, mixed, signed, text_bytes, words

ORDER = 5
START, END = 0xFE, 0xFF
#: Bytes of text in one block of the base counts, and in one segment of a long text.
BLOCK_BYTES, SEGMENT = 2_000_000, 512
#: Bytes of text for each bucket of runs, and buckets of the first kind for each of the second.
BUCKET_BYTES, FEWER = 16_000_000, 8
#: Of compression of the blocks' texts.
LEVEL = 6


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# --- the model ---------------------------------------------------------------------------------------------


def runs(raw: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The order + 1 bytes up to each symbol of each row, packed in an integer."""
    n = np.diff(offsets)
    at = np.arange(len(raw)) + np.repeat(np.arange(1, len(n) + 1) * order + np.arange(len(n)), n)
    text = np.full(len(raw) + len(n) * (order + 1), START, np.uint8)
    text[at] = raw
    ends = np.cumsum(n + order + 1) - 1
    text[ends] = END
    symbol = np.ones(len(text), bool)
    for k in range(order):
        symbol[ends - n - order + k] = False
    where = np.flatnonzero(symbol)
    out = np.zeros(len(where), np.uint64)
    for k in range(order, -1, -1):
        out = out << np.uint64(8) | text[where - k]
    return out


def _count(depth: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            keys, n = np.unique(runs(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], depth), return_counts=True)
            both, at = np.unique(np.concatenate([known, keys]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
            known = both
            if len(known) > 1_500_000:  # a task's memory is bounded; the sums are made by Spark
                yield pa.RecordBatch.from_arrays([pa.array(signed(known)), pa.array(counts)], ["run", "n"])
                known, counts = known[:0], counts[:0]
    for a in range(0, len(known), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(signed(known[a : a + 100_000])), pa.array(counts[a : a + 100_000])], ["run", "n"])


class Model:
    """The automaton of the kept contexts. Only the counts travel; each worker builds its tables once."""

    def __init__(self, order: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, depth: int = ORDER):
        """Rows (order, context, symbol, n) of the kept contexts; contexts are packed bytes."""
        self.depth = depth
        self.rows = (order.astype(np.int8), context.astype(np.int64), symbol.astype(np.uint8), n.astype(np.int64))
        self._built: tuple[np.ndarray, np.ndarray, int] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_built": None}

    def tables(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Next states and log10 probabilities of each state and byte, and the first state."""
        if self._built is None:
            self._built = self._build()
        return self._built

    def _build(self) -> tuple[np.ndarray, np.ndarray, int]:
        order, context, symbol, n = self.rows
        # a context's number orders by length, then bytes; the empty context is state 0
        numbers, at = np.unique(np.append(order.astype(np.int64) << 48 | context, 0), return_inverse=True)
        size = len(numbers)
        counts = np.zeros((size, 256), np.float32)
        counts[at[:-1], symbol] = n
        level, bytes_of = numbers >> 48, numbers & ((1 << 48) - 1)
        find = lambda j, c: np.searchsorted(numbers, j << 48 | c)
        shorter = np.maximum(level - 1, 0)
        suffix = np.where(level > 0, find(shorter, bytes_of & ((1 << 8 * shorter) - 1)), 0)
        prefix = np.where(level > 0, find(shorter, bytes_of >> 8), 0)
        following = np.zeros((size, 256), np.int32)
        cost = np.zeros((size, 256), np.float32)
        for j in range(self.depth + 1):  # a state's suffix comes before it
            here = np.flatnonzero(level == j)
            if j:
                following[here] = following[suffix[here]]
            children = np.flatnonzero(level == j + 1)
            following[prefix[children], bytes_of[children] & 255] = children
            for k in range(0, len(here), 1024):  # a bounded number of states at a time
                cost[here[k : k + 1024]] = self._probabilities(here[k : k + 1024], j, counts, suffix)
        start = 0
        for j in range(1, self.depth + 1):
            mark = int.from_bytes(bytes([START]) * j, "big")
            s = int(find(j, mark))
            start = s if s < size and numbers[s] == j << 48 | mark else start
        return following, cost, start

    @staticmethod
    def _probabilities(at: np.ndarray, j: int, counts: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """log10 of the blended probabilities of some states of one length."""
        out, left, excluded = np.zeros((len(at), 256)), np.ones((len(at), 1)), np.zeros((len(at), 256), bool)
        for _ in range(j + 1):
            c = np.where(excluded, 0, counts[at]).astype(float)
            new = c > 0
            t, n = new.sum(axis=1, keepdims=True), c.sum(axis=1, keepdims=True)
            some = np.maximum(n + t, 1)
            out += left * c / some
            left = np.where(t > 0, left * t / some, left)
            excluded |= new
            at = suffix[at]
        rest = np.maximum(256 - excluded.sum(axis=1, keepdims=True), 1)
        return np.log10(np.maximum(np.where(excluded, out, left / rest), 1e-300))

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each row."""
        following, cost, start = self.tables()
        n = np.diff(offsets) + 1  # with the end mark
        ends = np.cumsum(n) - 1
        text = np.full(len(raw) + len(n), END, np.uint8)
        text[np.arange(len(raw)) + np.repeat(np.arange(len(n)), n - 1)] = raw
        parts = -(-n // SEGMENT)
        row = np.repeat(np.arange(len(n)), parts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = (ends - n + 1)[row] + nth * SEGMENT
        length = np.minimum(SEGMENT, ends[row] + 1 - first)
        order = np.argsort(-length, kind="stable")
        row, nth, first, length = row[order], nth[order], first[order], length[order]
        state = np.where(nth == 0, start, 0).astype(np.int64)
        later = np.flatnonzero(nth)
        for k in range(self.depth, 0, -1):
            state[later] = following[state[later], text[first[later] - k]]
        total = np.zeros(len(row))
        following, cost = following.ravel(), cost.ravel()
        alive = np.searchsorted(-length, -np.arange(SEGMENT), "left")  # segments longer than k
        for k in range(int(length.max()) if len(length) else 0):
            m = alive[k]
            at = state[:m] * 256 + text[first[:m] + k]
            total[:m] += cost[at]
            state[:m] = following[at]
        return np.bincount(row, total, len(n))


def train(docs: DataFrame, depth: int, states: int) -> Model:
    """A model of the most frequent contexts of the texts of `docs`."""
    text = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = cut(text.mapInArrow(lambda b: _count(depth, b), "run long, n long").groupBy("run").agg(F.sum("n").alias("n")), "ppm-runs")
    levels = []
    rows = counted.select(F.shiftright("run", 8).alias("context"), F.col("run").bitwiseAND(F.lit(255)).cast("int").alias("symbol"), "n")
    for j in range(depth, -1, -1):
        if j < depth:
            rows = rows.groupBy(F.col("context").bitwiseAND(F.lit((1 << 8 * j) - 1)).alias("context"), "symbol").agg(F.sum("n").alias("n"))
        levels.append(rows.select(F.lit(j).alias("order"), "context", "symbol", "n"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    every = cut(every, "ppm-contexts")
    kept = every.groupBy("order", "context").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "order", "context").limit(states)
    found = every.join(kept.select("order", "context"), ["order", "context"], "left_semi").select("order", "context", "symbol", "n").toArrow()  # at most states * 256 rows
    return Model(*(found.column(c).to_numpy() for c in ("order", "context", "symbol", "n")), depth)


# --- the whole trie, distributed ---------------------------------------------------------------------------


def _planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _from_planes(data: bytes, n: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _message(run: np.ndarray, value: np.ndarray) -> bytes:
    """Runs, in order, and a 4-byte value of each."""
    run = np.diff(run.astype(np.int64), prepend=np.int64(0))
    return len(run).to_bytes(4, "little") + pa.compress(_planes(run) + _planes(value), "zstd", asbytes=True)


def _read(data: bytes, kind: type = np.int32) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    body = pa.decompress(data[4:], 12 * n, "zstd", asbytes=True)
    return np.cumsum(_from_planes(body[: 8 * n], n, np.int64)), _from_planes(body[8 * n :], n, kind)


def _messages(block: int, known: np.ndarray, n: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(np.diff(bounds))
    data = [_message(known[bounds[k] : bounds[k + 1]], n[bounds[k] : bounds[k + 1]].astype(np.int32)) for k in some]
    return pa.RecordBatch.from_arrays([pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array(data, pa.binary())], ["block", "bucket", "data"])


def _turned(run: np.ndarray) -> np.ndarray:
    """Runs of 6 bytes with the first one last but one: those of one bucket and context of 4 bytes lie together."""
    return (run >> 8 & 0xFFFFFFFF) << 16 | run >> 40 << 8 | run & 255


def _back(turned: np.ndarray) -> np.ndarray:
    return (turned >> 8 & 255) << 40 | turned >> 16 << 8 | turned & 255


def _dealt(turned: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted turned runs by bucket, and the buckets' bounds in it."""
    of = (mixed((turned >> 16).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(buckets + 1))


def _level(run: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted runs: the number of each run's context; each context's total and its distinct symbols."""
    context = run >> 8
    new = np.concatenate([[True], context[1:] != context[:-1]])[: len(run)]
    first = np.flatnonzero(new)
    return np.cumsum(new) - 1, np.add.reduceat(n, first) if len(first) else n, np.add.reduceat((n > 0).astype(np.int64), first) if len(first) else n


def _term(n: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """log10 of a seen symbol's share, or else of the escape, where exclusion leaves these sums."""
    return np.log10(np.maximum(np.where(n > 0, n, distinct), 1)) - np.log10(np.maximum(total + distinct, 1))


def _down(run: np.ndarray, n: np.ndarray, order: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One order down from all runs of `order` that share a shorter context: the shorter runs, their counts, and
    for the unseen runs `at` their places there and their terms."""
    of, _, distinct = _level(run, n)
    low, to = np.unique(run & ((1 << 8 * order) - 1), return_inverse=True)
    counts = np.bincount(to, n, len(low)).astype(np.int64)
    below, total, symbols = _level(low, counts)
    excluded = np.bincount(of, np.where(n > 0, counts[to], 0), len(distinct)).astype(np.int64)
    own, at = of[at], to[at]
    return low, counts, at, _term(counts[at], total[below[at]] - excluded[own], symbols[below[at]] - distinct[own])


def _last(run: np.ndarray, n: np.ndarray, at: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The rest of the probabilities of unseen runs of order 2, from the counts of pairs of bytes."""
    total, distinct, single = pairs.sum(axis=1), (pairs > 0).sum(axis=1), pairs.sum(axis=0)
    of, _, own = _level(run, n)
    excluded = np.bincount(of, np.where(n > 0, pairs.ravel()[run & 0xFFFF], 0), len(own)).astype(np.int64)
    context, symbol, own_of = run[at] >> 8 & 255, run[at] & 255, of[at]
    seen = pairs[context, symbol]
    value = _term(seen, total[context] - excluded[own_of], distinct[context] - own[own_of])
    gone = ((pairs > 0) * single).sum(axis=1)
    none = np.where(single > 0, 0.0, -np.log10(max(256 - int((single > 0).sum()), 1)))
    return value + np.where(seen > 0, 0, _term(single[symbol], single.sum() - gone[context], (single > 0).sum() - distinct[context]) + none[symbol])


def _known(asked: pa.Table, back=_back) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs (or words) of a bucket and their counts."""
    run, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for k, data in enumerate(asked.column("data")):
        held.append(_read(data.as_py()))
        if sum(len(x) for x, _ in held) > 1_000_000 or k + 1 == asked.num_rows:
            both, at = np.unique(np.concatenate([run, *(back(x) for x, _ in held)]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, *(x for _, x in held)]), len(both)).astype(np.int64)
            run, held = both, []
    return run, n


def _to_shorter(fewer: int, asked: pa.Table) -> pa.Table:
    """All runs of 5 bytes of one bucket, dealt out again; those that were never seen have count 0."""
    run, n = _known(asked)
    low, to = np.unique(run & ((1 << 40) - 1), return_inverse=True)
    counts = np.bincount(to, n, len(low)).astype(np.int64)
    of = (mixed((low >> 8 & 0xFFFF).astype(np.uint64)) % np.uint64(fewer)).astype(np.int64)
    bucket = asked.column("bucket")[0].as_py()
    out = [(k, np.flatnonzero(of == k)) for k in range(fewer)]
    out = [(k, at) for k, at in out if len(at)]
    # a count beyond 4 bytes takes more than one message
    parts = [(k, _message(low[at], np.minimum(np.maximum(counts[at] - j * 2**30, 0), 2**30).astype(np.int32))) for k, at in out for j in range(int(counts[at].max()) // 2**30 + 1)]
    return pa.table({"to": pa.array([k for k, _ in parts], pa.int32()), "bucket": pa.array([bucket] * len(parts), pa.int32()), "data": pa.array([x for _, x in parts], pa.binary())})


def _shorter(pairs, rows: pa.Table) -> pa.Table:
    """The rest of the probabilities of the unseen runs of 5 bytes of each bucket."""
    parts = [_read(x.as_py()) for x in rows.column("data")]
    bucket = np.repeat(rows.column("bucket").to_numpy(), [len(x) for x, _ in parts])
    every = np.concatenate([x for x, _ in parts])
    run, where = np.unique(every, return_inverse=True)
    n = np.bincount(where, np.concatenate([x for _, x in parts]), len(run)).astype(np.int64)
    unseen = np.flatnonzero(n == 0)
    at, value, low, counts, open_ = unseen, np.zeros(len(unseen)), run, n, np.ones(len(unseen), bool)
    for order in (4, 3):
        low, counts, at, term = _down(low, counts, order, at)
        value += np.where(open_, term, 0)
        open_ &= counts[at] == 0
    value[open_] += _last(low, counts, at[open_], pairs.value)
    rest = np.zeros(len(run), np.float32)
    rest[unseen] = value
    out: dict[str, list] = {"to": [], "data": []}
    asking = n[where] == 0
    for k in np.unique(bucket[asking]):
        found = np.unique(where[asking & (bucket == k)])
        out["to"].append(int(k))
        out["data"].append(_message(run[found], rest[found]))
    return pa.table({"to": pa.array(out["to"], pa.int32()), "data": pa.array(out["data"], pa.binary())})


def _answers(asked: pa.Table, rest: pa.Table) -> pa.Table:
    """The log10 probabilities of each block's runs in one bucket."""
    run, n = _known(asked)
    of, total, distinct = _level(run, n)
    value = _term(n, total[of], distinct[of])
    unseen = np.flatnonzero(n == 0)
    low, counts, at, term = _down(run, n, 5, unseen)
    value[unseen] += term
    open_ = counts[at] == 0
    if open_.any():
        parts = [_read(x.as_py(), np.float32) for x in rest.column("data")]
        known = np.concatenate([x for x, _ in parts])
        order = np.argsort(known)
        here = np.searchsorted(known[order], low[at[open_]])
        value[unseen[open_]] += np.concatenate([x for _, x in parts])[order][here]
    value = value.astype(np.float32)
    data = [pa.compress(_planes(value[np.searchsorted(run, _back(_read(x.as_py())[0]))]), "zstd", asbytes=True) for x in asked.column("data")]
    return pa.table({"of": asked.column("block"), "packed": asked.column("bucket").cast(pa.int64()), "data": pa.array(data, pa.binary())})


def _distinct(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct turned runs of a block, and the place among them of each symbol's."""
    return np.unique(np.concatenate([_turned(runs(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).view(np.int64)) for a, b in chunks(offsets)]), return_inverse=True)


def _asked(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block asks of each bucket."""
    for block, raw, offsets, trains in _texts(batches):
        turned, at = _distinct(raw, offsets)
        n = np.bincount(at[np.repeat(trains, np.diff(offsets) + 1)], minlength=len(turned))
        order, bounds = _dealt(turned, buckets)
        yield _messages(block, turned[order], n[order], bounds)


def _scores(raw: np.ndarray, offsets: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """log10 probability of each row, from the answers to what its block asked."""
    turned, at = _distinct(raw, offsets)
    order, bounds = _dealt(turned, buckets)
    cost = np.zeros(len(turned))
    for k in range(buckets):
        m = int(bounds[k + 1] - bounds[k])
        if m:
            cost[order[bounds[k] : bounds[k + 1]]] = _from_planes(pa.decompress(answers[k], 4 * m, "zstd", asbytes=True), m, np.float32)
    return np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1), cost[at], len(offsets) - 1)


def _probabilities(blocks: DataFrame, buckets: int) -> DataFrame:
    """(of, packed, data): block, bucket and the answers of that bucket to that block."""
    spark = blocks.sparkSession
    found = blocks.select(F.explode("pairs").alias("p")).groupBy(F.shiftright("p", 40).alias("pair")).agg(F.sum(F.col("p").bitwiseAND(F.lit((1 << 40) - 1))).alias("n")).toArrow()  # at most 65,536 rows
    pairs = np.zeros(1 << 16, np.int64)
    pairs[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    pairs = spark.sparkContext.broadcast(pairs.reshape(256, 256))
    asked = blocks.select(*TEXTS).mapInArrow(lambda b: _asked(buckets, b), "block long, bucket int, data binary")
    fewer = max(1, buckets // FEWER)
    shorter = asked.groupBy("bucket").applyInArrow(lambda rows: _to_shorter(fewer, rows), "to int, bucket int, data binary")
    rest = shorter.groupBy("to").applyInArrow(lambda rows: _shorter(pairs, rows), "to int, data binary")
    return asked.groupBy("bucket").cogroup(rest.groupBy("to")).applyInArrow(_answers, "of long, packed long, data binary")


# --- scores and the base -----------------------------------------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    """Integers as compressed differences, byte plane by byte plane."""
    return pa.compress(np.diff(x.astype(np.int32), prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).ravel(), dtype=np.int32)


#: What is read of a block for its texts.
TEXTS = ("block", "held_out", "n_bytes", "text")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, bytes, offsets and training rows of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            block, held, n_bytes, text = (batch.column(c)[k] for c in TEXTS)
            trains = ~held.values.to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(_unpacked(n_bytes.as_py(), len(trains)), dtype=np.int64)])
            yield block.as_py(), np.frombuffer(pa.decompress(text.as_py(), int(offsets[-1]), "zstd", asbytes=True), np.uint8), offsets, trains


def _blocks(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of documents: its texts, counts of pairs of bytes in training, and the scores of a
    model that was given."""
    held: list[pa.RecordBatch] = []
    size, number, task = 0, 0, TaskContext.get().partitionId() << 18
    codec = pa.Codec("zstd", compression_level=LEVEL)

    def block() -> pa.RecordBatch:
        docs = pa.Table.from_batches(held).combine_chunks()
        raw, offsets = text_bytes(docs.column("text"))
        trains = ~docs.column("held_out").to_numpy(zero_copy_only=False)
        score, pairs = [], np.zeros(1 << 16, np.int64)
        for a, b in chunks(offsets):
            part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            score.append(model.value.scores(part, at) if model else np.zeros(b - a))
            pairs += np.bincount(runs(part, at, 1)[np.repeat(trains[a:b], np.diff(at) + 1)].astype(np.int64), minlength=1 << 16)
        some = np.flatnonzero(pairs)
        lists = [docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(), pa.array(np.concatenate(score)), pa.array(some << 40 | pairs[some])]
        return pa.RecordBatch.from_arrays(
            [pa.array([task + number], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists), *(pa.array([x], pa.binary()) for x in (_packed(np.diff(offsets)), codec.compress(raw.tobytes(), asbytes=True)))],
            ["block", "doc_id", "held_out", "score", "pairs", "n_bytes", "text"],
        )

    for batch in batches:
        offsets = text_bytes(batch.column("text"))[1]
        for a, b in chunks(offsets, BLOCK_BYTES):
            part = int(offsets[b] - offsets[a])
            if held and size + part > BLOCK_BYTES:
                yield block()
                held, size, number = [], 0, number + 1
            held.append(batch.slice(a, b - a))
            size += part
    if held:
        yield block()


def _words(raw: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """The distinct words of a block, the place among them and the row of each word, words by row, and the bounds
    of buckets."""
    hashes, n = [], []
    for a, b in chunks(offsets):
        _, _, h, r = words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes.append(h)
        n.append(np.diff(r))
    known, word = np.unique(np.concatenate(hashes), return_inverse=True)
    n = np.concatenate(n)
    of = (known >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return known, word, np.repeat(np.arange(len(n)), n), n, np.searchsorted(of, np.arange(buckets + 1).astype(np.uint64))


def _asked_words(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's distinct words and how often each occurs in training, by bucket."""
    for block, raw, offsets, trains in _texts(batches):
        known, word, row, _, bounds = _words(raw, offsets, buckets)
        yield _messages(block, known.view(np.int64), np.bincount(word[trains[row]], minlength=len(known)), bounds)


def _counted_words(asked: pa.Table) -> pa.Table:
    """The training counts of each block's words in one bucket; the first row has the bucket's sums."""
    word, n = _known(asked, lambda x: x)
    data = [pa.compress(_planes(n[np.searchsorted(word, _read(x.as_py())[0])]), "zstd", asbytes=True) for x in asked.column("data")]
    sums = [pa.array([int(x)] + [0] * (len(data) - 1), pa.int64()) for x in (n.sum(), (n > 0).sum())]
    return pa.table({"of": asked.column("block"), "packed": pa.array(-1 - asked.column("bucket").to_numpy().astype(np.int64)), "data": pa.array(data, pa.binary()), "total": sums[0], "distinct": sums[1]})


def _rows(total: int, distinct: int, ends: int, buckets: int, exact: bool, blocks: pa.Table, found: pa.Table) -> pa.Table:
    """The rows of one block, from the training counts of the words it has and the answers to what it asked of the
    trie."""
    answers = dict(zip(found.column("packed").to_pylist(), found.column("data").to_pylist()))
    out: dict[str, list] = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
    for k, (_, raw, offsets, trains) in enumerate(_texts(blocks.to_batches())):
        known, word, row, n, bounds = _words(raw, offsets, buckets)
        count = np.zeros(len(known), np.int64)
        for j, m in enumerate(np.diff(bounds).tolist()):
            if m:
                count[bounds[j] : bounds[j + 1]] = _from_planes(pa.decompress(answers[-1 - j], 8 * m, "zstd", asbytes=True), m, np.int64)
        add = lambda x: np.bincount(row, x[word], len(n))
        out["n_tokens"].append(n + 1)
        out["n_known"].append(add(count > 0).astype(np.int64) + (ends > 0))
        out["base_score"].append(add(np.log10(count + 1.0)) + np.log10(ends + 1.0) - (n + 1) * np.log10(total + distinct + 1.0))
        out["score"].append(_scores(raw, offsets, buckets, answers) if exact else blocks.column("score")[k].values)
        for c in ("doc_id", "held_out"):
            out[c].append(blocks.column(c)[k].values)
    kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    columns = {c: pa.chunked_array([pa.array(x) if isinstance(x, np.ndarray) else x for x in out[c]], kind) for c, kind in kinds.items()}
    return pa.table(columns | {"train_tokens": pa.array(np.full(len(columns["doc_id"]), total), pa.int64())})


def report(docs: DataFrame, depth: int = ORDER, states: int | None = None) -> DataFrame:
    """Per document: held_out, its tokens, those known from training, the base score and the model's. The model has
    all contexts of the training texts, or the `states` most frequent ones."""
    if states is None and depth != ORDER:
        raise ValueError(f"the whole trie has depth {ORDER}; another depth needs `states`")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    buckets = (size or 0) // BUCKET_BYTES + 1
    model = None if states is None else docs.sparkSession.sparkContext.broadcast(train(rows.where("NOT held_out"), depth, states))
    schema = "block long, doc_id array<long>, held_out array<boolean>, score array<double>, pairs array<long>, n_bytes binary, text binary"
    blocks = cut(rows.mapInArrow(lambda b: _blocks(model, b), schema), "ppm-blocks")
    # a word has a row's share in each block that holds it, so no word has more than its share
    used = blocks.select(*TEXTS).mapInArrow(lambda b: _asked_words(buckets, b), "block long, bucket int, data binary")
    counted = cut(used.groupBy("bucket").applyInArrow(_counted_words, "of long, packed long, data binary, total long, distinct long"), "ppm-counts")
    total, distinct = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    ends = blocks.select(F.explode("held_out").alias("h")).where("NOT h").count()
    total, distinct = int(total) + ends, int(distinct) + (ends > 0)
    found = counted.select("of", "packed", "data")
    if model is None:
        found = found.unionByName(_probabilities(blocks, buckets))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, train_tokens long"
    scored = blocks.drop("pairs").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(lambda a, b: _rows(total, distinct, ends, buckets, model is None, a, b), out)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
