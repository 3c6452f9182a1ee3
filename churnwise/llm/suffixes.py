"""Repeated substrings by suffix arrays: remove every byte covered by a string of `length` bytes that also starts
anywhere else in the corpus.

Texts are cut into contexts that can be sorted apart without losing a match. Every window of `length` bytes has an
anchor, the 32-byte run of smallest hash inside it; equal windows have equal anchors at equal offsets. The windows
of one anchor occurrence are consecutive starts, and the bytes they span are its context. So only contexts whose
anchors have equal hashes can share a window:

* an anchor that occurs once has no repeated window;
* contexts that are equal as a whole are one class; a class of two or more is repeated throughout;
* of anchors with several classes, one context a class goes to suffix sorting, partitioned by anchor.

A task sorts the suffixes of many contexts at once. Contexts are aligned at their anchors and read as symbols of 8
bytes. The suffix array of the symbol string is built by linear grouping: suffixes are grouped by Lyndon prefix;
groups are processed in descending order, each splitting the groups of its previous-smaller suffixes by how often
they are pointed to; then each group's order is emitted in one ascending pass along the same pointers, without
recursion or renaming. Neighbours in the array give each aligned start the longest match it has anywhere, in bytes,
so a window that begins up to 7 bytes after an aligned start is decided by it, unless its match begins between two
aligned starts; those few windows are compared byte by byte.

An anchor with more than `split` classes is dealt out again by a second anchor, of another hash. Classes that agree in
both can still be any number, as those around a common line are; where more than `split` do, Spark counts their
windows by digest instead, so no task sorts more than `split` contexts of one key.

Defined results: null text is empty; texts shorter than `length` keep all bytes; rows with equal texts repeat each
other, and so lose all bytes if they have `length` or more; rows without doc_id are treated alike. Anchors and
whole contexts are compared by 64-bit hashes, whole texts by 128 bits; windows that are sorted, byte by byte, and
windows that are counted, by 128 bits of BLAKE2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import BASE, CODES, chunks, cut, mixed, powers, signed, text_bytes

LENGTH, ANCHOR, SYMBOL = 200, 32, 8
#: Symbols sorted at once (a larger group of one anchor is sorted alone), and classes of one anchor before it is
#: dealt out again.
BATCH, SPLIT = 300_000, 20_000
#: Tasks that the windows of one digest are spread over.
SALTS = 8
#: Places of anchors in the low bits of their hashes.
_POSITION = np.uint64((1 << 24) - 1)
_INVERSE = [np.ones(1, np.uint64)]


# --- suffix arrays by linear grouping --------------------------------------------------------------------


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of `s`, whose last symbol must be smaller than all others."""
    n = len(s)
    sa = sorted(range(n), key=s.__getitem__)
    where, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, i in enumerate(sa):
        where[i] = k
        if s[i] != s[sa[start]]:
            start = k
        group[i] = start
        size[start] += 1
    previous = [-1] * n
    end = n
    while end > 0:
        first = group[sa[end - 1]]
        if end - first == 1:  # most groups are single suffixes
            i = sa[first]
            p = i - 1
            while p >= 0 and group[p] > first:
                p = previous[p]
            previous[i] = p
            end = first
            if p >= 0:
                g = group[p]
                m = size[g] - 1
                if m:
                    at, last = where[p], g + m
                    q = sa[last]
                    sa[at], sa[last], where[q], where[p] = q, p, at, last
                    size[g], group[p], size[last] = m, last, 1
            continue
        pointed: dict[int, int] = {}
        for i in sorted(sa[first:end]):
            p = i - 1
            while p >= 0 and group[p] > first:
                p = previous[p]
            if p >= 0 and group[p] == first:  # the same group: both point to one previous suffix
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = first
        if not pointed:
            continue
        most = max(pointed.values())
        if most == 1:
            layers = [list(pointed)]
        else:
            by: dict[int, list[int]] = {}
            for p, times in pointed.items():
                by.setdefault(times, []).append(p)
            layers = [by[times] for times in sorted(by, reverse=True)]
        for layer in layers:
            for p in layer:  # to the end of its group
                g = group[p]
                m = size[g] - 1
                at, last = where[p], g + m
                q = sa[last]
                sa[at], sa[last], where[q], where[p] = q, p, at, last
                size[g] = m
            for p in layer:  # the moved ones become the group that follows
                g = group[p]
                if where[p] >= g + size[g]:
                    g += size[g]
                group[p] = g
            opened = set()
            for p in layer:
                g = group[p]
                if g not in opened:
                    opened.add(g)
                    size[g] = 0
                size[g] += 1
    out, filled, placed = [-1] * n, [0] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    filled[group[n - 1]] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[g + filled[g]] = j
            filled[g] += 1
            placed[j] = True
            j = previous[j]
    return out


# --- anchors and contexts ------------------------------------------------------------------------------------


def _inverse(n: int) -> np.ndarray:
    if len(_INVERSE[0]) < n:
        step = np.full(max(n, 4096), pow(int(BASE), -1, 1 << 64), np.uint64)
        step[0] = 1
        _INVERSE[0] = np.cumprod(step)
    return _INVERSE[0]


def _sums(raw: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(CODES[raw] * powers(len(raw))[: len(raw)])])


def _range_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the bytes [a, b) wherever they lie."""
    return (sums[b] - sums[a]) * _inverse(len(sums))[a]


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = 0) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, first window, last window, anchor place) of each anchor occurrence; places are bytes
    of `raw`."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    if len(raw) < length:
        return empty
    sums = _sums(raw)
    at = np.arange(len(raw) - ANCHOR + 1)
    hashes = mixed(_range_hash(sums, at, at + ANCHOR) + np.uint64(seed))
    # sliding minimum over the runs inside a window; the place decides between equal hashes. Places share a number
    # with the hash, so they count from the start of a segment; segments overlap by all but one byte of a window
    span, windows, most = length - ANCHOR + 1, len(raw) - length + 1, int(_POSITION) + 2 - length
    place = np.zeros(windows, np.int64)
    for begin in range(0, windows, most):
        part = hashes[begin : begin + most + span - 1]
        low = part & ~_POSITION | np.arange(len(part)).astype(np.uint64)
        step = 1
        while step * 2 <= span:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < span:
            low = np.minimum(low[: len(low) - (span - step)], low[span - step :])
        place[begin : begin + len(low)] = (low & _POSITION).astype(np.int64) + begin
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    whole = np.flatnonzero(np.arange(windows) + length <= offsets[row + 1])
    if not len(whole):
        return empty
    place = place[whole]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)]))
    first, last = whole[new], whole[np.append(new[1:], len(whole)) - 1]
    return row[first], hashes[place[new]], first, last, place[new]


def _documents(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            row, anchor, first, last, place = anchors(part, at, length)
            sums = _sums(part)
            context = mixed(_range_hash(sums, first, last + length) + (place - first).astype(np.uint64) * np.uint64(7919) + (last - first).astype(np.uint64) * np.uint64(104729)) if len(row) else anchor
            bounds = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
            # (first window, windows - 1, bytes before the anchor) in one number
            where = (first - at[row]) << 20 | (last - first) << 10 | (place - first)
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (signed(anchor), signed(context), where)]
            digest = [hashlib.sha256(part[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(a, b - a) for c in ("id", "doc_id", "k1", "k2")), pa.array(np.diff(at)), pa.array(digest, pa.string()), *lists],
                ["id", "doc_id", "k1", "k2", "n_bytes", "sha256", "anchor", "context", "place"],
            )


def _contexts(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for, with those before the first aligned start (at most 7)."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        wanted = batch.column("wanted")
        bounds, inner = wanted.offsets.to_numpy(), wanted.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        anchor, context, place = (inner.field(k) for k in range(3))
        where = place.to_numpy()
        first, more, before = where >> 20, where >> 10 & 1023, where & 1023
        start = offsets[row] + first
        end = start + more + length
        for a in range(0, len(row), 20_000):
            data = [raw[x:y].tobytes() for x, y in zip(start[a : a + 20_000].tolist(), end[a : a + 20_000].tolist())]
            n = len(data)
            yield pa.RecordBatch.from_arrays([anchor.slice(a, n), context.slice(a, n), pa.array(before[a : a + n].astype(np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(data, pa.binary())], ["anchor", "context", "before", "skipped", "bytes"])


def _again(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deals contexts out by a second anchor: each becomes the contexts of the second anchors inside it."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("bytes"))
        row, second, first, last, place = anchors(raw, offsets, length, seed=1)
        key = mixed(batch.column("anchor").to_numpy().view(np.uint64)[row] + second)
        skipped = (first - offsets[row]).astype(np.int32)
        # the second anchor aligns these contexts
        data = [raw[x:y].tobytes() for x, y in zip(first.tolist(), (last + length).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(batch.column("context").to_numpy()[row]), pa.array(batch.column("anchor").to_numpy()[row]), pa.array((place - first).astype(np.int32)), pa.array(skipped), pa.array(data, pa.binary())], ["key", "context", "anchor", "before", "skipped", "bytes"])


def _windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each window of each context."""
    for batch in batches:
        texts, skipped = batch.column("bytes").to_pylist(), batch.column("skipped").to_numpy()
        for a in range(0, len(texts), 500):
            part = texts[a : a + 500]
            n = np.array([len(t) - length + 1 for t in part])
            row = np.repeat(np.arange(a, a + len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + skipped[row]
            digest = [hashlib.blake2b(t[k : k + length], digest_size=16).digest() for t in part for k in range(len(t) - length + 1)]
            own = [batch.column(c).take(pa.array(row)) for c in ("anchor", "context")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(at.astype(np.int32)), pa.array(digest, pa.binary())], ["anchor", "context", "at", "digest"])


def deal(contexts: DataFrame, classes: DataFrame, length: int, split: int) -> tuple[DataFrame, DataFrame]:
    """The contexts by key: those of keys with at most `split` of them, and the others."""
    large = cut(classes.groupBy("anchor").count().where(F.col("count") > split).select("anchor"), "repeats-large")
    once = contexts.join(large, "anchor", "left_anti").withColumn("key", F.col("anchor"))
    again = contexts.join(large, "anchor", "left_semi").mapInArrow(lambda b: _again(length, b), "key long, context long, anchor long, before int, skipped int, bytes binary")
    again = cut(again, "repeats-again")
    crowded = cut(again.groupBy("key").count().where(F.col("count") > split).select("key"), "repeats-crowded")
    return once.unionByName(again.join(crowded, "key", "left_anti")), again.join(crowded, "key", "left_semi")


def counted(crowded: DataFrame, length: int) -> DataFrame:
    """(anchor, context, runs of repeated windows), as of _sorted, from counts of the windows' digests."""
    windows = cut(crowded.mapInArrow(lambda b: _windows(length, b), "anchor long, context long, at int, digest binary"), "repeats-windows")
    twice = windows.groupBy("digest").count().where("count > 1").select("digest")
    # the windows of one digest can be many, so they meet it in several tasks
    salt, salts = F.pmod(F.col("context"), F.lit(SALTS)).cast("int"), F.array(*map(F.lit, range(SALTS)))
    found = windows.withColumn("salt", salt).join(twice.withColumn("salt", F.explode(salts)), ["digest", "salt"], "left_semi")
    # at most a context's windows
    return found.groupBy("anchor", "context").agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + 1))).alias("runs"))


# --- sorting -------------------------------------------------------------------------------------------------


def repeated(texts: list[bytes], before: np.ndarray, key: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context, whether each of its windows occurs in another place of these contexts. before: bytes
    before its anchor; key: its anchor."""
    size = np.array([len(t) for t in texts], np.int64)
    lead = before % SYMBOL  # bytes before the first aligned start
    symbols = -(-(size - lead) // SYMBOL)
    # one string of symbols, contexts padded by 0xFF, which no text holds, and closed by a separator
    room = symbols * SYMBOL
    begin = np.cumsum(room) - room
    padded = np.full(int(room.sum()), 0xFF, np.uint8)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    start = np.cumsum(size) - size
    tail = size - lead
    spread = np.repeat(begin - (np.cumsum(tail) - tail), tail) + np.arange(tail.sum())
    padded[spread] = raw[np.repeat(start + lead - (np.cumsum(tail) - tail), tail) + np.arange(tail.sum())]
    value = padded.view(">u8").astype(np.uint64)
    rank = np.unique(value, return_inverse=True)[1] + 2
    of = np.repeat(np.arange(len(texts)), symbols)  # context of each symbol
    at = np.arange(len(value)) + of  # its place in the string with separators
    string = np.ones(len(value) + len(texts) + 1, np.int64)
    string[at] = rank
    string[-1] = 0
    order = np.array(suffix_array(string.tolist()))
    inner = np.full(len(string), -1, np.int64)
    inner[at] = np.arange(len(value))
    # longest common prefix of neighbours, in symbols and then in bytes
    values = np.zeros(len(string), np.uint64)
    values[at] = value
    a, b = order[:-1], order[1:]
    match = np.zeros(len(a), np.int64)
    live = np.flatnonzero((string[a] > 1) & (string[a] == string[b]))
    while len(live):
        match[live] += 1
        x, y = a[live] + match[live], b[live] + match[live]
        live = live[(string[x] > 1) & (string[x] == string[y])]
    x, y = a + match, b + match
    both = (string[x] > 1) & (string[y] > 1)
    differ = values[x] ^ values[y]
    part = np.zeros(len(a), np.int64)
    for k in range(1, SYMBOL):
        part += differ < np.uint64(1) << np.uint64(64 - 8 * k)
    match = match * SYMBOL + np.where(both, part, 0)
    longest = np.zeros(len(string), np.int64)
    longest[a] = match
    longest[b] = np.maximum(longest[b], match)
    longest = longest[at]
    # windows: each decided by the aligned start at or before it, else a candidate if the next one allows it
    windows = size - length + 1
    of = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    after = nth - lead[of]  # bytes after the first aligned start
    index, past = after // SYMBOL, after % SYMBOL
    first = begin // SYMBOL
    here = np.where(after >= 0, longest[np.minimum(first[of] + np.maximum(index, 0), len(longest) - 1)], 0)
    yes = here >= length + past
    ahead = index + 1
    inside = ahead < symbols[of]
    next_one = np.where(inside, longest[np.minimum(first[of] + np.minimum(ahead, symbols[of] - 1), len(longest) - 1)], 0)
    maybe = (past > 0) & (next_one >= length - SYMBOL + past)
    open_ones = maybe & ~yes
    if open_ones.any():
        place = mixed(key.view(np.uint64)[of] + (before[of] - nth).astype(np.uint64))  # anchor and offset from it
        pool = np.flatnonzero(maybe)
        pool = pool[np.isin(place[pool], place[open_ones])]
        sums = _sums(raw)
        at = start[of[pool]] + nth[pool]
        hashes = _range_hash(sums, at, at + length)
        order = np.lexsort((hashes, place[pool]))
        pool, at = pool[order], at[order]
        alike = (hashes[order][1:] == hashes[order][:-1]) & (place[pool][1:] == place[pool][:-1])
        for k in np.flatnonzero(alike):  # neighbours of equal hash, byte by byte
            if not np.array_equal(raw[at[k] : at[k] + length], raw[at[k + 1] : at[k + 1] + length]):
                alike[k] = False
        yes[pool[np.concatenate([alike, [False]]) | np.concatenate([[False], alike])]] = True
    return np.split(yes, np.cumsum(windows)[:-1])


def _sorted(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, runs of repeated windows) of each context; rows come sorted by key."""
    names = ["key", "anchor", "context", "before", "skipped", "bytes"]

    def solve(rows: pa.Table) -> pa.RecordBatch:
        found = repeated(rows.column("bytes").to_pylist(), rows.column("before").to_numpy().astype(np.int64), np.ascontiguousarray(rows.column("key").to_numpy()), length)
        skipped = rows.column("skipped").to_numpy()
        runs = []
        for k, yes in enumerate(found):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], yes.view(np.int8), [0]])))
            runs.append((edge + skipped[k]).tolist())  # first window, window after the last, ...
        columns = [rows.column(c).combine_chunks() for c in ("anchor", "context")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(runs, pa.list_(pa.int32()))], ["anchor", "context", "runs"])

    carried = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]).select(names)
        rows = rows if carried is None else pa.concat_tables([carried, rows])
        carried = None
        while rows.num_rows:
            keys = rows.column("key").to_numpy()
            symbols = np.cumsum([len(b) // SYMBOL + 2 for b in rows.column("bytes").to_pylist()])
            bounds = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))  # ends of groups
            ends = bounds[:-1]  # the last group may go on in the next batch
            fit = ends[symbols[ends - 1] <= BATCH] if len(ends) else ends
            if not len(ends) or symbols[-1] <= BATCH:
                carried = rows
                break
            n = int(fit[-1]) if len(fit) else int(ends[0])
            yield solve(rows.slice(0, n))
            rows = rows.slice(n)
    if carried is not None and carried.num_rows:
        yield solve(carried.combine_chunks())


def _removed(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        for k, spans in enumerate(batch.column("spans").to_pylist()):
            text = raw[offsets[k] : offsets[k + 1]]
            depth = np.zeros(len(text) + 1, np.int32)
            starts = np.array([s["a"] for s in spans])
            ends = np.array([s["b"] for s in spans]) + length - 1  # b: the window after the last
            np.add.at(depth, starts, 1)
            np.add.at(depth, ends, -1)
            gone = np.cumsum(depth[:-1]) > 0
            kept = text[~gone].tobytes()
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())],
            ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `kept`, the remaining bytes (null where
    nothing was removed)."""
    if length < 2 * ANCHOR or length >= 1024 - ANCHOR:
        raise ValueError("length must be from 64 to 991 bytes")
    texts = _keyed(docs)
    table = "id long, doc_id long, k1 long, k2 long, n_bytes long, sha256 string, anchor array<long>, context array<long>, place array<long>"
    rows = texts.withColumn("id", F.monotonically_increasing_id()).mapInArrow(lambda b: _documents(length, b), table)
    rows = cut(rows, "repeats-anchors")  # from here on the ids are fixed
    every = rows.select("id", F.explode(F.arrays_zip("anchor", "context", "place")).alias("x")).select("id", "x.anchor", "x.context", "x.place")
    twice = every.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")).where("n > 1")
    twice = cut(twice.select("anchor", (F.col("low") != F.col("high")).alias("several")), "repeats-twice")
    found = cut(every.join(twice, "anchor"), "repeats-found")
    several = found.where("several")
    classes = several.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("id", "place")).alias("one"))
    classes = cut(classes.select("anchor", "context", "n", "one.id", "one.place"), "repeats-classes")
    # one context of each class, with its bytes
    wanted = classes.groupBy("id").agg(F.collect_list(F.struct("anchor", "context", "place")).alias("wanted"))  # at most a document's anchors
    # a text is found by its hashes and id, so that the copies of a text don't meet in one task; rows that also
    # share the id are one text here
    own = ["k1", "k2", "of"]
    of = F.coalesce("doc_id", F.lit(-1)).alias("of")
    texts = texts.select("k1", "k2", of, "text")
    wanted = rows.select("id", "k1", "k2", of).join(wanted, "id").drop("id")
    holding = texts.join(wanted, own).dropDuplicates(own)
    contexts = holding.select("text", "wanted").mapInArrow(lambda b: _contexts(length, b), "anchor long, context long, before int, skipped int, bytes binary")
    contexts = cut(contexts, "repeats-contexts")
    dealt, crowded = deal(contexts, classes, length, split)
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    runs = dealt.mapInArrow(lambda b: _sorted(length, b), "anchor long, context long, runs array<int>").where(F.size("runs") > 0)
    runs = runs.unionByName(counted(crowded, length))
    runs = cut(runs, "repeats-runs")
    # window starts [a, b) of each document that are repeated
    first, more = F.shiftright("place", 20), F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    whole = found.where("NOT several").unionByName(several.join(classes.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select(found.columns))
    spans = whole.select("id", first.alias("a"), (first + more + 1).alias("b"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("runs") / 2 - 1).cast("int")), lambda i: F.struct(F.element_at("runs", i * 2 + 1).alias("a"), F.element_at("runs", i * 2 + 2).alias("b")))
    parts = several.join(runs, ["anchor", "context"]).select("id", first.alias("first"), F.explode(pairs).alias("p"))
    spans = spans.unionByName(parts.select("id", (F.col("first") + F.col("p.a")).alias("a"), (F.col("first") + F.col("p.b")).alias("b")))
    copies = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    narrow = rows.select("id", "doc_id", "k1", "k2", "n_bytes", "sha256").join(copies, ["k1", "k2"])
    narrow = cut(narrow, "repeats-rows")
    hit = narrow.where("copies = 1").select("id", *own[:2], of).join(spans, "id").groupBy(*own).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    removed = texts.join(hit, own).mapInArrow(lambda b: _removed(length, b), "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = narrow.join(removed, ["k1", "k2"], "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)  # a copy repeats it from end to end
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(gone, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
    )


def report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")
