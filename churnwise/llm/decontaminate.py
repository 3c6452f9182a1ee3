"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z lower-cased. A window is
`n` consecutive words of a benchmark item; an item of fewer words, but not none, is one window. The windows'
hashes are broadcast, every document's word windows are looked up in them, each hit is verified word by word,
and the words inside any verified occurrence are hit.

The benchmark is read in blocks of about `block_bytes` of text, one broadcast at a time: a pass over the documents
looks for one block and is written before the next block is read, so neither a task nor the driver ever holds
two. A larger benchmark takes more passes, with the same result. Documents are never shuffled.

Defined results: null or empty texts have no words and no hits; an item without words has no window; items
that repeat an id count once; an item whose id is null goes under the empty id; every row of a repeated
document gets its own result; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwise.llm.common import LOWER, NOT_ALNUM, chunks, cut, field, free, shingle_hashes, text_bytes, words, written

#: Bytes of benchmark text broadcast at a time (about 25 bytes of index for each window).
BLOCK_BYTES = 4_000_000
#: Slots of the bitmap that turns most windows away before the exact lookup.
SLOTS = 1 << 22

_HIT = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("item", T.StringType())]))
_HIT_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string())]))


class _Texts:
    """Words of a batch of texts, with their lower-cased bytes."""

    def __init__(self, column: pa.Array):
        raw, self.offsets = text_bytes(column)
        self.raw = LOWER[raw]
        self.starts, self.ends, self.hashes, self.rows = words(self.raw, self.offsets, NOT_ALNUM)

    def window(self, at: int, n: int) -> bytes:
        return b" ".join([self.raw[a:b].tobytes() for a, b in zip(self.starts[at : at + n], self.ends[at : at + n])])


class WindowIndex:
    """Benchmark windows by length: sorted distinct hashes, and for each the items and places it occurs."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.ids = [str(i) for i, _ in items]
        self.texts = _Texts(pa.array([t for _, t in items], pa.string()))
        counts = np.diff(self.texts.rows)
        places: dict[int, list[np.ndarray]] = {}
        for k in np.unique(np.minimum(counts[counts > 0], n)).tolist():
            rows = np.flatnonzero(np.minimum(counts, n) == k)
            of = np.concatenate([np.arange(self.texts.rows[r], self.texts.rows[r + 1] - k + 1) for r in rows])
            hashes = shingle_hashes(self.texts.hashes, k)[of]
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(SLOTS, bool)
            seen[hashes & np.uint64(SLOTS - 1)] = True
            places[k] = [hashes[order], of[order], seen]
        self.places = places

    def find(self, texts: _Texts) -> list[tuple[int, int, int, int]]:
        """(document row, first word, word after the last, item row) of every verified occurrence."""
        out = []
        row_of = None
        for k, (known, of, seen) in self.places.items():
            hashes = shingle_hashes(texts.hashes, k)
            at = np.flatnonzero(seen[hashes & np.uint64(SLOTS - 1)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(known, hashes[at]), np.searchsorted(known, hashes[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            if row_of is None:
                row_of = np.repeat(np.arange(len(texts.rows) - 1), np.diff(texts.rows))
            rows = row_of[at]
            whole = at + k <= texts.rows[rows + 1]
            for w, r, a, b in zip(at[whole].tolist(), rows[whole].tolist(), lo[whole].tolist(), hi[whole].tolist()):
                mine, base = texts.window(w, k), int(texts.rows[r])
                for p in of[a:b].tolist():
                    if self.texts.window(p, k) == mine:
                        out.append((r, w - base, w - base + k, int(np.searchsorted(self.texts.rows, p, "right")) - 1))
        return out


def _scan(index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hits of one block of the benchmark to the column `hits`, and counts words in `n_words`."""
    windows = index.value
    for batch in batches:
        column = field(batch, "text")
        for a, b in chunks(text_bytes(column)[1]):
            part = batch.slice(a, b - a)
            texts = _Texts(column.slice(a, b - a))
            hits: list[list[dict]] = [h or [] for h in part.column("hits").to_pylist()]
            for r, start, end, item in windows.find(texts):
                hits[r].append({"start": start, "end": end, "item": windows.ids[item]})
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(hits, _HIT_ARROW), pa.array(np.diff(texts.rows), pa.int64())],
                ["row", "hits", "n_words"],
            )


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, hits, n_words) for each row of `docs`: `row` is the row itself as a struct and `hits` lists
    the (first word, word after the last, item id) of each occurrence of a benchmark window."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    out = docs.select(F.struct("*").alias("row"), F.lit(None).cast(_HIT).alias("hits"), F.lit(0).cast("long").alias("n_words"))
    paths: list[str] = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        index = spark.sparkContext.broadcast(WindowIndex([tuple(r) for r in block.collect()], n))  # about block_bytes of text
        out = out.mapInArrow(lambda b, index=index: _scan(index, b), out.schema)
        if k < blocks - 1:
            out = cut(out, "decontaminate-pass")
            index.destroy()
            free(spark, paths)
            paths = written()[-1:]
    return out


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, n_items, digest, spans = [], [], [], []
        for hits in batch.column("hits").to_pylist():
            runs: list[list[int]] = []
            for h in sorted(hits, key=lambda h: h["start"]):
                if runs and h["start"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], h["end"])
                else:
                    runs.append([h["start"], h["end"]])
            ids = sorted({h["item"] for h in hits})
            spans.append([{"start": a, "end": b} for a, b in runs])
            n_hit.append(sum(b - a for a, b in runs))
            n_items.append(len(ids))
            digest.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digest, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
        )


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: its words, hit words, items found, a digest of their ids, and the hit word ranges."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, n, block_bytes).select(F.col("row.doc_id").alias("doc_id"), "hits", "n_words")
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_report, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:int,end:int>>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` that hold no benchmark window, with all their columns."""
    return find_hits(docs, benchmark, n, block_bytes).where(F.size("hits") == 0).select("row.*")
