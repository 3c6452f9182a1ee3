"""Near-duplicate groups by b-bit MinHash.

1. One pass over the texts gives, per document, the hash of its word sequence, the size of its shingle set and
   24 band keys, each the hash of 5 minima. Documents with equal word sequences form a class; from here on a
   class counts once, under its smallest document.
2. Classes that share a band key are candidates. Of their 512 minima the low 4 bits are retained and packed (256
   bytes). A pair's similarity is estimated from the bits: the share of equal 4-bit fields, corrected for the 1
   in 16 that agree by chance. Pairs estimated under `cutoff` go; the rest are confirmed on full shingle sets.
3. No bucket's pairs are all emitted. First each member is held against its bucket's smallest member. Then
   components are built, and only buckets that still span several components are looked at again: members
   outside the bucket's largest component are held against the members of other components, in blocks of
   bounded size, the best estimates first, each pair only in the first band it shares. The last round has no
   limit on partners, so a link can only be skipped where its two ends are connected already.

At a similarity of 0.85 a pair shares no band with probability 8e-7, and the cutoff is 4.5 standard
deviations of the estimate under it. Shingles and word sequences are compared by 64- and 128-bit hashes.

Defined results: a document without words has an empty set, links with nothing and is its own component; rows
that repeat a doc_id with another text each get the component of their own text, and are one node where both
are the smallest of their class; a row without doc_id takes a stand-in id from its text, above all real ids,
and reports its component as null if no document with an id belongs to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.llm.common import chunks, cut, fold, mixed, shingle_hashes, signed, text_bytes, words
from churnwise.llm.components import components

WORDS = 5
ROWS, BANDS = 5, 24
#: Minima in a signature, and the low bits kept of each.
K, BITS = 512, 4
CUTOFF = 0.775
#: Members of one bucket that meet in one block.
BLOCK = 512
#: Partners of a member, per block, in each round after the first; None: all.
ROUNDS = (4, 64, None)
#: Stand-in ids of rows without doc_id begin here.
NO_ID = 1 << 62

_RNG = np.random.default_rng(5151)
_MULT = _RNG.integers(0, 2**31, K, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 2**32, K, dtype=np.uint32)
_EQUAL = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def node_id(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID) + F.xxhash64(text).bitwiseAND(F.lit((1 << 61) - 1)))


def _sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word hashes, sorted distinct shingle hashes) of each row."""
    _, _, hashes, rows = words(raw, offsets)
    all_shingles = shingle_hashes(hashes, WORDS)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= WORDS:
            yield hashes[a:b], np.unique(all_shingles[a : b - WORDS + 1])
        elif b > a:
            yield hashes[a:b], np.array([fold(hashes[a:b])], np.uint64)
        else:
            yield hashes[a:b], np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray, k: int) -> np.ndarray:
    low = np.full(k, 2**32 - 1, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(low, (_MULT[:k, None] * x[None, at : at + 1024] + _PLUS[:k, None]).min(axis=1), out=low)
    return low


def pack(minima: np.ndarray) -> np.ndarray:
    """The low 4 bits of each (scrambled) minimum, two to a byte."""
    x = (minima ^ (minima >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    low = ((x ^ (x >> np.uint32(13))) & np.uint32(15)).astype(np.uint8)
    return low[..., ::2] << 4 | low[..., 1::2]


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures."""
    agree = _EQUAL[a ^ b].sum(axis=-1, dtype=np.int32) / K
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            minima, sizes, keys = np.zeros((b - a, ROWS * BANDS), np.uint32), np.zeros(b - a, np.int64), np.zeros((b - a, 2), np.uint64)
            for i, (hashes, shingles) in enumerate(_sets(part, at)):
                sizes[i] = len(shingles)
                keys[i] = fold(hashes), fold(mixed(hashes))
                minima[i] = _minima(shingles, ROWS * BANDS)
            bands = np.zeros((b - a, BANDS), np.uint64)
            for r in range(ROWS):
                bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + minima[:, r::ROWS].astype(np.uint64) + np.arange(BANDS, dtype=np.uint64))
            some = sizes > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(signed(bands[some].ravel())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), batch.column("node").slice(a, b - a), pa.array(signed(keys[:, 0])), pa.array(signed(keys[:, 1])), pa.array(sizes), lists],
                ["doc_id", "node", "k1", "k2", "n_shingles", "bands"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, node, k1, k2, n_shingles, bands) of each row of docs."""
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_id(F.col("doc_id"), text).alias("node"), text.alias("text"))
    return narrow.mapInArrow(_sign, "doc_id long, node long, k1 long, k2 long, n_shingles long, bands array<long>")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            sets = [s for _, s in _sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])]
            packed = [pack(_minima(s, K)).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(packed, pa.binary())], ["node", "shingles", "sig"])


def _estimated(batches: Iterator[pa.RecordBatch], cutoff: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, K // 2) for c in ("sa", "sb"))
            yield batch.filter(pa.array(estimate(a, b) >= cutoff)).select(["a", "b"])


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("xa"), batch.column("xb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _across(batches: Iterator[pa.RecordBatch], cutoff: float, most: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs (outlier, member of another component) of each block, the best `most` of each outlier, with a mark
    where it has more. Rows come sorted by block; a block is bounded, so at most one block is carried from batch to
    batch."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, comp, out = (rows.column(c).to_numpy() for c in ("node", "component", "outlier"))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, K // 2)
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        keys = np.stack([rows.column(c).to_numpy() for c in ("bkey", "ob", "mb")])
        bounds = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        left, right, over = [], [], []
        for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), len(ids)]):
            outs, members = a + np.flatnonzero(out[a:b]), a + np.flatnonzero(~out[a:b])
            for o in outs.tolist():
                other = members[comp[members] != comp[o]]
                close = estimate(sig[o], sig[other]) if len(other) else np.zeros(0)
                at = np.flatnonzero(close >= cutoff)
                first = (bands[o] == bands[other[at]]).argmax(axis=1)
                at = at[bands[o][first] == keys[0, a]]
                over.append(most is not None and len(at) > most)
                if over[-1]:
                    at = at[np.lexsort((ids[other[at]], -close[at]))[:most]]
                left.append(np.full(len(at), ids[o]))
                right.append(ids[other[at]])
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            capped = np.repeat(np.array(over, bool), [len(z) for z in left])
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(capped)], ["a", "b", "capped"])

    carried = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if carried is None else pa.concat_tables([carried, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        keys = np.stack([rows.column(c).to_numpy() for c in ("bkey", "ob", "mb")])
        last = int(np.flatnonzero((keys == keys[:, -1:]).all(axis=0))[0])
        if last:
            yield from pairs(rows.slice(0, last))
        carried = rows.slice(last)
    if carried is not None:
        yield from pairs(carried)


def near_duplicates(docs: DataFrame, percent: int = 85, cutoff: float = CUTOFF, rounds: tuple = ROUNDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, node, n_shingles, component) of each row of docs; component is the smallest node reachable over
    links of 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    signed_docs = cut(signatures(docs), "minhash-signatures")
    classes = cut(signed_docs.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("node").alias("rep")), "minhash-classes")
    # rows of one class that share its smallest id have equal signatures
    reps = signed_docs.join(classes.withColumnRenamed("rep", "node"), ["k1", "k2", "node"], "left_semi").dropDuplicates(["k1", "k2"])
    banded = reps.select("node", F.explode("bands").alias("bkey"))
    shared = banded.groupBy("bkey").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot != last").select("bkey", "pivot")
    members = cut(banded.join(shared, "bkey").distinct(), "minhash-members")
    ids = cut(members.select("node").distinct(), "minhash-ids")
    text = F.col("text").cast("string")
    texts = docs.select(node_id(F.col("doc_id"), text).alias("node"), text.alias("text")).join(ids, "node", "left_semi")
    sets = cut(texts.mapInArrow(_shingles, "node long, shingles binary, sig binary"), "minhash-sets")
    sigs = sets.select("node", "sig")

    def confirm(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
        sides = sides.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
        return sides.mapInArrow(lambda x: _confirmed(x, percent), "a long, b long").distinct()

    stars = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    tested = cut(stars.mapInArrow(lambda x: _estimated(x, cutoff), "a long, b long").distinct(), "minhash-pairs")
    found = components(confirm(tested))
    for most in rounds:
        placed = members.join(found, "node", "left").select("bkey", "node", F.coalesce("component", "node").alias("component"))
        parts = placed.groupBy("bkey", "component").agg(F.count("*").alias("n"))
        open_buckets = parts.groupBy("bkey").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("inside")).where("n > inside")
        rows = placed.join(open_buckets, "bkey").join(sigs.join(reps.select("node", "bands"), "node"), "node").withColumn("outlier", F.col("component") != F.col("largest"))
        blocks = {"no": F.ceil((F.col("n") - F.col("inside")) / block).cast("int"), "nm": F.ceil(F.col("n") / block).cast("int")}
        rows = rows.withColumns(blocks)
        cell = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
        span = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        held = rows.where("outlier").withColumn("ob", cell("no")).withColumn("mb", span("nm"))
        against = rows.withColumn("outlier", F.lit(False)).withColumn("mb", cell("nm")).withColumn("ob", span("no"))
        cells = held.unionByName(against).select("bkey", "ob", "mb", "node", "component", "sig", "bands", "outlier")
        cells = cells.repartition("bkey", "ob", "mb").sortWithinPartitions("bkey", "ob", "mb")
        pairs = cells.mapInArrow(lambda x, most=most: _across(x, cutoff, most), "a long, b long, capped boolean")
        pairs = cut(pairs.groupBy("a", "b").agg(F.max("capped").alias("capped")), "minhash-across")
        capped = pairs.agg(F.max("capped")).first()[0]
        pairs = cut(pairs.select("a", "b").join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        if pairs.isEmpty():
            if not capped:
                break
            continue  # the best were tested before; those cut off come in a later round
        links = confirm(pairs)
        found = components(links.unionByName(found.select(F.col("component").alias("a"), F.col("node").alias("b"))))
        tested = tested.unionByName(pairs)
    of = classes.join(found, classes["rep"] == found["node"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    placed = signed_docs.select("doc_id", "node", "k1", "k2", "n_shingles").join(of, ["k1", "k2"], "left")
    return placed.select("doc_id", "node", "n_shingles", F.coalesce("component", "node").alias("component"))


def report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    component = F.when(F.col("component") < NO_ID, F.col("component"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of `docs` of which one is left for each group, with all their columns: the row whose id is
    the group's smallest. `percent` is the least similarity of a link, above which groups are built.

    Rows are told apart by their text, not by their id: where unlike texts share an id, each is a document of its own
    (and comes after all others in its group, like a row without id); of rows equal in id and text one is left. The
    default is op1's threshold: the stage drops what op1 calls a copy."""
    mark = F.xxhash64("text")
    shared = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
    # written, so that its size is known: Spark broadcasts it if it is small, and joins by shuffle otherwise
    shared = cut(shared.where(~F.col("least").eqNullSafe(F.col("most"))).select("doc_id", F.lit(True).alias("shared")), "minhash-shared-ids")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string").alias("text")).join(shared, "doc_id", "left")
    rows = rows.select("row", F.when(F.col("shared").isNull(), F.col("doc_id")).alias("doc_id"), "text")
    keep = near_duplicates(rows.select("doc_id", "text"), percent).where("node = component").groupBy("node").agg(F.max("n_shingles").alias("n"))
    rows = rows.select("row", node_id(F.col("doc_id"), F.col("text")).alias("node")).join(keep, "node")
    # documents without words are copies of nothing but their own rows
    same = Window.partitionBy("node", F.when(F.col("n") == 0, F.col("row.doc_id"))).orderBy("row.text")
    return rows.withColumn("nth", F.row_number().over(same)).where("nth = 1").select("row.*")
