"""Conversation prefix trie as a Z-fast trie.

A node of the trie is a distinct sequence of first turns. Only compacted nodes are indexed (branching points, ends
of conversations, and every SPAN-th depth); an edge (p, e] stands for the nodes of depths p + 1 to e. Each edge is
hashed once, at its handle: the prefix at the two-fattest number of (p, e], the one with the most trailing zeros.

1. Turns are placed in their conversation by `ranks.ranked`, conversations are rebuilt, and a prefix is named by
   128 bits: the exclusive or of the md5 of each (place, turn) in it. That is associative, so a conversation is cut
   into pieces of SPAN turns without one task ever holding it. Equal pieces are one from here on.
2. Batches: every piece not yet in the trie is located by fat binary search. Each step asks the table of handles
   for the prefix at the two-fattest depth of the open interval (one equi-join): a hit moves to the end of that
   edge, a miss cuts the interval. Then the first turn past the deepest node on the path gives the exit edge, and
   the piece's place of exit in it. Of the pieces that leave at one place with one next turn the least by hash is
   inserted; it may split the exit edge and hangs a new edge there. The others go into the next batch, deeper down.
   Every batch inserts a piece at each open place, so the number of batches is about the logarithm of the pieces.
3. Members, leaves and saved tokens are sums over subtrees of compacted nodes by pointer doubling (a logarithmic
   number of joins), and edges are expanded to their nodes at the end.

No conversation, node or first turn is collected into one task: pieces and edges hold SPAN turns at most, sums are
pre-aggregated, and ids that end at a node are hashed from packed runs in a stream.

Defined results: a null role or text is empty; a turn without conv_id belongs to no conversation; rows that
repeat (conv_id, turn) follow each other by the digest of role and text; a null turn comes first; a table without
conversations has no nodes; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.llm.common import cut
from churnwise.llm.ranks import ranked

#: Turns of a piece, and the depths at which a node is kept in any case: a power of two.
SPAN = 256
#: A conversation borrows its first turns from the first one of its block of ids.
BLOCK, BORROWS = 20, 4
_WORD = r"[^\x20\x09-\x0D]+"
_ID = ("depth", "x1", "x2")


# --- conversations to pieces -----------------------------------------------------------------------------


def turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, digest, words, n): the turns in order, and (conv_id, n): the conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, F.octet_length(text).cast("string"), F.lit(":"), text)
    narrow = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.sha2(named, 256).alias("digest"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words")
    )
    placed, own = ranked(narrow, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest").asc()], "trie-turns", "at", "n")
    return placed.drop("turn"), own


def rebuilt(placed: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, digest, words) of the rebuilt conversations, and (conv_id) of those without a turn."""
    h = F.crc32(F.col("conv_id").cast("string")) % BORROWS
    convs = own.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("from"))
    donors = own.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("from"), F.col("n").alias("there"))
    convs = cut(convs.join(donors, "from", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0)))), "trie-conversations")
    firsts = placed.where((F.col("conv_id") % BLOCK == 0) & (F.col("at") < BORROWS - 1)).select(F.col("conv_id").alias("from"), "at", "digest", "words")
    borrowed = convs.join(firsts, "from").where("at < h").select("conv_id", "at", "digest", "words")
    later = placed.join(convs.select("conv_id", "h", "k"), "conv_id").where("at >= h")
    later = later.select("conv_id", (F.col("at") - F.col("h") + F.col("k")).alias("at"), "digest", "words")
    return borrowed.unionByName(later), convs.where("k = 0 and n <= h").select("conv_id")


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running exclusive ors and word counts over the turns of each piece, from the state before it."""
    for batch in batches:
        body = batch.column("turns")
        starts = body.offsets.to_numpy()
        flat = body.flatten()
        x1, x2, words = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "x2", "words"))
        out: list[list[np.ndarray]] = [[], [], []]
        for a, b, r1, r2 in zip(starts[:-1] - starts[0], starts[1:] - starts[0], batch.column("r1").to_pylist(), batch.column("r2").to_pylist()):
            out[0].append(np.bitwise_xor.accumulate(np.concatenate([[r1], x1[a:b]]).astype(np.int64)))
            out[1].append(np.bitwise_xor.accumulate(np.concatenate([[r2], x2[a:b]]).astype(np.int64)))
            out[2].append(np.concatenate([[0], np.cumsum(words[a:b])]).astype(np.int64))
        arrays = [pa.array(x, pa.list_(pa.int64())) for x in out]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("r"), batch.column("last"), *arrays], ["conv_id", "r", "last", "h1", "h2", "cw"])


def pieces(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """(conv_id, r, last, h1, h2, cw): up to `span` turns of a conversation, those after depth r. Entry i of the
    arrays is the name of the prefix of depth r + i and the words of turns r + 1 to r + i."""
    named = F.md5(F.concat(F.col("at").cast("string"), F.lit(":"), F.col("digest")))
    half = [F.conv(F.substring(named, k, 16), 16, -10).cast("long") for k in (1, 17)]
    rows = rows.select("conv_id", "at", "words", half[0].alias("x1"), half[1].alias("x2"))
    grouped = rows.groupBy("conv_id", (F.col("at") - F.col("at") % span).alias("r")).agg(
        F.sort_array(F.collect_list(F.struct("at", "x1", "x2", "words"))).alias("turns"), F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2")
    )  # span turns at most
    order = Window.partitionBy("conv_id").orderBy("r")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    grouped = grouped.select(
        "conv_id", "r", "turns", F.coalesce(F.bit_xor("t1").over(before), zero).alias("r1"), F.coalesce(F.bit_xor("t2").over(before), zero).alias("r2"), F.lead("r").over(order).isNull().alias("last")
    )
    lists = ", ".join(f"{c} array<long>" for c in ("h1", "h2", "cw"))
    return cut(grouped.mapInArrow(_prefixes, f"conv_id long, r long, last boolean, {lists}"), "trie-pieces")


# --- the trie --------------------------------------------------------------------------------------------


def fattest(lo: Column, hi: Column) -> Column:
    """The number in (lo, hi] with the most trailing zeros."""
    bit = F.length(F.bin(lo.bitwiseXOR(hi))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", hi, bit), bit)


def _name(depth: Column, h1: Column, h2: Column) -> Column:
    return F.struct(depth.cast("long").alias("depth"), h1.alias("x1"), h2.alias("x2"))


def _prefix(i: Column, start: Column | int = 0) -> Column:
    """Name of the prefix of local depth i, from arrays that begin at local depth `start`."""
    return _name(F.col("r") + i, F.get("h1", i - start), F.get("h2", i - start))


def indexed(edges: DataFrame) -> DataFrame:
    """Edges (r, lo, h1, h2, cw; the arrays cover local depths lo to hi) with hi, id, parent, and child: the name
    of the first prefix of the edge."""
    edges = edges.withColumn("hi", F.col("lo") + F.size("h1") - 1)
    lo = F.col("lo")
    return edges.withColumns({"id": _prefix(F.col("hi"), lo), "parent": _prefix(lo, lo), "child": _prefix(lo + 1, lo)})


def locate(rest: DataFrame, edges: DataFrame) -> DataFrame:
    """`rest` with `lo`: the local depth of the deepest compacted node on each piece's path, by fat binary search."""
    lo, hi = F.col("lo"), F.col("hi")
    f = fattest(lo, hi)
    handles = cut(edges.select(_prefix(f, lo).alias("handle"), lo.alias("from"), hi.alias("to"), F.col("id.x1").alias("x1"), F.col("id.x2").alias("x2")), "trie-handles")
    now = rest.withColumns({"lo": F.lit(0), "hi": F.col("len")})
    closed = []
    while True:
        asked = now.withColumn("f", f).withColumn("handle", _prefix(F.col("f")))
        hit = F.col("to").isNotNull()
        # an edge whose handle is on the path, but whose end is not, is the one the piece leaves
        whole = F.coalesce((F.get("h1", F.col("to")) == F.col("x1")) & (F.get("h2", F.col("to")) == F.col("x2")), F.lit(False))
        found = asked.join(handles, "handle", "left").select(
            *rest.columns, F.when(whole, F.col("to")).when(hit, F.col("from")).otherwise(lo).alias("lo"), F.when(whole, hi).when(hit, F.col("from")).otherwise(F.col("f") - 1).alias("hi")
        )
        found = cut(found, "trie-search")
        closed.append(found.where("lo >= hi").drop("hi"))
        now = found.where("lo < hi")
        if now.isEmpty():
            break
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def exits(located: DataFrame, edges: DataFrame) -> DataFrame:
    """Each piece with `x`, the local depth to which its path is in the trie, and `edge`, the id of the edge that
    ends further down there, if x lies inside one."""
    asked = located.withColumn("child", F.when(F.col("lo") < F.col("len"), _prefix(F.col("lo") + 1)))
    there = edges.select("child", F.col("id").alias("edge"), F.col("h1").alias("o1"), F.col("h2").alias("o2"))
    both = asked.join(there, "child", "left")

    def same(own: str, other: str) -> Column:
        # names differ from the first turn that differs on
        flags = F.zip_with(F.slice(own, F.col("lo") + 1, F.size(other)), F.col(other), lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.size(F.filter(flags, lambda x: x)) - 1

    shared = F.when(F.col("edge").isNull(), 0).otherwise(F.least(same("h1", "o1"), same("h2", "o2")))
    return both.select(*[c for c in located.columns if c != "lo"], (F.col("lo") + shared).alias("x"), F.when(shared > 0, F.col("edge")).alias("edge"))


def _split(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The edges, cut at the depths where pieces leave them."""
    cuts = found.where(F.col("edge").isNotNull()).groupBy(F.col("edge").alias("id")).agg(F.sort_array(F.collect_set("x")).alias("cuts"))  # under SPAN
    both = edges.join(cuts, "id", "left")
    bounds = F.concat(F.array("lo"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("hi"))
    both = both.withColumn("bounds", bounds).withColumn("n", F.size("bounds") - 1)
    both = both.withColumn("a", F.explode(F.arrays_zip(F.slice("bounds", 1, F.col("n")).alias("a"), F.slice("bounds", 2, F.col("n")).alias("b"))))
    part = lambda c: F.slice(c, F.col("a.a") - F.col("lo") + 1, F.col("a.b") - F.col("a.a") + 1).alias(c)
    return both.select("r", F.col("a.a").alias("lo"), part("h1"), part("h2"), part("cw"))


def build(distinct: DataFrame) -> DataFrame:
    """The edges of the trie over distinct pieces (r, h1, h2, cw)."""
    rest = distinct.select("r", "h1", "h2", "cw", (F.size("h1") - 1).alias("len"))
    edges = None
    while True:
        if edges is None:
            found = rest.withColumns({"x": F.lit(0), "edge": F.lit(None).cast("struct<depth:long,x1:long,x2:long>")})
        else:
            found = exits(locate(rest, edges), edges)
        found = cut(found, "trie-exits")
        x = F.col("x")
        todo = found.where("x < len").withColumns({"next": _prefix(x + 1), "mine": F.get("h1", F.col("len"))})
        leaders = todo.groupBy("next").agg(F.min("mine").alias("least"))
        todo = cut(todo.join(leaders, "next"), "trie-batch")
        tail = lambda c: F.slice(c, x + 1, F.col("len") - x + 1).alias(c)
        fresh = todo.where("mine = least").select("r", x.alias("lo"), tail("h1"), tail("h2"), tail("cw"))
        edges = cut(indexed(fresh if edges is None else _split(edges, found).unionByName(fresh)), "trie-edges")
        rest = todo.where("mine != least").select("r", "h1", "h2", "cw", "len")
        if rest.isEmpty():
            return edges


def subtree_sums(values: DataFrame, parents: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """`values` (id, ...) with each column in `sums` summed, and the minimum of each in `least` taken, over the
    subtree of the node, by pointer doubling over parents (id, up)."""
    while not parents.isEmpty():
        gathered = parents.join(values, "id").groupBy(F.col("up").alias("id")).agg(*[F.sum(c).alias(f"_{c}") for c in sums], *[F.min(c).alias(f"_{c}") for c in least])
        joined = values.join(gathered, "id", "left")
        total = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums] + [F.least(c, f"_{c}").alias(c) for c in least]
        kept = [c for c in values.columns if c not in (*sums, *least)]
        values = cut(joined.select(*kept, *total), "trie-sums")
        above = parents.select(F.col("id").alias("up"), F.col("up").alias("over"))
        parents = cut(parents.join(above, "up").select("id", F.col("over").alias("up")), "trie-pointers")
    return values


# --- ends ------------------------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one node, as one row with their ids in order."""
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in _ID]))
        ids = batch.column("conv_id").to_pylist()
        starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]] + [len(keys)]
        spans = list(zip(starts[:-1], starts[1:]))
        columns = [pa.array([keys[a][j] for a, _ in spans], pa.int64()) for j in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([ids[a] for a, _ in spans], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string())], [*_ID, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the packed ids of each node; rows come sorted, and a node may go on in the next batch."""
    key, state = None, None

    def rows(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([k[j] for k, _ in done], pa.int64()) for j in range(3)], pa.array([s.hexdigest() for _, s in done], pa.string())], [*_ID, "ends_sha256"])

    for batch in batches:
        done = []
        for *now, ids in zip(*[batch.column(c).to_pylist() for c in (*_ID, "ids")]):
            if now != key:
                if key is not None:
                    done.append((key, state))
                key, state = now, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield rows(done)
    if key is not None:
        yield rows([(key, state)])


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) from ends (id, conv_id)."""
    flat = ends.select("id.*", "conv_id")
    packed = flat.repartitionByRange(*_ID, "conv_id").sortWithinPartitions(*_ID, "conv_id").mapInArrow(_pack, "depth long, x1 long, x2 long, first long, ids string")
    hashed = packed.repartition(*_ID).sortWithinPartitions(*_ID, "first").mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")
    return hashed.select(F.struct(*_ID).alias("id"), "ends_sha256")


# --- nodes -----------------------------------------------------------------------------------------------


def report(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    rows, turnless = rebuilt(*turns(conversations))
    cutup = pieces(rows, span)
    zero = F.lit(0).cast("long")
    end = _prefix(F.size("h1") - 1)
    own = cutup.withColumn("id", end)
    ends = own.where("last").select("id", "conv_id").unionByName(turnless.select(_name(zero, zero, zero).alias("id"), "conv_id"))
    ends = cut(ends, "trie-ends")
    # equal pieces are one: the one of the smallest conversation
    first = own.groupBy("id").agg(F.min("conv_id").alias("conv_id"))
    edges = build(cut(own.join(first, ["id", "conv_id"]).select("r", "h1", "h2", "cw"), "trie-distinct"))
    weights = ends.groupBy("id").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("least"))
    branches = edges.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    root = ends.limit(1).select(_name(zero, zero, zero).alias("id"))  # there is one if there are conversations
    ids = edges.select("id").unionByName(root)
    nodes = ids.join(weights, "id", "left").join(branches, "id", "left")
    nodes = nodes.select("id", F.coalesce("n_convs", zero).alias("n_convs"), "least", F.coalesce("n_children", zero).alias("n_children"))
    nodes = cut(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "trie-nodes")
    parents = cut(edges.select("id", F.col("parent").alias("up")), "trie-parents")
    nodes = subtree_sums(nodes, parents, ["n_convs", "n_leaves"], ["least"])
    words = edges.select("id", (F.element_at("cw", -1) - F.element_at("cw", 1)).alias("words"))
    saved = nodes.join(words, "id", "left").select("id", ((F.col("n_convs") - 1) * F.coalesce("words", zero)).alias("saved"))
    saved = subtree_sums(cut(saved, "trie-saved"), parents, ["saved"], [])
    nodes = cut(nodes.join(saved, "id").join(end_digests(ends), "id", "left"), "trie-results")
    over = nodes.select(F.col("id").alias("parent"), F.col("least").alias("parent_least"))
    lines = edges.select("id", "parent", "r", "lo", "cw").join(nodes, "id").join(over, "parent")
    lines = lines.withColumn("d", F.explode(F.sequence(F.lit(1), F.size("cw") - 1)))  # under SPAN
    inner = F.col("d") < F.size("cw") - 1
    none = F.lit(hashlib.sha256(b"").hexdigest())
    before = F.get("cw", F.col("d") - 1) - F.get("cw", F.lit(0))
    expanded = lines.select(
        F.col("least").alias("conv_id"),
        (F.col("r") + F.col("lo") + F.col("d")).cast("long").alias("depth"),
        F.when(F.col("d") == 1, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        "n_convs",
        F.when(inner, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * before).alias("saved_tokens"),
        F.when(inner, none).otherwise(F.coalesce("ends_sha256", none)).alias("ends_sha256"),
    )
    top = nodes.where("id.depth = 0").select(
        F.col("least").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
    return expanded.unionByName(top)
