"""Merkle dataset manifest as a postorder append log.

Every document is a leaf; the leaves of a source, by doc_id, are folded three at a time up to the source's
subroot, and the subroots, by source, likewise up to the root of the dataset. H is the lowercase hex SHA-256
of its inputs, concatenated; digests go in as hex text.

1. Leaves are hashed in the JVM, and only digests travel on. `ranks.ranked` gives each leaf its place.
2. Aligned builders: 3^6 consecutive leaves that begin at a multiple of 3^6 are one block, whatever the size of
   the source. A block's builder folds its leaves and writes the nodes in the order in which they are complete,
   which is postorder. The block's tops are the leaves of the next tier of blocks, until one node remains.
3. A node's place in the log needs no other node: when leaf number e (from 1) is appended, the leaf and every
   node that ends with it are complete, after all nodes that ended before. The subtrees of the leaves before it
   hold sum((e - 1) div 3^l) nodes over all levels l, so the node of level l that ends at leaf e has position
   sum((e - 1) div 3^l') + l. `position` is this closed form; builders and proofs use nothing else.
4. Proofs: a block's leaves meet their block of the log, each sibling is addressed by its position, and the path
   above the block, the same for all its leaves, is extracted once in the tiers above.

The log is a table (tree, tier, block, position, digest); `verify` recomputes the root for changed leaves from
the siblings in it. Blocks hold 729 nodes at most, so no task holds a source.

Defined results: a null column goes into the leaf as `-`; a null doc_id comes before all others, and is left
untampered; rows that repeat a doc_id are leaves of their own, in the order of their leaf digests; a null source
is a source of its own, first; other columns of the table take no part; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import cut
from churnwise.llm.ranks import ranked

FANOUT = 3
#: Levels that one builder folds: a block has FANOUT ** LEVELS leaves at most.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOG = "tree long, n long, tier int, block long, position long, level int, index long, digest string"
_PATH = "tree long, at long, levels array<struct<left:string,right:string>>"
_LEVELS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def position(level: int, index: int, n: int) -> int:
    """Place (from 0) in the postorder log of a tree with `n` leaves of node `index` of `level`."""
    before = min((index + 1) * FANOUT**level, n) - 1
    at = level
    while before:
        at += before
        before //= FANOUT
    return at


def width(level: int, n: int) -> int:
    """Nodes of a level of a tree with `n` leaves."""
    return -(-n // FANOUT**level)


def height(n: int) -> int:
    level = 0
    while width(level, n) > 1:
        level += 1
    return level


# --- leaves ----------------------------------------------------------------------------------------------


def _part(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(row: dict[str, Column]) -> Column:
    """The digest of a row, from its columns by name."""
    return F.sha2(F.concat(*[_part(row[c]) for c in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): the leaf, and where the doc_id is picked for tampering the leaf of the
    row without the newlines of its text, else null."""
    own = {c: F.col(c) for c in FIELDS}
    picked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = leaf(own | {"text": F.replace("text", F.lit("\n"), F.lit(""))})
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf(own).alias("leaf"), F.when(picked, changed).alias("tampered"))


# --- builders --------------------------------------------------------------------------------------------


def fold(digests: list[str], first: int, base: int, n: int, levels: int) -> list[tuple[int, int, str]]:
    """(level, index, digest) of the nodes over `digests`, which are nodes `first`, `first` + 1 ... of level
    `base`, up to `levels` levels above or to the tree's top, in the order in which they are complete."""
    out = [(base, first + k, d) for k, d in enumerate(digests)]
    below, level = digests, base
    while level < base + levels and width(level, n) > 1:
        below = [digest(*below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)]
        level += 1
        first //= FANOUT
        out += [(level, first + k, d) for k, d in enumerate(below)]
    return sorted(out, key=lambda x: position(x[0], x[1], n))


def _builder(tier: int, levels: int):
    def build(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("at").to_pylist(), group.column("digest").to_pylist()))
        tree, n = group.column("tree")[0].as_py(), group.column("n")[0].as_py()
        first, base = rows[0][0], tier * levels
        nodes = fold([d for _, d in rows], first, base, n, levels)
        nodes = [x for x in nodes if x[0] > base or not tier]  # the tier below has written those it passed up
        block = first // FANOUT**levels
        return pa.table(
            {
                "tree": pa.array([tree] * len(nodes), pa.int64()),
                "n": pa.array([n] * len(nodes), pa.int64()),
                "tier": pa.array([tier] * len(nodes), pa.int32()),
                "block": pa.array([block] * len(nodes), pa.int64()),
                "position": pa.array([position(level, i, n) for level, i, _ in nodes], pa.int64()),
                "level": pa.array([level for level, _, _ in nodes], pa.int32()),
                "index": pa.array([i for _, i, _ in nodes], pa.int64()),
                "digest": pa.array([d for _, _, d in nodes], pa.string()),
            }
        )

    return build


@dataclass
class Manifest:
    """tiers: the log, a table for each tier of blocks; tops: (tree, digest) of each tree's last node."""

    tiers: list[DataFrame]
    tops: DataFrame
    levels: int


def build(rows: DataFrame, name: str, levels: int = LEVELS) -> Manifest:
    """The log of trees from (tree, n, at, digest): leaf `at` of the `n` leaves of `tree`."""
    unit = FANOUT**levels
    most = rows.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    while True:
        tier = len(tiers)
        blocks = rows.groupBy("tree", F.floor(F.col("at") / F.lit(unit)).alias("block"))
        tiers.append(cut(blocks.applyInArrow(_builder(tier, levels), _LOG), f"{name}-log{tier}"))
        if width((tier + 1) * levels, most) <= 1:
            break
        # what a block ends in, of the trees that have other blocks: a leaf of the next tier
        top = (tier + 1) * levels
        rows = tiers[-1].where((F.col("level") == top) & (F.col("n") > FANOUT**top)).select("tree", "n", F.col("index").alias("at"), "digest")
    whole = tiers[0]
    for more in tiers[1:]:
        whole = whole.unionByName(more)
    # the one node that holds all leaves of its tree
    tops = whole.where((F.col("index") == 0) & (F.pow(F.lit(float(FANOUT)), F.col("level")) >= F.col("n"))).select("tree", "digest")
    return Manifest(tiers, tops, levels)


# --- proofs ----------------------------------------------------------------------------------------------


def siblings(log: dict[int, str], index: int, base: int, n: int, levels: int) -> list[tuple[str, str]]:
    """For each level from `base` on, the digests left and right of node `index` and then of its ancestors in
    their runs, addressed in `log` by position."""
    out, level = [], base
    while level < base + levels and width(level, n) > 1:
        run = index - index % FANOUT
        left = "".join([log[position(level, k, n)] for k in range(run, index)])
        right = "".join([log[position(level, k, n)] for k in range(index + 1, min(run + FANOUT, width(level, n)))])
        out.append((left, right))
        index, level = index // FANOUT, level + 1
    return out


def _block(log: pa.Table) -> tuple[dict[int, str], list[tuple[str, str]], str | None, str | None]:
    """Nodes by position, the path above the block, and the tree's and the dataset's root."""
    nodes, above, subroot, root = {}, [], None, None
    for at, d, levels, sub, top in zip(*[log.column(c).to_pylist() for c in ("position", "digest", "levels", "subroot", "root")]):
        if at is None:
            above, subroot, root = [(x["left"], x["right"]) for x in levels or []], sub, top
        else:
            nodes[at] = d
    return nodes, above, subroot, root


def _paths_of(tier: int, levels: int):
    def extract(members: pa.Table, log: pa.Table) -> pa.Table:
        nodes, above, _, _ = _block(log)
        tree, at, n = (members.column(c).to_pylist() for c in ("tree", "at", "n"))
        found = [siblings(nodes, i, tier * levels, k, levels) + above for i, k in zip(at, n)]
        rows = [[{"left": a, "right": b} for a, b in path] for path in found]
        return pa.table({"tree": pa.array(tree, pa.int64()), "at": pa.array(at, pa.int64()), "levels": pa.array(rows, _LEVELS)})

    return extract


def _with_log(members: DataFrame, manifest: Manifest, tier: int, above: DataFrame | None):
    """`members` of a tier beside the nodes that their proofs need, by block. above: (tree, block, levels,
    subroot, root) of blocks."""
    unit = FANOUT**manifest.levels
    base = tier * manifest.levels
    log = manifest.tiers[tier].select("tree", "block", "position", "digest")
    if tier:
        passed = manifest.tiers[tier - 1].where((F.col("level") == base) & (F.col("n") > FANOUT**base))
        log = log.unionByName(passed.select("tree", F.floor(F.col("index") / F.lit(unit)).alias("block"), "position", "digest"))
    if above is not None:
        log = log.unionByName(above, allowMissingColumns=True)
    for c, kind in (("levels", "array<struct<left:string,right:string>>"), ("subroot", "string"), ("root", "string")):
        if c not in log.columns:
            log = log.withColumn(c, F.lit(None).cast(kind))
    members = members.withColumn("block", F.floor(F.col("at") / F.lit(unit)))
    return members.groupBy("tree", "block").cogroup(log.groupBy("tree", "block"))


def paths(manifest: Manifest, tier: int = 0) -> DataFrame | None:
    """(tree, at, levels): the siblings, level by level up to the tree's top, of every node that `tier` takes as
    leaves. None if the tier above the last is asked for."""
    if tier == len(manifest.tiers):
        return None
    base = tier * manifest.levels
    over = paths(manifest, tier + 1)
    over = over.select("tree", F.col("at").alias("block"), "levels") if over is not None else None
    source = manifest.tiers[max(tier - 1, 0)]
    members = source.where((F.col("level") == base) & (F.col("n") > FANOUT**base if tier else F.lit(True)))
    members = members.select("tree", "n", F.col("index").alias("at"))
    return _with_log(members, manifest, tier, over).applyInArrow(_paths_of(tier, manifest.levels), _PATH)


def _verified(levels: int):
    def prove(members: pa.Table, log: pa.Table) -> pa.Table:
        nodes, above, subroot, root = _block(log)
        proofs, folded = [], []
        for at, n, own, changed in zip(*[members.column(c).to_pylist() for c in ("at", "n", "leaf", "tampered")]):
            path = siblings(nodes, at, 0, n, levels) + above
            proofs.append(digest(*[x for pair in path for x in pair]))
            now = changed or own
            for left, right in path:
                now = digest(left, now, right)
            folded.append(now)
        k = len(members)
        return pa.table(
            {
                "doc_id": members.column("doc_id"),
                "leaf": members.column("leaf"),
                "subroot": pa.array([subroot] * k, pa.string()),
                "root": pa.array([root] * k, pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([x == root for x in folded], pa.bool_()),
            }
        )

    return prove


@dataclass
class Dataset:
    """rows: (doc_id, source, leaf, tampered, at, n, tree); trees: the log of the sources' trees, tree k being
    the k-th source's; top: the log of the tree over their subroots."""

    rows: DataFrame
    trees: Manifest
    top: Manifest


def manifest(docs: DataFrame, levels: int = LEVELS) -> Dataset:
    """Build and write the log of `docs`."""
    rows, sources = ranked(leaves(docs), ["source"], [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "merkle-leaves", "at", "n")
    sources, _ = ranked(sources.select("source"), [], [F.col("source").asc_nulls_first()], "merkle-sources", "tree", "sources")
    sources = sources.select(F.col("source").alias("of"), "tree", "sources")
    rows = cut(rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "merkle-rows")
    trees = build(rows.select("tree", "n", "at", F.col("leaf").alias("digest")), "merkle", levels)
    subroots = trees.tops.join(sources.select("tree", "sources"), "tree")
    top = build(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("sources").alias("n"), F.col("tree").alias("at"), "digest"), "merkle-top", levels)
    return Dataset(rows, trees, top)


def verify(data: Dataset) -> DataFrame:
    """For each document: its leaf, the roots, the digest of its proof, and the root that its row as it is now
    (tampered or not) gives with the siblings of the log."""
    blocks = data.trees.tiers[0].select("tree", "block").distinct()
    root = data.top.tops.first()  # one digest; no row if there is no document
    above = paths(data.top).select(F.col("at").alias("tree"), F.col("levels").alias("over"))
    above = cut(above.join(data.trees.tops.withColumnRenamed("digest", "subroot"), "tree"), "merkle-tops").withColumn("root", F.lit(root and root["digest"]).cast("string"))
    inner = paths(data.trees, 1)
    if inner is None:
        blocks = blocks.withColumn("levels", F.lit(None).cast("array<struct<left:string,right:string>>"))
    else:
        blocks = blocks.join(inner.withColumnRenamed("at", "block"), ["tree", "block"], "left")
    blocks = blocks.join(above, "tree").select("tree", "block", F.concat(F.coalesce("levels", F.array()), "over").alias("levels"), "subroot", "root")
    blocks = blocks.withColumn("position", F.lit(None).cast("long")).withColumn("digest", F.lit(None).cast("string"))
    members = data.rows.select("tree", "n", "at", "doc_id", "leaf", "tampered")
    kind = members.schema["doc_id"].dataType.simpleString()
    return _with_log(members, data.trees, 0, blocks).applyInArrow(
        _verified(data.trees.levels), f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def report(docs: DataFrame) -> DataFrame:
    return verify(manifest(docs))
