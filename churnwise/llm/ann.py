"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

1. Rows with equal vectors form a class. A class is indexed once, under its smallest id, with its `k + 1`
   smallest ids: no query can need more of them, so nothing is lost and a very common vector costs one row.
2. The trees are fitted on the driver on a bounded sample of classes (`SAMPLE`, those with the smallest hashed
   ids): each node splits at the median along the difference of two random members. Vectors get one more
   component, sqrt(max norm^2 - norm^2), so that a larger inner product is a smaller angle.
3. Every class goes to its leaf of each tree. A query walks all trees through one priority queue, ordered by the
   smallest margin on the path, and takes leaves until they hold `effort` times the table.
4. Leaves are scanned where they lie: cells of bounded size hold leaves of one tree, and the queries that chose
   any of them come in blocks. Each cell returns each query's best with their exact inner products in double
   precision; the best of all cells are ranked.

Nothing in a 64-dimensional cloud without clusters can be found by looking at a few leaves; there the default
effort reads about two thirds of the rows for a recall of 0.95. Clustered vectors need far less.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part; vectors of
unlike lengths have no inner product, so each length is a table of its own; equal scores go to the smaller vec_id;
a query finds all candidates if there are fewer than k; rows that repeat a vec_id with the same vector count once,
and unlike vectors of one id are queries of their own, each with its own ranks, and never that id's candidates; a row
without vec_id takes no part; an empty table finds nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnwise.llm.common import cut

TREES, LEAF, SAMPLE = 8, 128, 20_000
#: Rows that a query's leaves hold together, over all trees, as a share of the table.
EFFORT = 1.2
#: Classes and queries that meet in one cell.
CELL_ROWS, CELL_QUERIES = 65_536, 1_024
_AT_ONCE = 128


class Forest:
    """Random-projection trees. Leaves are numbered through all trees, in order."""

    def __init__(self, sample: np.ndarray, top: float, trees: int = TREES, leaf: int = LEAF, seed: int = 3):
        self.top = top
        rng = np.random.default_rng(seed)
        x = self.raised(sample)
        self.normals: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[tuple[int, int]] = []  # of node k; a leaf l is ~l
        self.tree_of: list[int] = []
        self.roots = [self._grow(x, np.arange(len(x)), rng, leaf, t) for t in range(trees)]
        self.planes = np.array(self.normals).reshape(len(self.normals), x.shape[1])

    def raised(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def _grow(self, x: np.ndarray, at: np.ndarray, rng: np.random.Generator, leaf: int, tree: int) -> int:
        normal = np.zeros(x.shape[1])
        if len(at) > leaf:
            a, b = rng.choice(at, 2, replace=False)
            normal = x[a] - x[b]
        size = np.linalg.norm(normal)
        side = x[at] @ normal
        threshold = float(np.median(side)) if len(at) else 0.0
        left = side <= threshold
        if not size or left.all():  # small enough, or nothing to tell the members apart
            self.tree_of.append(tree)
            return ~(len(self.tree_of) - 1)
        node = len(self.normals)
        self.normals.append(normal / size)
        self.thresholds.append(threshold / size)
        self.children.append((0, 0))
        self.children[node] = (self._grow(x, at[left], rng, leaf, tree), self._grow(x, at[~left], rng, leaf, tree))
        return node

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        x = self.raised(x)
        out = np.zeros((len(x), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(x)))]
            while todo:
                node, at = todo.pop()
                if node < 0:
                    out[at, t] = ~node
                elif len(at):
                    left = x[at] @ self.normals[node] <= self.thresholds[node]
                    todo += [(self.children[node][0], at[left]), (self.children[node][1], at[~left])]
        return out

    def search(self, x: np.ndarray, sizes: np.ndarray, budget: float) -> list[list[int]]:
        """Leaves for each query, the nearest first, until they hold `budget` rows."""
        x = np.concatenate([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.zeros((len(x), 1))], axis=1)
        scale = np.sqrt(self.top) or 1.0  # items have this norm, queries norm 1
        margins = x @ self.planes.T - np.array(self.thresholds) / scale if len(self.planes) else np.zeros((len(x), 0))
        out = []
        for margin in margins:
            queue = [(-np.inf, node) for node in self.roots]
            heapq.heapify(queue)
            found, held = [], 0.0
            while queue and held < budget:
                far, node = heapq.heappop(queue)
                if node < 0:
                    found.append(~node)
                    held += sizes[~node]
                else:
                    left, right = self.children[node]
                    heapq.heappush(queue, (max(far, margin[node]), left))
                    heapq.heappush(queue, (max(far, -margin[node]), right))
            out.append(found)
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _leaves(forest, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = forest.value.leaves(_matrix(batch.column("vector"), width))
        offsets = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], ["id", "vector", "leaves"])


def _search(forest, sizes: np.ndarray, budget: float, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = forest.value.search(_matrix(batch.column("vector"), width), sizes, budget)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(found, pa.list_(pa.int32()))], ["id", "vector", "leaves"])


def _cell(width: int, k: int, items: pa.Table, queries: pa.Table) -> pa.Table:
    """Each query's best rows of a cell, of the leaves it chose."""
    left, right, scores = [], [], []
    if items.num_rows and queries.num_rows:
        ids, vectors, leaf = items.column("id").to_numpy(), _matrix(items.column("vector"), width), items.column("leaf").to_numpy()
        known, leaf = np.unique(leaf, return_inverse=True)
        reach = float(np.linalg.norm(vectors, axis=1).max())
        of, asked = queries.column("id").to_numpy(), _matrix(queries.column("vector"), width)
        wanted = queries.column("chosen").combine_chunks()
        chosen = wanted.flatten().to_numpy()
        row = np.repeat(np.arange(len(of)), np.diff(wanted.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(known, chosen), len(known) - 1)
        here = known[at] == chosen
        probed = np.zeros((len(of), len(known)), bool)
        probed[row[here], at[here]] = True
        for a in range(0, len(of), _AT_ONCE):
            near = np.where(probed[a : a + _AT_ONCE][:, leaf], asked[a : a + _AT_ONCE] @ vectors.T, -np.inf)
            take = min(k, near.shape[1])
            # all that tie with the last one, or miss it by rounding; exact scores and ids decide
            last = -np.partition(-near, take - 1, axis=1)[:, take - 1 : take]
            slack = 1e-12 * reach * np.linalg.norm(asked[a : a + _AT_ONCE], axis=1)[:, None]
            q, i = np.nonzero((near >= last - slack) & (near > -np.inf))
            q += a
            exact = np.concatenate([(asked[q[j : j + 65_536]] * vectors[i[j : j + 65_536]]).sum(axis=1) for j in range(0, len(q), 65_536)] or [np.zeros(0)])
            order = np.lexsort((ids[i], -exact, q))
            q, i, exact = q[order], i[order], exact[order]
            best = np.arange(len(q)) - np.searchsorted(q, q) < k
            left.append(of[q[best]])
            right.append(ids[i[best]])
            scores.append(exact[best])
    cat = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
    return pa.table({"q": cat(left, pa.int64()), "c": cat(right, pa.int64()), "score": cat(scores, pa.float64())})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, effort: float = EFFORT, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` (vec_id), its k nearest rows of `vectors`
    (vec_id, embedding) by inner product, without itself; ties go to the smaller vec_id."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where("vec_id IS NOT NULL AND size(vector) > 0")
    rows = rows.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0))
    widths = sorted(r["w"] for r in rows.select(F.size("vector").alias("w")).distinct().collect())  # one number a length
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for width in widths:
        out = out.unionByName(_nearest(rows, queries, width, k, trees, effort, sample, cell_rows))
    return out


def _nearest(rows: DataFrame, queries: DataFrame, width: int, k: int, trees: int, effort: float, sample: int, cell_rows: int) -> DataFrame:
    """`nearest` among the rows (vec_id, vector) of one length."""
    spark = rows.sparkSession
    # -0.0 and 0.0 are the same number, and so the same vector
    rows = rows.where(F.size("vector") == width).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).distinct()
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = cut(few.groupBy("vector").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-classes")
    n, top = classes.agg(F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()
    fit = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    forest = spark.sparkContext.broadcast(Forest(np.array([r[0] for r in fit], np.float64), top, trees))
    placed = classes.select("id", "vector").mapInArrow(lambda b: _leaves(forest, width, b), "id long, vector array<double>, leaves array<int>")
    placed = cut(placed, "ann-leaves")
    items = placed.select("id", "vector", F.explode("leaves").alias("leaf"))
    sizes = np.zeros(len(forest.value.tree_of))
    for r in items.groupBy("leaf").count().collect():  # a row for each leaf of the bounded forest
        sizes[r["leaf"]] = r["count"]
    # neighbouring leaves of a tree share a cell; a leaf larger than a cell is dealt over several
    cells, cell, held = [], 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if held and (held + size > cell_rows or forest.value.tree_of[leaf] != forest.value.tree_of[leaf - 1]):
            cell, held = cell + 1, 0
        cells.append(cell)
        held += size
    parts = [max(1, -(-int(s) // cell_rows)) for s in sizes.tolist()]
    of_leaf = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate(zip(cells, parts))], "leaf int, cell int, parts int")
    ids = queries.select(F.col("vec_id").cast("long").alias("vec_id")).where("vec_id IS NOT NULL").distinct()
    asked = cut(rows.join(ids, "vec_id").join(classes.select("vector", F.col("id").alias("q")), "vector").select("vec_id", "q"), "ann-queries")
    asking = classes.select("id", "vector").join(asked.select(F.col("q").alias("id")).distinct(), "id", "left_semi")
    asking = asking.mapInArrow(lambda b: _search(forest, sizes, effort * n, width, b), "id long, vector array<double>, leaves array<int>")
    chosen = asking.select("id", "vector", F.explode("leaves").alias("leaf")).join(F.broadcast(of_leaf), "leaf")  # bounded by the forest
    chosen = chosen.groupBy("id", "cell").agg(F.collect_list("leaf").alias("chosen"), F.max("parts").alias("parts"))
    chosen = chosen.join(asking.select("id", "vector"), "id")
    blocks = max(1, -(-asked.select("q").distinct().count() // CELL_QUERIES))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    # each class once per block of queries, each query once per part of a large leaf
    here = items.join(F.broadcast(of_leaf), "leaf").withColumn("part", F.pmod(F.xxhash64(F.lit(7), "id"), F.col("parts")).cast("int"))
    here = here.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    there = chosen.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["cell", "part", "block"]
    theirs = [f"q_{c}" for c in key]
    here, there = here.select(*key, "id", "vector", "leaf"), there.select(*[F.col(a).alias(b) for a, b in zip(key, theirs)], "id", "vector", "chosen")
    found = here.groupBy(*key).cogroup(there.groupBy(*theirs)).applyInArrow(lambda a, b: _cell(width, k + 1, a, b), "q long, c long, score double")
    found = found.distinct()
    best = found.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))).where(F.col("nth") <= k + 1)
    best = best.join(classes.select(F.col("id").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    best = best.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= k + 1)
    lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("list"))
    own = asked.join(lists, "q").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("list"))
    out = own.select("query_id", F.posexplode("list").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def report(vectors: DataFrame) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20."""
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
