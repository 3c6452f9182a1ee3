"""Connected components of a link table, by alternating star contractions.

Each step replaces every node's links by links to the smallest neighbour: first those to larger nodes (large
star), then those to smaller ones (small star). Links keep connecting the same nodes while paths halve, so the
number of steps is logarithmic; the end is one link from each node to the smallest node of its component.
All steps are aggregations with partial sums and equi-joins; nothing is collected but two numbers a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b) that isn't the smallest of its component."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
