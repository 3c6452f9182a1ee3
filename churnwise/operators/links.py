"""Best-link matching between two entity sets (OP-13).

Candidate links come from equi-joins on several key columns (a fixed account
carries two contact phones; each may equal a mobile subscriber id). A pair
is kept when its right key is the best one of its left entity, and when one
of its candidate rows is among the first ``top_right`` of its right entity.

The ranking counts candidate *rows*: an entity that holds several rows, or
matches on several columns, takes several places, and pushes later entities
further back. Which of the equal rows of one pair comes first is left open;
a pair is kept if any of them is within the first ``top_right``.

The best right key per left entity is an aggregation; the ranking is a
``row_number() <= k`` filter, which Catalyst plans as a ``WindowGroupLimit``:
a partial top-k runs *before* the shuffle, so an entity linked to a huge
number of candidates ships only k rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def candidate_links(left: DataFrame, left_key: str, left_cols: list[str],
                    right: DataFrame, right_key: str) -> DataFrame:
    """(left_key, right_key, src) for every row pair whose left column equals
    the right key; ``src`` is the 1-based position of that column."""
    # every non-NULL phone of a left row as a row: one join for all columns
    phones = F.filter(F.array(*[F.struct(F.col(c).alias("_r"), F.lit(i).alias("src"))
                                for i, c in enumerate(left_cols, start=1)]), lambda x: x["_r"].isNotNull())
    lk = left.select(F.col(left_key).alias("_l"), F.inline(phones))
    rk = right.select(F.col(right_key).alias("_r")).where(F.col("_r").isNotNull())
    return lk.join(rk, "_r").select(F.col("_l").alias(left_key), F.col("_r").alias(right_key), "src")


def best_links(links: DataFrame, left_key: str, right_key: str, top_right: int = 2) -> DataFrame:
    """The kept (left_key, right_key, src) pairs, ``src`` being the lowest of
    the pair: the highest right key of each left entity, if a row of the pair
    is within the first ``top_right`` of the right entity (highest left key
    first)."""
    best = links.groupBy(left_key).agg(F.max(right_key).alias(right_key))
    by_right = Window.partitionBy(right_key).orderBy(F.col(left_key).desc(), F.col("src").asc())
    first = (links.withColumn("_rn", F.row_number().over(by_right)).where(F.col("_rn") <= top_right)
             .groupBy(left_key, right_key).agg(F.min("src").alias("src")))
    return first.join(best, [left_key, right_key], "left_semi")
