"""Places of rows in their group without a task that holds a group.

The rows are dealt out by ranges of (group, order) and a pseudo-random last column, so a group of any size, and
rows that are equal in every column, spread over many tasks. Each range numbers its rows in order; a table of
one row for each pair of range and group then shifts the numbers to places in the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.llm.common import cut

_SALT, _SEAT = "_salt", "_seat"


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str, place: str, total: str) -> tuple[DataFrame, DataFrame]:
    """`df` with `place` (from 0, in its group by `order`) and `total` (rows of the group), and the table of
    groups with `total`. Rows that tie in `order` are placed in any order. `df` is read once and written."""
    keys = [F.col(c).asc_nulls_first() for c in group] + order + [F.col(_SALT).asc()]
    seated = df.withColumn(_SALT, F.rand(13)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # (partition << 33) + row: partitions of a range exchange ascend
    seated = cut(seated.drop(_SALT).withColumn(_SEAT, F.monotonically_increasing_id()), name)
    run = F.shiftright(_SEAT, 33)
    runs = seated.groupBy(*group, run.alias("_run")).agg(F.min(_SEAT).alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut(runs.select(*group, "_run", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias(total)), name + "-runs")
    rows, own = seated.withColumn("_run", run).alias("rows"), runs.alias("own")
    same = F.col("rows._run") == F.col("own._run")
    for c in group:
        same = same & F.col(f"rows.{c}").eqNullSafe(F.col(f"own.{c}"))
    placed = rows.join(own, same).select("rows.*", (F.col(_SEAT) + F.col("_shift")).alias(place), F.col(total)).drop("_run", _SEAT)
    return placed, runs.select(*group, total).distinct()
