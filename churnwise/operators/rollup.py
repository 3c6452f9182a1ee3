"""Many ``count(DISTINCT flag)`` per group, as two ordinary aggregations.

Spark plans several distinct aggregates with an ``Expand`` that copies every
input row once per distinct aggregate. The reports here count, per group,
the distinct ids for which a flag is set, where each flag is either NULL or
the row's id. That is exactly: collapse to one row per (group, id) keeping
"flag ever set", then sum per group. Both steps aggregate partially before
their shuffle, so a hot group costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_flag_rollup(df: DataFrame, dims: list[str], id_col: str,
                         flags: Mapping[str, Column]) -> DataFrame:
    """Per ``dims``: for each named flag, the number of distinct non-NULL
    values. Requirement: every flag is NULL or equal to ``id_col``."""
    names = list(flags)
    per_id = df.groupBy(*dims, id_col).agg(
        *[F.max(F.when(expr.isNotNull(), 1).otherwise(0)).alias(n) for n, expr in flags.items()])
    # without dims there is one row even for no input, and a count of nothing is 0
    return per_id.groupBy(*dims).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
