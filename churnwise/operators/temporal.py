"""Generic time-ordered operators (the reusable forms of the monthly logic).

* ``last_in_month`` (OP-06): per key and calendar month, the latest record's
  values -- ``first_value(x) OVER (PARTITION BY key, month ORDER BY t DESC)``
  as one ``max_by`` aggregation (partial aggregation, hot-key safe).
* ``first_by`` (AGG-13/14): per key, the earliest record's value, and the
  earliest among records satisfying a condition, from one scan.
* ``top_k_per_group`` (FLT-13, SRT-3): ``row_number() <= k``, planned as a
  ``WindowGroupLimit`` (partial top-k before the shuffle).
* ``open_close`` (OP-01): per key, the opening (month M-1) and closing
  (month M) facts side by side with active flags, via a full outer join of
  two one-row-per-key aggregates.

Ties are broken by the ``tie`` columns, so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(ts: str, tie: list[str]) -> Column:
    return F.struct(F.col(ts), *[F.col(t) for t in tie])


def last_in_month(df: DataFrame, key: str, ts: str, values: Mapping[str, str], tie: list[str] = ()) -> DataFrame:
    order = _order(ts, list(tie))
    return df.groupBy(key, F.trunc(F.to_date(ts), "month").alias("month")).agg(
        F.max(F.to_date(ts)).alias("last_date"),
        *[F.max_by(F.col(c), order).alias(name) for name, c in values.items()])


def first_by(df: DataFrame, key: str, ts: str, value: str, tie: str, picks: Mapping[str, Column | None]) -> DataFrame:
    """Per key, for each named condition (None: every row) the first date it
    holds (``<name>_date``) and ``value`` on that date (``<name>_<value>``),
    ties going to the smallest ``tie``.

    Two aggregations of fixed-width values: per (key, date) by ``tie``, then
    per key by date. A struct as the order would make both of them sorts."""
    day = F.to_date(ts)
    per_day, per_key = [], []
    for name, cond in picks.items():
        at = F.col(tie) if cond is None else F.when(cond, F.col(tie))
        per_day += [F.min(at).alias(f"_{name}_any"), F.min_by(F.col(value), at).alias(f"_{name}")]
        when = F.when(F.col(f"_{name}_any").isNotNull(), F.col("_day"))
        per_key += [F.min(when).alias(f"{name}_date"), F.min_by(F.col(f"_{name}"), when).alias(f"{name}_{value}")]
    return df.groupBy(key, day.alias("_day")).agg(*per_day).groupBy(key).agg(*per_key)


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def open_close(df: DataFrame, key: str, ts: str, month: _dt.date, measures: Mapping[str, Column]) -> DataFrame:
    """Opening = month before ``month``, closing = ``month``; ``measures``
    are aggregate expressions evaluated per key in each month."""
    prev = (month.replace(day=1) - _dt.timedelta(days=1)).replace(day=1)
    nxt = (month.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    d = F.to_date(ts)
    rows = df.where((d >= F.lit(prev)) & (d < F.lit(nxt)))

    def side(lo, hi, tag):
        part = rows.where((d >= F.lit(lo)) & (d < F.lit(hi)))
        return part.groupBy(key).agg(F.lit(1).alias(f"{tag}_active"),
                                     *[m.alias(f"{tag}_{n}") for n, m in measures.items()])

    out = side(prev, month, "b").join(side(month, nxt, "e"), key, "full_outer")
    return out.select(key, F.coalesce("b_active", F.lit(0)).alias("b_active"),
                      F.coalesce("e_active", F.lit(0)).alias("e_active"),
                      *[F.col(f"{t}_{n}") for t in ("b", "e") for n in measures])
