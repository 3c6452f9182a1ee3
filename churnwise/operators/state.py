"""Kept state: what a report needs of a long history, folded day by day.

A ``KeptState`` names, for each key, values on the first and on the last day
of its rows. Two states merge into the state of all their rows, and folding a
day that is in the state already changes nothing, so a late or repeated
delivery is harmless. ``advance`` brings a stored state up to a date by
reading the newest one before it and the days since, never the history again.

First and last values are chosen by (day, value), so that equal days have one
result whatever the order of folding: the least value of the first day, the
greatest of the last. The rows are reduced to one for each key and day before
``min_by`` / ``max_by`` pick the days, both ends in the same two hash
aggregates (where the values have a fixed width), so a fold reads its rows
once.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwise import sinks

AS_OF = "as_of"
_DAY = "_day"


@dataclass(frozen=True)
class KeptState:
    """``first`` / ``last``: state column -> column of the rows, by ``order``
    (a date). The state also holds ``first_<order>`` and ``last_<order>``."""

    keys: tuple[str, ...]
    order: str
    first: dict[str, str] = field(default_factory=dict)
    last: dict[str, str] = field(default_factory=dict)

    @property
    def ends(self) -> tuple[str, str]:
        return f"first_{self.order}", f"last_{self.order}"

    def collapse(self, rows: DataFrame) -> DataFrame:
        """The state of ``rows`` (rows without a day take no part)."""
        values = {**self.first, **self.last}
        return self._fold(rows.where(F.col(self.order).isNotNull()).select(
            *self.keys, F.col(self.order).alias(_DAY), *[F.col(c).alias(name) for name, c in values.items()]))

    def merge(self, *states: DataFrame) -> DataFrame:
        """The state of the rows of all ``states`` together."""
        columns = [*self.keys, *self.ends, *self.first, *self.last]
        together = states[0].select(*columns)
        for more in states[1:]:
            together = together.unionByName(more.select(*columns))
        # the two ends of a state as two rows, each with the values of its own end: the
        # least day of a key begins a state and the greatest ends one
        kinds = {f.name: f.dataType for f in together.schema}
        end = lambda day, own: F.struct(F.col(day).alias(_DAY), *[
            (F.col(c) if c in own else F.lit(None).cast(kinds[c])).alias(c) for c in (*self.first, *self.last)])
        lo, hi = self.ends
        return self._fold(together.select(*self.keys, F.inline(F.array(end(lo, self.first), end(hi, self.last)))))

    def _fold(self, days: DataFrame) -> DataFrame:
        """One pass over ``days``, which hold the keys, a day and the values of its rows."""
        lo, hi = self.ends
        values = [F.min(c).alias(c) for c in self.first] + [F.max(c).alias(c) for c in self.last]
        per_day = days.groupBy(*self.keys, _DAY).agg(*values) if values else days.select(*self.keys, _DAY).distinct()
        return per_day.groupBy(*self.keys).agg(
            F.min(_DAY).alias(lo), F.max(_DAY).alias(hi),
            *[F.min_by(c, _DAY).alias(c) for c in self.first], *[F.max_by(c, _DAY).alias(c) for c in self.last])

    def newest(self, spark: SparkSession, root: str, before: _dt.date) -> _dt.date | None:
        """The last date before ``before`` that a state is kept for."""
        try:
            kept = spark.read.parquet(root)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return kept.where(F.col(AS_OF) < F.lit(before)).agg(F.max(AS_OF)).first()[0]

    def read(self, spark: SparkSession, root: str, as_of: _dt.date) -> DataFrame:
        return sinks.read_month(spark, root, AS_OF, as_of).drop(AS_OF)

    def advance(self, rows: DataFrame, root: str, upto: _dt.date, late: DataFrame | None = None) -> DataFrame:
        """The state of all rows up to ``upto``, written under ``root`` as one
        partition (it appears when it is whole, and a rerun replaces it).
        ``late`` rows are folded whatever their day."""
        spark = rows.sparkSession
        since = self.newest(spark, root, upto)
        days = rows.where(F.col(self.order) <= F.lit(upto))
        if since is not None:
            days = days.where(F.col(self.order) > F.lit(since))
        parts = [self.collapse(days)]
        if since is not None:
            parts.append(self.read(spark, root, since))
        if late is not None:
            parts.append(self.collapse(late.where(F.col(self.order) <= F.lit(upto))))
        state = parts[0] if len(parts) == 1 else self.merge(*parts)
        sinks.write_month(state.withColumn(AS_OF, F.lit(upto)), root, AS_OF)
        return self.read(spark, root, upto)
