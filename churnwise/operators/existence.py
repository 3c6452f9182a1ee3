"""Set-membership operators: ``x IN (subquery)`` as a filter or as a flag.

``IN`` / ``NOT IN`` over a key set are written as semi/anti joins or as a
left join to the *distinct* key set, so Catalyst plans an ordinary hash or
sort-merge join (AQE may broadcast the set when its measured size is small)
instead of a null-aware nested loop. SQL's three values need no more than two
bits beside that join, whether the set has rows and whether one is NULL:
``presence`` reads them as one scalar subquery, which Spark runs once, before
the join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presence(keys: DataFrame, key: str) -> Column:
    """A scalar subquery: struct(rows, nulls), whether ``keys`` has rows, and
    whether one of them is NULL in ``key``."""
    bits = keys.agg(F.struct((F.count(F.lit(1)) > 0).alias("rows"), (F.count(F.when(F.col(key).isNull(), 1)) > 0).alias("nulls")))
    return bits.scalar()


def not_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``WHERE key NOT IN (subquery)`` in three-valued logic: no row if the set
    holds a NULL, all rows if it is empty; else a NULL key is dropped and the
    others stay that are not in the set."""
    there = presence(keys, key)
    kept = df.join(keys.select(key), key, "left_anti")
    return kept.where(~there["nulls"] & (F.col(key).isNotNull() | ~there["rows"]))


def with_in(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name`` = ``key IN (subquery)``, TRUE, FALSE or NULL; its negation
    is ``NOT IN`` as a projected boolean."""
    there = presence(keys, key)
    marked = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_in", F.lit(True))
    unknown = there["nulls"] | (F.col(key).isNull() & there["rows"])
    flag = F.when(F.col("_in"), True).when(~unknown, False)
    return df.join(marked, key, "left").select(*df.columns, flag.alias(name))


def with_memberships(df: DataFrame, sets: dict, key: str | list[str],
                     tagged: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """Add one boolean per named key set (``name`` = df.key IN set), never
    NULL, with a single join: the sets are tagged, unioned and collapsed to
    one row per key (of one or more columns) first (partial aggregation removes
    duplicates before the shuffle). ``tagged`` adds rows (key, _set) of several sets at once, and
    the names of those sets."""
    rows, more = tagged or (None, [])
    keys = [key] if isinstance(key, str) else list(key)
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    parts = [ks.select(*keys).where(known).withColumn("_set", F.lit(name)) for name, ks in sets.items()]
    if rows is not None:
        parts.append(rows.where(known).select(*keys, "_set"))
    names = [*sets, *more]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    flags = together.groupBy(*keys).agg(*[F.max(F.col("_set") == name).alias(name) for name in names])
    out = df.join(flags, keys, "left")
    return out.select(*[F.coalesce(F.col(c), F.lit(False)).alias(c) if c in names else F.col(c)
                        for c in out.columns])


def left_join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a right side that may hold
    many rows per key (a fan-out join).

    AQE can split a skewed partition only on the preserved side of an outer
    join, so a hot key on the right would land in one task. Equal right rows
    are therefore counted first (partial aggregation, before the shuffle),
    joined once, and dealt out again after the join, where the rows of a hot
    key are spread over the left side's partitions. Each side is read once.
    """
    columns = [f for f in right.columns if f != key]
    counted = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_times"))
    out = left.join(counted, key, "left")
    times = F.sequence(F.lit(1), F.coalesce(F.col("_times"), F.lit(1)).cast("int"))
    return out.withColumn("_copy", F.explode(times)).select(*left.columns, *columns)
