"""Mergeable exact distinct counts (AGG-8 .. AGG-10, OP-20).

``distinct_flag_rollup`` counts once; totals over fewer dimensions, or over
several months, need another pass, since distinct counts do not add up. Here the
distinct ids of each group are kept as bitmaps, 32,768 ids a bucket and 4 KB a
bitmap, which merge by OR: any total is a merge of what is kept, and the rows are
read once. A group holds as many rows as its ids touch buckets, so no value grows
with the data, and bitmaps are built before the shuffle, so a hot group costs one
row a bucket and map task.

Ids are integers. Dense ids pay; ids spread over a wide range touch a bucket each
and are better counted by ``distinct_flag_rollup``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"


def id_bitmaps(df: DataFrame, dims: list[str], id_col: str, flags: Mapping[str, Column]) -> DataFrame:
    """(dims, bucket, one bitmap a flag): the ids for which each boolean flag
    holds on some row. NULL flags and NULL ids count for nothing."""
    kind = df.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{id_col}: ids of bitmaps are integers, not {kind}")
    number = F.col(id_col).cast("long")
    # one row an id first, so that the bitmaps, which no hash aggregation can hold, are built of few rows
    per_id = df.where(F.col(id_col).isNotNull()).groupBy(*dims, number.alias("_id")).agg(
        *[F.max(F.when(flag, 1)).alias(name) for name, flag in flags.items()])
    position = F.bitmap_bit_position("_id")
    return per_id.groupBy(*dims, F.bitmap_bucket_number("_id").alias(BUCKET)).agg(
        *[F.bitmap_construct_agg(F.when(F.col(name) == 1, position)).alias(name) for name in flags])


def merge(bitmaps: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
    """The bitmaps of fewer ``dims``; also those of several tables, unioned."""
    return bitmaps.groupBy(*dims, BUCKET).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def counts(bitmaps: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
    """Per ``dims``, the number of distinct ids of each bitmap; without dims one
    row, with zeros if there is none."""
    merged = merge(bitmaps, dims, names)
    return merged.groupBy(*dims).agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).cast("long").alias(n) for n in names])


def totals(bitmaps: DataFrame, dims: list[str], sets: list[list[str]], names: list[str]) -> DataFrame:
    """``counts`` of several subsets of ``dims``, one below the other: a column
    left out is NULL, and ``dims_used`` names the others."""
    out = None
    for used in sets:
        part = counts(bitmaps, used, names)
        kinds = {d: bitmaps.schema[d].dataType for d in dims}
        part = part.select(*[F.col(d) if d in used else F.lit(None).cast(kinds[d]).alias(d) for d in dims],
                           F.lit(",".join(used)).alias("dims_used"), *names)
        out = part if out is None else out.unionByName(part)
    return out
