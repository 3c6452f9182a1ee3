"""Band joins: a key and a range of days (J-29, J-31).

``k = k AND at BETWEEN lo AND hi`` planned on the key alone sends all rows of a
key to one task, and tests each of its points against each of its bands.
``band_join`` cuts time into bins of ``width`` days and joins on (key, bin): a
point lies in one bin, a band is repeated once for each bin it touches, so a pair
meets exactly once and a key with a third of all points is spread over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_join(points: DataFrame, bands: DataFrame, key: str, at: str, lo: Column, hi: Column, width: int = 30) -> DataFrame:
    """Inner join of ``points`` and ``bands`` on ``key`` where the date ``at`` of
    the point lies between ``lo`` and ``hi`` (both included), expressions over
    ``bands``.

    The sides share no column but ``key``. Repeated rows pair as in SQL; a NULL
    key or date, and a band that ends before it begins, pair with nothing. A
    band costs one row a bin: take a ``width`` near the usual length."""
    if width < 1:
        raise ValueError("width: at least one day")
    bin_of = lambda day: F.floor(F.unix_date(day) / F.lit(width))
    left = points.withColumn("_bin", bin_of(F.col(at)))
    right = bands.withColumns({"_lo": lo, "_hi": hi}).where(F.col("_lo") <= F.col("_hi"))
    right = right.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_lo")), bin_of(F.col("_hi")))))
    return left.join(right, [key, "_bin"]).where(F.col(at).between(F.col("_lo"), F.col("_hi"))).drop("_bin", "_lo", "_hi")
