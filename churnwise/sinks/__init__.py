"""Stage-table sinks: month-partitioned parquet tables in a shared folder.

``write_month`` replaces only the partitions of the months present in the
DataFrame (dynamic partition overwrite), so monthly reruns are idempotent
and other months stay untouched. ``create_if_absent`` keeps the
create-table-if-not-exists behaviour (an existing table is left as is).
``read_month`` reads one month back; the month filter prunes partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_month(df: DataFrame, path: str, month_col: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(month_col).parquet(path))


def create_if_absent(df: DataFrame, path: str, month_col: str | None = None) -> None:
    w = df.write.mode("ignore")
    if month_col:
        w = w.partitionBy(month_col)
    w.parquet(path)


def read_month(spark: SparkSession, path: str, month_col: str, month: _dt.date) -> DataFrame:
    return spark.read.parquet(path).where(F.col(month_col) == F.lit(month))
