"""Stage tables in the catalog, published month by month.

A month is written aside as a table of its own (``saveAsTable``: the catalog
names it only when all its files are there). The stage table's name is a view
over the tables of its months, and publishing replaces the view's definition:
one change in the catalog. Readers see the old month or the new one, whole; a
run killed before the change leaves the old one, and its leftovers go with
the next publication. Every branch of the view states its month, so a filter
on the month column leaves one branch in the plan.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MONTH = "churnwise.month."


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def months(spark: SparkSession, name: str) -> dict[str, str]:
    """Month (ISO) -> the table that holds it, of the published table ``name``."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()  # one row a month
    return {r["key"].removeprefix(_MONTH): r["value"] for r in rows if r["key"].startswith(_MONTH)}


def _sweep(spark: SparkSession, name: str, keep: set[str]) -> None:
    """Drop the month tables of ``name`` that the view does not read."""
    database, _, short = name.rpartition(".")
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    for t in listed:
        full = f"{database}.{t.name}" if database else t.name
        if t.name.startswith(f"{short}__") and full not in keep and t.tableType != "VIEW":
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(full)}")


def publish(df: DataFrame, name: str, month_col: str, month: _dt.date, folder: str | None = None, create_if_absent: bool = False) -> DataFrame:
    """Publish ``df``, the rows of ``month``, as that month of table ``name``,
    and return the month read through the catalog. ``create_if_absent`` leaves
    a table that exists as it is, with all its months. Without a ``folder``
    the catalog's warehouse holds the files."""
    spark = df.sparkSession
    there = months(spark, name)
    if not (create_if_absent and spark.catalog.tableExists(name)):
        aside = f"{name}__{month:%Y%m}_{uuid.uuid4().hex[:12]}"
        # rows of another month would never be read through the view
        own = df.withColumn(month_col, F.when(F.col(month_col) == F.lit(month), F.col(month_col)).otherwise(
            F.raise_error(F.concat(F.lit(f"not a row of {month}: "), F.coalesce(F.col(month_col).cast("string"), F.lit("NULL")))).cast(df.schema[month_col].dataType)))
        writer = own.write.format("parquet")
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{aside}")
        writer.saveAsTable(aside)
        now = there | {month.isoformat(): aside}
        body = " UNION ALL ".join(f"SELECT * FROM {_quoted(t)} WHERE `{month_col}` = DATE '{m}'" for m, t in sorted(now.items()))
        properties = ", ".join(f"'{_MONTH}{m}' = '{t}'" for m, t in sorted(now.items()))
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ({properties}) AS {body}")
        _sweep(spark, name, set(now.values()))
    return spark.table(name).where(F.col(month_col) == F.lit(month))
