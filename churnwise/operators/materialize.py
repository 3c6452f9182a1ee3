"""Cutting lineage of shared intermediates.

A relation read by several branches of one plan is written once as a parquet
table under the cluster's shared ``spark.checkpoint.dir`` and read back
(never a machine-local folder, never ``localCheckpoint``). Compared with
``Dataset.checkpoint()`` this is a single pass (an RDD checkpoint of an
unpersisted plan computes it twice: once for the job, once for the
checkpoint write) and the result is columnar, compressed and
column-prunable. Later stages read the files, so a lost executor costs a
re-read, not a recompute of the daily snapshot scan.

``release`` deletes intermediates once nothing reads them any more (the
monthly runner calls it after its stage tables are written).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnwise.session import ensure_checkpoint_dir

_CREATED: list[str] = []


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _CREATED.append(path)
    return spark.read.parquet(path)


def created() -> list[str]:
    return list(_CREATED)


def release(spark: SparkSession, paths: list[str]) -> int:
    """Delete the given intermediate folders (shared file system API);
    returns how many were removed. No-op without a JVM gateway."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return 0
    conf = spark._jsc.hadoopConfiguration()
    removed = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).delete(hp, True):
            removed += 1
        if p in _CREATED:
            _CREATED.remove(p)
    return removed
