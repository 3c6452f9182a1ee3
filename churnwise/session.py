"""Session construction and cluster-aware scratch locations.

Production jobs receive a session from the cluster; we only *read* its
settings. ``get_session`` is for tests, benchmarks and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package is written for: AQE re-plans joins with
# runtime sizes (broadcast only what is measured small), splits skewed join
# partitions and coalesces tiny shuffle partitions; UTC so dates never shift.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "churnwise", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("CHURNWISE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder that the session names.

    The driver and all executors must be able to read it, so none is made up
    here: without ``spark.checkpoint.dir`` (or a folder set on the context)
    this raises. A local session gets one from ``get_session``."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect, or no folder set yet
            current = None
    if not current:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # a single process: its scratch folder is shared with nobody
        current = tempfile.mkdtemp(prefix="churnwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return current


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables (T1/T2/T3): ``churnwise.stage.dir`` if
    set, else a ``stage`` folder beside the checkpoint folder."""
    configured = spark.conf.get("churnwise.stage.dir", None)
    if configured:
        return configured
    return ensure_checkpoint_dir(spark).rstrip("/") + "/stage"
