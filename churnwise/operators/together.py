"""Independent steps at once.

A step that writes an intermediate keeps only as many cores busy as its current
stage has tasks, and few at the end of each stage. Steps that read nothing of each
other are therefore started together, each from a thread of its own; Spark deals
the free cores to the tasks of all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """The results of the steps, in their order. Each step runs with the caller's
    job settings (pool, group, tags). If some fail, the first of them is raised
    when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        # the settings are copied when a step is handed over, by the caller's thread
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]
