"""Benchmark: the monthly chain (fixed, mobile, converged, sales drivers,
involuntary funnel) on the fixture views of $BENCH_SF_DIR, local[$BENCH_CPUS].

Each stage is written as a month-partitioned stage table (the production
flow) and timed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnwise.params import RunParams  # noqa: E402
from churnwise.plans.monthly import MonthlyRun  # noqa: E402
from churnwise.session import get_session, stage_root  # noqa: E402
from churnwise.sources.fixtures import FIXTURE_MONTH, FixtureSources  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # the session's shared spark.checkpoint.dir is used when configured; only
    # when it is unset (a local run) does get_session create a scratch folder
    spark = get_session(master=f"local[{cpus}]")
    p = RunParams(FIXTURE_MONTH)
    src = FixtureSources(spark, sf_dir)
    t0 = time.time()
    src.build_all()  # derive the source tables once (the production tables already exist)
    build = time.time() - t0
    t0 = time.time()
    run = MonthlyRun(spark, src, p, stage_root(spark) + "/bench-" + uuid.uuid4().hex[:8])
    run.run()
    total = time.time() - t0
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "monthly_chain_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": run.timings, "fixture_build_sec": round(build, 3), "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
