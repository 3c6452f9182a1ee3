"""Run one or several months of the chain against production tables.

    python -m churnwise --month 2023-05-01 --sources sources.json --stage-root <shared folder>

``sources.json`` maps source names (daily_snapshot, service_orders,
postpaid_master, postpaid_cancellations, postpaid_mrc, prepaid_master,
fmc_bill_codes, interactions, truckrolls, payments, order_lines) to parquet
paths or catalog table names. The session is the cluster's; its
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from pyspark.sql import SparkSession

from churnwise.params import RunParams
from churnwise.plans.monthly import MonthlyRun
from churnwise.session import BASE_CONF, ensure_checkpoint_dir, stage_root
from churnwise.sources.catalog import TableSources


#: Every run parameter but the month can be set.
OPTIONS = [f for f in dataclasses.fields(RunParams) if f.name not in ("month", "extra")]


def _reader(f: dataclasses.Field):
    if f.name == "payment_windows":
        return lambda text: tuple(int(x) for x in text.split(","))
    if isinstance(f.default, bool):
        return lambda text: {"true": True, "false": False}[text.lower()]
    if isinstance(f.default, dt.date):
        return dt.date.fromisoformat
    return type(f.default) if f.default is not None else str


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="churnwise")
    ap.add_argument("--month", required=True, help="a day of the month, or of several months with commas between")
    ap.add_argument("--sources", required=True, help="JSON file: source name -> path or table")
    ap.add_argument("--stage-root", default=None, help="shared folder for stage tables")
    ap.add_argument("--create-if-absent", action="store_true", help="leave existing stage tables as they are")
    ap.add_argument("--catalog", default=None, help="database in which the stage tables are published")
    for f in OPTIONS:
        ap.add_argument("--" + f.name.replace("_", "-"), type=_reader(f), default=argparse.SUPPRESS,
                        required=f.name == "install_org", help=f"default: {f.default}")
    args = ap.parse_args(argv)
    options = {f.name: getattr(args, f.name) for f in OPTIONS if hasattr(args, f.name)}
    builder = SparkSession.builder.appName(f"churnwise-{args.month}")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    with open(args.sources) as fh:
        locations = json.load(fh)
    months = args.month.split(",")
    run = MonthlyRun(spark, TableSources(spark, locations), RunParams(months[0], **options),
                     args.stage_root or stage_root(spark), args.create_if_absent, args.catalog)
    if len(months) == 1:
        run.run()
    else:
        run.run_months(months)
    print(json.dumps({"month": args.month, "seconds": run.timings}))


if __name__ == "__main__":
    main()
