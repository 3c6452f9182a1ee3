"""Production sources: the operator's tables, read by path or catalog name,
with types normalised once at ingest (dates stored as text become dates,
identifiers become longs, amounts stored as text become doubles), so the
plans never cast inside joins or filters.

    src = TableSources(spark, {"daily_snapshot": "/data/daily_snapshot",
                               "service_orders": "sales.service_orders", ...})

A location containing ``://`` or ``/`` is read as parquet; anything else is
a table name (``spark.table``). The daily and monthly snapshots are expected
to be partitioned by ``dt`` so that the month filters prune partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# column -> Spark type, per source (only columns whose stored type may differ)
NORMALISE = {
    "daily_snapshot": {"dt": "date", "as_of": "date", "sub_acct_no_sbb": "long", "home_phone_sbb": "long",
                       "bus_phone_sbb": "long", "delinquency_days": "int", "connect_dte_sbb": "timestamp",
                       "video_chrg": "double", "hsd_chrg": "double", "voice_chrg": "double", "hsd": "int",
                       "video": "int", "voice": "int", "bill_from_dte_sbb": "date"},
    "service_orders": {"account_id": "long", "dt": "date", "completed_date": "date", "order_start_date": "date",
                       "lob_vo_count": "int", "lob_bb_count": "int", "lob_tv_count": "int"},
    "postpaid_master": {"dt": "date", "subsrptn_id": "long", "cust_id": "long", "subsrptn_actvtn_dt": "date",
                        "flg_susp_curr_mo": "int"},
    "postpaid_cancellations": {"dt": "date", "subsrptn_id": "long"},
    "postpaid_mrc": {"dt": "date", "acct_nbr": "long", "mrc/account": "double"},
    "prepaid_master": {"dt": "date", "subsrptn_id": "long"},
    "fmc_bill_codes": {},
    "interactions": {"account_id": "long", "customer_id": "long", "interaction_start_time": "timestamp"},
    "truckrolls": {"create_dte_ojb": "timestamp", "sub_acct_no_sbb": "long"},
    "payments": {"account_id": "long", "dt": "date", "payment_amt_usd": "double"},
    "order_lines": {"account_id": "long", "order_start_date": "timestamp", "completed_date": "timestamp"},
}


#: Columns in which blank text means no value (the source drops such rows).
#: Any other malformed text still raises an error.
BLANK_IS_NULL = {"interactions": {"interaction_start_time"}}


def _normalise(df: DataFrame, types: dict, blank: set = frozenset()) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in blank and df.schema[c].dataType.simpleString() == "string":
            df = df.withColumn(c, F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")))
        t = types.get(c)
        if t is None or df.schema[c].dataType.simpleString() == t.replace("long", "bigint"):
            cols.append(F.col(f"`{c}`"))
        elif t == "date":
            # text such as '2023-05-01 00:00:00.000' or a timestamp -> date
            cols.append(F.to_date(F.substring(F.col(f"`{c}`").cast("string"), 1, 10)).alias(c))
        else:
            cols.append(F.col(f"`{c}`").cast(t).alias(c))
    return df.select(cols)


class TableSources:
    def __init__(self, spark: SparkSession, locations: dict[str, str]):
        self.spark, self.locations = spark, dict(locations)

    def _read(self, name: str) -> DataFrame:
        loc = self.locations[name]
        df = self.spark.read.parquet(loc) if ("/" in loc or "://" in loc) else self.spark.table(loc)
        return _normalise(df, NORMALISE[name], BLANK_IS_NULL.get(name, set()))

    def daily_snapshot(self): return self._read("daily_snapshot")
    def service_orders(self): return self._read("service_orders")
    def postpaid_master(self): return self._read("postpaid_master")
    def postpaid_cancellations(self): return self._read("postpaid_cancellations")
    def postpaid_mrc(self): return self._read("postpaid_mrc")
    def prepaid_master(self): return self._read("prepaid_master")
    def fmc_bill_codes(self): return self._read("fmc_bill_codes")
    def interactions(self): return self._read("interactions")
    def truckrolls(self): return self._read("truckrolls")
    def payments(self): return self._read("payments")
    def order_lines(self): return self._read("order_lines")
