"""Hand-written source rows for golden micro-cases."""

from __future__ import annotations

import datetime as dt

D = dt.date

SNAPSHOT_SCHEMA = (
    "dt date, as_of date, sub_acct_no_sbb long, home_phone_sbb long, bus_phone_sbb long, delinquency_days int, "
    "connect_dte_sbb timestamp, video_chrg double, hsd_chrg double, voice_chrg double, drop_type string, "
    "hsd int, video int, voice int, joint_customer string, welcome_offer string, bill_code string, "
    "play_type string, cust_typ_sbb string, acp string, bill_from_dte_sbb date")


def snap_row(day, acct, overdue=10, connect=D(1997, 1, 1), mrc=30.0, hsd=1, video=0, voice=0, phone1=None,
             phone2=None, play="1P", cust="RES", acp="N", bill_code="B5", drop="COAX"):
    ts = dt.datetime(connect.year, connect.month, connect.day) if connect else None
    return (day, day, acct, phone1, phone2, overdue, ts, 0.0, mrc, 0.0, drop, hsd, video, voice, "N", "N",
            bill_code, play, cust, acp, day.replace(day=1))


def days(start, end):
    d = start
    while d <= end:
        yield d
        d += dt.timedelta(days=1)


ORDERS_SCHEMA = ("account_id long, dt date, completed_date date, order_start_date date, cease_reason_code string, "
                 "cease_reason_desc string, order_type string, account_type string, order_status string, "
                 "lob_vo_count int, lob_bb_count int, lob_tv_count int")


class ListSources:
    """A ``Sources`` bundle over literal rows."""

    def __init__(self, spark, snapshot=(), orders=()):
        self.spark = spark
        self._snap = spark.createDataFrame(list(snapshot), SNAPSHOT_SCHEMA)
        self._orders = spark.createDataFrame(list(orders), ORDERS_SCHEMA)

    def daily_snapshot(self):
        return self._snap

    def service_orders(self):
        return self._orders
