"""Kept state: folding days equals a recompute, and reads no history again."""

import datetime as dt
import random

import pytest

from churnwise.operators.state import KeptState

SPEC = KeptState(keys=("k",), order="day", first={"bill": "b"}, last={"over": "o"})
SCHEMA = "k long, day date, b date, o int"
START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def random_rows(rng, n=400):
    some = lambda x: None if rng.random() < 0.2 else x
    return [(some(rng.randrange(12)), day(rng.randrange(90)), some(day(rng.randrange(200))), some(rng.randrange(99))) for _ in range(n)]


def literal(rows):
    out = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        lo, hi = min(r[1] for r in own), max(r[1] for r in own)
        bills = [r[2] for r in own if r[1] == lo and r[2] is not None]
        overs = [r[3] for r in own if r[1] == hi and r[3] is not None]
        out[k] = (lo, hi, min(bills, default=None), max(overs, default=None))
    return out


def state_of(df):
    rows = df.collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: (r["first_day"], r["last_day"], r["bill"], r["over"]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_of_overlapping_parts(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng)
    parts = [[r for r in rows if rng.random() < 0.6] for _ in range(2)]
    parts.append([r for r in rows if r not in parts[0] and r not in parts[1]] + rows[:50])
    states = [SPEC.collapse(spark.createDataFrame(p, SCHEMA)) for p in parts]
    assert state_of(SPEC.merge(*states)) == literal(rows)


def test_advance_equals_recompute(spark, tmp_path):
    rng = random.Random(7)
    rows = random_rows(rng)
    path, root = f"{tmp_path}/rows", f"{tmp_path}/state"
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    for upto in (day(29), day(59), day(89), day(59)):  # a rerun of an earlier date too
        got = state_of(SPEC.advance(table, root, upto))
        assert got == literal([r for r in rows if r[1] <= upto])
    assert state_of(SPEC.read(spark, root, day(89))) == literal(rows)
    # days that come again, and rows that come late
    again = [(3, day(10), day(0), 1), (500, day(5), None, 7)]
    late = spark.createDataFrame(again + rows[:100], SCHEMA)
    assert state_of(SPEC.advance(table, root, day(95), late)) == literal(rows + again)


def test_advance_lists_new_days_only(spark, tmp_path):
    root, path = f"{tmp_path}/state", f"{tmp_path}/rows"
    spark.createDataFrame([(k, day(k), day(k), k) for k in range(60)], SCHEMA).write.partitionBy("day").parquet(path)
    SPEC.advance(spark.read.parquet(path), root, day(49))
    for n in range(30):  # the history is gone; only its state is left
        (tmp_path / "rows" / f"day={day(n)}").rename(tmp_path / f"gone{n}")
    got = state_of(SPEC.advance(spark.read.parquet(path), root, day(59)))
    assert len(got) == 60


def test_new_customers_from_state_equal_those_from_history(spark, tmp_path):
    import os
    if not os.path.exists("/root/testdata/sf0.001"):
        pytest.skip("test data not present")
    from churnwise.catalog import P
    from churnwise.plans import sales
    from churnwise.sources.fixtures import FixtureSources
    snap = FixtureSources(spark, "/root/testdata/sf0.001").daily_snapshot()
    root = f"{tmp_path}/customers"
    sales.CUSTOMER_STATE.advance(sales.customer_days(snap), root, dt.date(1998, 4, 20))
    state = sales.CUSTOMER_STATE.advance(sales.customer_days(snap), root, P.next_month)
    rows, new = sales.new_customer_rows(snap, P, state)
    rows2, new2 = sales.new_customer_rows(snap, P)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(new) == key(new2) and key(rows) == key(rows2) and new.count()
