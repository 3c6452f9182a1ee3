"""Band joins, bitmaps and label dictionaries against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.operators import bitmaps
from churnwise.operators.bands import band_join
from churnwise.operators.dictionary import label_texts

D0 = dt.date(1998, 1, 1)


def _day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


@pytest.mark.parametrize("width", [1, 7, 30])
def test_band_join_equals_all_pairs(spark, width):
    rng = random.Random(width)
    at = lambda: rng.choice([None, *range(-40, 120)])
    points = [(rng.choice([None, 7, 7, 7, *range(20)]), _day(at()), k) for k in range(400)]
    bands = [(rng.choice([None, 7, *range(20)]), _day(at()), _day(at()), k) for k in range(60)]
    got = band_join(spark.createDataFrame(points, "k long, at date, p long"), spark.createDataFrame(bands, "k long, lo date, hi date, b long"),
                    "k", "at", F.col("lo"), F.col("hi"), width)
    assert got.columns == ["k", "at", "p", "lo", "hi", "b"]
    want = [(p, b) for k, a, p in points for j, lo, hi, b in bands if None not in (k, a, lo, hi) and k == j and lo <= a <= hi]
    assert sorted((r.p, r.b) for r in got.collect()) == sorted(want) and len(want) > 20


def test_a_hot_key_is_spread_over_its_bins(spark):
    points = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10_000).alias("k"),
                                      F.date_add(F.lit(D0), (F.col("id") % 365).cast("int")).alias("at"))
    bands = spark.createDataFrame([(7, D0, _day(364))], "k long, lo date, hi date")
    df = band_join(points, bands, "k", "at", F.col("lo"), F.col("hi"))
    assert df.count() == 1000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_bin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    per_bin = points.where("k = 7").groupBy(F.floor(F.unix_date("at") / 30)).count().agg(F.max("count")).first()[0]
    assert per_bin <= 100


def test_bitmaps_equal_sets_and_merge(spark):
    rng = random.Random(3)
    ids = [None, 0, -1, -32768, 32768, 32769, 2**40, *range(50)]
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3]), rng.choice(ids), rng.choice([True, False, None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, m int, id long, f boolean")
    flags = {"every": F.lit(True), "some": F.col("f")}

    def want(key):
        sets = {}
        for g, m, i, f in rows:
            every, some = sets.setdefault(key(g, m), (set(), set()))
            if i is not None:
                every.add(i)
                if f:
                    some.add(i)
        return {k: (len(a), len(b)) for k, (a, b) in sets.items()}

    kept = bitmaps.id_bitmaps(df, ["g", "m"], "id", flags)
    got = {(r.g, r.m): (r.every, r.some) for r in bitmaps.counts(kept, ["g", "m"], list(flags)).collect()}
    assert got == want(lambda g, m: (g, m))
    # two months kept apart merge into one
    apart = bitmaps.id_bitmaps(df.where("m = 1"), ["g", "m"], "id", flags).unionByName(bitmaps.id_bitmaps(df.where("m > 1"), ["g", "m"], "id", flags))
    assert {r.g: (r.every, r.some) for r in bitmaps.counts(apart, ["g"], list(flags)).collect()} == want(lambda g, m: g)
    assert tuple(bitmaps.counts(kept.where("g = 'nobody'"), [], list(flags)).first()) == (0, 0)
    assert tuple(bitmaps.counts(kept, [], list(flags)).first()) == want(lambda g, m: 0)[0]
    with pytest.raises(ValueError):
        bitmaps.id_bitmaps(df, ["m"], "g", flags)


def test_labels_run_once_a_text(spark):
    texts = [None, "", "No Signal today", "billing", "SIGNAL", "billing"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    label = lambda t: C.lower_like_any(t, ["%signal%", "%no%tone%"])
    out = label_texts(df, "t", {"tech": label})
    assert out.columns == ["id", "t", "tech"]
    want = df.withColumn("tech", label("t"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    # the label is an output of the aggregation that makes the texts distinct, and of nothing else
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [line for line in lines if " AS tech" in line]
    assert len(at) == 1 and "Aggregate [_text" in at[0]
