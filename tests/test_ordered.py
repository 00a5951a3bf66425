"""Bucketed scans must equal plain windows, hot keys and empty buckets included."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators import ordered
from tarmac.operators.joins import asof_join


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    t0, out = datetime(2026, 1, 1), []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rnd.choice("abcdefg")
        # Bursts and long silences, so that some buckets are empty.
        at = t0 + timedelta(hours=rnd.choice([0, 1, 2, 30, 31, 90]), seconds=rnd.randrange(3600))
        out.append((i, key, at, rnd.choice([None, 1.0, 2.0, 5.0]), rnd.randrange(3)))
    return spark.createDataFrame(out, "id int, k string, ts timestamp, v double, state int")


def plain(keys=("k",)):
    return Window.partitionBy(*keys).orderBy("ts", "id")


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("width", [600, 7200, 86400 * 30])
def test_previous(rows, width):
    got = ordered.with_previous(rows, ["k"], ["ts", "id"], ["ts", "v"], bucket=ordered.time_bucket("ts", width))
    want = rows.withColumn("prev", F.lag(F.struct("ts", "v")).over(plain()))
    same(got.select("id", "prev"), want.select("id", "prev"))


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_last(rows, inclusive):
    got = ordered.running_last(
        rows, ["k"], ["ts", "id"], {"last_v": F.col("v")}, bucket=ordered.time_bucket("ts", 900), inclusive=inclusive
    )
    frame = plain().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = rows.withColumn("last_v", F.last("v", True).over(frame))
    same(got.select("id", "last_v"), want.select("id", "last_v"))


def test_running_sum(rows):
    got = ordered.running_sum(rows, ["k"], ["ts", "id"], {"s": F.col("state")}, bucket=ordered.time_bucket("ts", 900))
    want = rows.withColumn("s", F.sum("state").over(plain().rowsBetween(Window.unboundedPreceding, 0)))
    same(got.select("id", "s"), want.select("id", "s"))


def test_running_sum_without_keys(rows):
    got = ordered.running_sum(rows, [], ["ts", "id"], {"s": F.col("state")}, bucket=ordered.time_bucket("ts", 900))
    want = rows.withColumn("s", F.sum("state").over(plain(keys=()).rowsBetween(Window.unboundedPreceding, 0)))
    same(got.select("id", "s"), want.select("id", "s"))


@pytest.mark.parametrize("width", [300, 3600, 86400 * 30])
def test_islands(rows, width):
    def breaks(p, c):
        return (p["state"] != c["state"]) | ((F.unix_seconds(c["ts"]) - F.unix_seconds(p["ts"])) > 120)

    got = ordered.islands(
        rows, ["k"], ["ts", "id"], breaks, bucket=ordered.time_bucket("ts", width), carry=["state"], name="i"
    )
    prev = F.lag(F.struct("ts", "state")).over(plain())
    fresh = rows.withColumn("p", prev).withColumn("c", F.struct("ts", "state"))
    fresh = fresh.withColumn("f", F.when(F.col("p").isNull() | breaks(F.col("p"), F.col("c")), F.struct("ts", "id")))
    want = fresh.withColumn("i", F.last("f", True).over(plain().rowsBetween(Window.unboundedPreceding, 0)))
    same(got.select("id", "i"), want.select("id", "i"))


def test_gap_at_the_limit_stays(spark):
    t0 = datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", t0), ("a", t0 + timedelta(minutes=15)), ("a", t0 + timedelta(minutes=30, seconds=1))], "k string, ts timestamp")
    got = ordered.islands(df, ["k"], ["ts"], ordered.gap_breaks("ts", 900), bucket=ordered.time_bucket("ts", 600), name="i")
    assert got.select("i").distinct().count() == 2


def test_a_hot_key_is_spread(rows):
    """No (key, bucket) group may hold more than a bucket of the hot key."""
    groups = ordered.with_halo(rows, "ts", width_s=600, lookback_s=60).groupBy("k", ordered.BUCKET).count()
    assert groups.filter("k = 'hot'").count() >= 20
    assert groups.filter("k = 'hot'").agg(F.max("count")).first()[0] < rows.filter("k = 'hot'").count() / 4


@pytest.mark.parametrize("tolerance", [None, 60, 3600, 86400])
def test_asof(spark, rows, tolerance):
    left = rows.filter("id % 2 = 0").select("id", F.when(F.col("id") % 50 > 0, F.col("k")).alias("k"), "ts")
    right = rows.filter("id % 2 = 1").select(F.col("id").alias("rid"), "k", F.col("ts").alias("rts"))
    got = asof_join(left, right, ["k"], "ts", "rts", tolerance_s=tolerance, right_tie=["rid"], bucket_s=1800)
    ok = F.col("rts") <= F.col("ts")
    if tolerance is not None:
        ok = ok & (F.unix_micros("ts") - F.unix_micros("rts") <= tolerance * 1_000_000)
    best = (
        left.join(right, "k").filter(ok).groupBy("id").agg(F.max(F.struct("rts", "rid")).alias("b"))
        .select("id", "b.rid", "b.rts")
    )
    want = left.join(best, "id", "left")
    same(got.select("id", "rid", "rts"), want.select("id", "rid", "rts"))
