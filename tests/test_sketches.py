"""Stored sketches against exact numbers: within the stated error, and exact where they must be."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.operators import evaluate, sketches

T0 = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    day = F.timestamp_seconds(F.lit(1767225600) + (F.col("id") % 20) * 86400)
    return spark.range(60_000).select(
        day.alias("ts"), F.concat(F.lit("a"), F.col("id") % 9000).alias("icao24"), (F.rand(3) * 100).alias("x"), F.when(F.col("id") % 5 > 0, F.randn(4)).alias("y"),
        F.lit(None).cast("double").alias("never"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.0).alias("odd"))


def halves(daily):
    early = F.col("day") < F.lit("2026-01-11").cast("date")
    return daily.filter(early), daily.filter(~early)


def test_drift_is_within_the_stated_error(spark, rows):
    late = F.col("ts") >= F.lit("2026-01-11").cast("timestamp")
    moved = rows.withColumn("x", F.when(late, F.col("x") * 1.5).otherwise(F.col("x")))
    features, k = ["x", "y", "never", "odd"], 1024
    got = {r["feature"]: r for r in sketches.sketch_drift(*halves(sketches.feature_sketches(moved, "ts", features, k))).collect()}
    sound = moved.withColumn("odd", F.nanvl("odd", F.lit(None).cast("double")))
    exact = {r["feature"]: r for r in evaluate.drift(sound.filter(~late), sound.filter(late), features).collect()}
    error = 2 * sketches.rank_error(k)
    for f in ("x", "y", "odd"):
        assert got[f]["null_shift"] == pytest.approx(exact[f]["null_shift"])
        assert exact[f]["ks"] - error - 0.01 <= got[f]["ks"] <= exact[f]["ks"] + error
        assert got[f]["psi"] == pytest.approx(exact[f]["psi"], abs=0.02)
    assert got["never"]["psi"] is None and got["never"]["ks"] is None and got["never"]["null_shift"] == 0
    assert got["x"]["ks"] > 0.3 and got["y"]["ks"] < 0.03
    assert [r["feature"] for r in evaluate.drift_alerts(spark.createDataFrame(list(got.values()))).collect()] == ["x"]


def test_a_day_is_one_row_and_days_unite(rows):
    daily = sketches.feature_sketches(rows, "ts", ["x", "y"], k=200)
    assert daily.count() == 40 and daily.agg(F.max(F.length("sketch"))).first()[0] < 12_000
    one = sketches.united_features(daily).filter("feature = 'x'").select("n_rows", F.kll_sketch_get_rank_double("sketch", F.lit(50.0)).alias("r")).first()
    share = rows.agg(F.avg((F.col("x") <= 50).cast("double"))).first()[0]
    assert one["n_rows"] == 60_000 and abs(one["r"] - share) <= 2 * sketches.rank_error(200)


def test_distinct_keys_over_any_period(rows):
    daily = sketches.subject_sketches(rows, "ts", ["icao24"])
    month = sketches.profile_over(daily, F.date_trunc("month", F.col("day").cast("timestamp")), ["icao24"]).collect()
    assert [(r["days"], r["n_rows"], r["n_icao24"]) for r in month] == [(20, 60_000, 9000)]  # fewer than 2 ** 14: exact
    few = sketches.subject_sketches(rows, "ts", ["icao24"], lg=10)
    n = sketches.profile_over(few, F.lit(1), ["icao24"], lg=10).first()["n_icao24"]
    assert n != 9000 and abs(n - 9000) < 3 * 9000 / 32
    early = F.col("day") < F.lit("2026-01-03").cast("date")
    first = rows.where("ts < '2026-01-03'").select("icao24").distinct()
    second = rows.where("ts >= '2026-01-03'").select("icao24").distinct()
    got = sketches.seen_in_both(daily, early, ~early, "icao24").first()
    assert tuple(got) == (first.count(), second.count(), first.intersect(second).count())


def test_ranges_are_even_wherever_values_crowd(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0.999 + F.col("id") / 2e7).otherwise(F.col("id") / 2e4).alias("p"))
    sized = sketches.with_even_range(hot, "p", "range", ranges=64).groupBy("range").agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).orderBy("range").collect()
    assert len(sized) == 64 and max(r["n"] for r in sized) < 3 * 20_000 / 64
    assert all(a["hi"] < b["lo"] for a, b in zip(sized, sized[1:]))
    one = spark.createDataFrame([(1.0,), (None,)], "p double")
    assert {r["range"] for r in sketches.with_even_range(one, "p", "range").collect()} == {0}
    assert sketches.with_even_range(one.limit(0), "p", "range").count() == 0


def test_the_curve_does_not_depend_on_its_ranges(spark):
    scored = spark.range(5000).select(F.lit("m").alias("model_version"), (0.999 + F.floor(F.col("id") / 3) / 2e6).alias("p_delay"), (F.col("id") % 3 == 0).cast("int").alias("target"))
    a, b = (evaluate.curve(scored, ranges=n).select("p", "seen", "tp").orderBy("p").collect() for n in (2, 256))
    assert a == b and a[0]["seen"] == 5000 and a[-1]["seen"] == 2
