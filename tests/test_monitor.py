"""Monitoring, joins with failure modes, evaluation."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.operators import board, dedupe, evaluate, features, joins, learning, monitor, quality
from tarmac.schemas import SCHEMAS

T0 = datetime(2026, 8, 7, 12)


def log(spark, rows):
    """(minutes, attempts, remaining[, ok[, source]]) -> poll log."""
    out = []
    for i, r in enumerate(rows):
        at, attempts, left, ok, source = (*r, *(None, None, None, True, "states")[len(r) :])
        out.append((f"p{i:03}", source, "KJFK", T0 + timedelta(minutes=at), ok, None, attempts, 10, 5, 1, 0.5, left))
    return spark.createDataFrame(out, SCHEMAS["poll_log"])


def used(spark, rows, limit):
    return [r["used"] for r in monitor.credit_ledger(log(spark, rows), limit).orderBy("started_at", "poll_id").collect()]


def test_credits(spark):
    assert used(spark, [(0, 1, None), (1, 4, None)], 100) == [1, 5]
    assert used(spark, [(0, 5, None), (1, 5, 200)], 1000) == [5, 800]  # the server's count wins
    assert used(spark, [(0, 50, None), (1, 1, 8000), (2, 1, None)], 100) == [50, 0, 1]  # clamped above the limit
    assert used(spark, [(0, 10, None), (1, 1, -1)], 100) == [10, 11]  # a negative count is ignored
    assert used(spark, [(0, 2, None), (1, 5, None), (2, 1, None)], 3) == [2, 3, 3]  # refused attempts are free
    assert used(spark, [(0, 10, None), (60 * 12, 1, None)], 10) == [10, 1]  # midnight
    with pytest.raises(ValueError, match="buys no poll"):
        monitor.credit_ledger(log(spark, [(0, 1, None)]), 0)


def test_credit_days(spark):
    days = monitor.credit_days(monitor.credit_ledger(log(spark, [(0, 89, None), (1, 1, None), (2, 10, None), (3, 1, 50)]), 100)).first()
    assert days["first_low"] == T0 + timedelta(minutes=1) and days["first_exhausted"] == T0 + timedelta(minutes=2) and days["peak_used"] == 100


def test_gaps_and_freshness(spark):
    df = log(spark, [(0, 1, None), (1, 1, None), (11, 1, None), (12, 1, None, False)])
    gap = monitor.poll_gaps(df, {"states": 90.0}).collect()
    assert [(g["gap_start"], g["gap_s"]) for g in gap] == [(T0 + timedelta(minutes=1), 600.0)]
    now = F.lit(T0 + timedelta(minutes=27)).cast("timestamp")
    fresh = monitor.freshness(df, now).first()
    assert fresh["state"] == "stalled" and fresh["minutes_since_success"] == 16.0
    none = monitor.freshness(log(spark, [(0, 1, None, False)]), now).first()
    assert none["state"] == "stalled" and none["last_success"] is None
    firing = quality.alerts(monitor.poll_health(df), monitor.freshness(df, now), spark.createDataFrame([], "airport string, minutes_since_prediction double"))
    assert sorted(r["rule"] for r in firing.collect()) == ["error_rate", "stale_source"]


def test_program_intervals_and_outages(spark):
    def see(*minutes):
        return [("JFK", "ground_stop", T0 + timedelta(minutes=m)) for m in minutes]

    seen = spark.createDataFrame(see(0, 5, 10, 24 * 60, 24 * 60 + 5), "airport string, event_type string, ingested_at timestamp")
    polls = log(spark, [(m, 1, None) for m in [0, 5, 10, 15, 24 * 60, 24 * 60 + 5]])
    got = monitor.program_intervals(seen, gap_s=900, log=polls).orderBy("start_ts").collect()
    # The stop of the next day is a new one; nothing tells whether that one has ended.
    assert [(r["sightings"], r["duration_s"], r["censored"]) for r in got] == [(3, 600.0, False), (2, 300.0, True)]


def test_unknown_airport_is_named(spark, airports):
    ok = spark.createDataFrame([(0, "KORD"), (1, "KJFK")], "ordinal int, icao string")
    assert [r["icao"] for r in joins.resolve_airports(ok, airports).collect()] == ["KORD", "KJFK"]
    with pytest.raises(ValueError, match="KXXX"):
        joins.resolve_airports(spark.createDataFrame([(0, "KXXX")], "ordinal int, icao string"), airports)


def test_tracked_codes(spark, airports):
    ev = spark.createDataFrame([("EWR",), ("KEWR",), ("LAX",)], "airport string")
    assert [r["airport"] for r in joins.tracked_events(ev, airports).collect()] == ["EWR"]


def test_nearest_beyond_reach_and_across_the_date_line(spark, airports):
    from tarmac.sources.airports import airports_df

    fiji = airports_df(spark, [("NFFN", "Nadi", -17.0, 179.9, "NFFN", "NAN", 0.0, "UTC")])
    obs = spark.createDataFrame([(1, -17.0, -179.9), (2, -17.0, 170.0), (3, None, None)], "id int, latitude double, longitude double")
    got = {r["id"]: r["nearest_icao"] for r in joins.nearest_airport(obs, fiji, 60).collect()}
    assert got == {1: "NFFN", 2: None, 3: None}


def test_nearest_matches_brute_force(spark):
    import random

    from tarmac.functions.geo import distance_nm
    from tarmac.sources.airports import airports_df

    rnd = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    dim = airports_df(
        spark, [("K" + letters[i % 26] + letters[i // 26] + "X", "n", rnd.uniform(-88, 88), rnd.uniform(-180, 180), "KJFK", f"A{i:02}"[:3], 0.0, "UTC") for i in range(90)]
    )
    obs = spark.createDataFrame([(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(400)], "id int, latitude double, longitude double")
    got = {r["id"]: r["nearest_icao"] for r in joins.nearest_airport(obs, dim, 900).collect()}
    pairs = obs.crossJoin(dim.select("icao", "lat", "lon")).withColumn("nm", distance_nm(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon")))
    want = {r["id"]: r["icao"] for r in pairs.filter("nm <= 900").groupBy("id").agg(F.min_by("icao", F.struct("nm", "icao")).alias("icao")).collect()}
    assert {k: v for k, v in got.items() if v} == want


def test_repeated_register_keys_do_not_multiply(spark):
    obs = spark.createDataFrame([("a",), ("b",)], "icao24 string")
    reg = spark.createDataFrame([("a", None), ("a", "A320"), ("a", "A319")], "icao24 string, typecode string")
    got = {r["icao24"]: r["typecode"] for r in joins.with_aircraft(obs, reg).collect()}
    assert got == {"a": "A319", "b": None}


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([("a", "KJFK", T0), ("a", "KEWR", T0 + timedelta(minutes=1)), ("b", "KJFK", T0)], "icao24 string, airport string, ingested_at timestamp")
    once = dedupe.dedupe(dedupe.with_hash(df))
    again = dedupe.dedupe(once.select("icao24", F.lit("KJFK").alias("airport"), F.col("first_seen").alias("ingested_at"), "payload_hash"))
    assert once.count() == again.count() == 2


def test_forecasts_do_not_leak(spark):
    w = spark.createDataFrame([("KJFK", T0, 0), ("KJFK", T0 + timedelta(minutes=15), 0)], "airport string, window_start timestamp, now_severity int")
    p = spark.createDataFrame([("KJFK", T0 + timedelta(minutes=10), T0 + timedelta(hours=1), T0 + timedelta(hours=3), 3)], "airport string, issued_at timestamp, time_from timestamp, time_to timestamp, severity int")
    got = joins.with_outlook(w, joins.forecast_outlook(p)).orderBy("window_start").collect()
    assert [r["deteriorating"] for r in got] == [False, True]  # not issued yet at the first


def test_target_looks_forward_only(spark):
    rows = [("KJFK", T0 + timedelta(minutes=15 * i), n, s) for i, (n, s) in enumerate([(1, 100.0), (1, 0.0), (3, 90.0), (0, 0.0), (1, 40.0), (1, 1000.0)])]
    df = spark.createDataFrame(rows, "airport string, window_start timestamp, departures bigint, delay_sum double")
    got = features.delay_target(df).orderBy("window_start").collect()
    assert got[0]["mean_delay_next"] == pytest.approx(130 / 5) and got[0]["target"] == 1
    assert got[5]["mean_delay_next"] is None and got[5]["target"] is None


def test_perfect_and_useless_scores(spark):
    rows = [("good", p, y) for p, y in [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)]] + [("flat", 0.5, y) for y in (1, 0, 0, 0)]
    got = {r["model_version"]: r for r in evaluate.evaluate(spark.createDataFrame(rows, "model_version string, p_delay double, target int")).collect()}
    assert got["good"]["pr_auc"] == 1.0 and got["good"]["recall_at_precision"] == 1.0
    assert got["flat"]["pr_auc"] == 0.25 and got["flat"]["recall_at_precision"] == 0.0
    assert got["good"]["brier"] == pytest.approx(0.025)


def test_gate(spark):
    m = spark.createDataFrame([("old", 0.80), ("ok", 0.785), ("bad", 0.78)], "model_version string, pr_auc double")
    assert evaluate.gate(m, "ok", "old").first()["passed"] is True
    assert evaluate.gate(m, "bad", "old").first()["passed"] is False
    assert evaluate.gate(m, "ok", "none").first()["passed"] is True


@pytest.mark.parametrize("n", [1000, 10_000, 100_000])
def test_shuffled_labels_agree_as_often_as_chance(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 4 == 0).cast("int").alias("target"))
    mixed = learning.shuffled_labels(df)
    r = mixed.agg(F.count("*").alias("n"), F.sum("target").alias("pos"), F.avg(((F.col("id") % 4 == 0) == (F.col("target") == 1)).cast("double")).alias("kept")).first()
    assert (r["n"], r["pos"]) == (n, n // 4)
    # Chance is 0.25 * 0.25 + 0.75 * 0.75; its spread at 1,000 rows is 0.012.
    assert abs(r["kept"] - 0.625) < (0.04 if n == 1000 else 0.02)


def test_late_features_are_found(spark):
    df = spark.createDataFrame([(T0, T0), (T0, T0 + timedelta(hours=1)), (T0, None)], "window_start timestamp, obs_time timestamp")
    assert learning.late_features(df, ["obs_time"]).count() == 1


def test_scrambled_features_raise_drift(spark):
    df = spark.range(4000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    same = evaluate.drift(df.filter("id % 2 = 0") if "id" in df.columns else df, df, ["x", "y"])
    assert evaluate.drift_alerts(same).count() == 0
    moved = evaluate.drift(df, df.withColumn("x", F.col("x") * 3), ["x", "y"])
    assert [r["feature"] for r in evaluate.drift_alerts(moved).collect()] == ["x"]


def test_find_flight_needs_two_characters(spark):
    df = spark.createDataFrame([("SQ 12", T0, "KJFK")], "flight_number string, scheduled timestamp, airport string")
    assert board.find_flight(df, "1").count() == 0 and board.find_flight(df, "1 2").count() == 1


def test_subjects_that_never_reported_alert(spark):
    now = F.current_timestamp()
    polls = log(spark, [(0, 1, None, True)])
    expected = spark.createDataFrame([("a-source-that-is-silent",)], "source string")
    fresh = monitor.freshness(polls, now, expected=expected)
    states = {r["source"]: r["state"] for r in fresh.collect()}
    assert states["a-source-that-is-silent"] == "stalled" and len(states) == 2
    none = monitor.prediction_age(spark.createDataFrame([], "airport string, ts timestamp"), now, spark.createDataFrame([("KJFK",)], "airport string"))
    firing = quality.alerts(monitor.poll_health(polls), fresh, none).collect()
    assert {("stale_source", "a-source-that-is-silent"), ("no_predictions", "KJFK")} <= {(r["rule"], r["subject"]) for r in firing}


def test_only_the_own_poller_proves_a_program_over(spark):
    seen = spark.createDataFrame([("JFK", "ground_stop", datetime(2026, 1, 1, 5))], "airport string, event_type string, ingested_at timestamp")
    polls = spark.createDataFrame([("metar", datetime(2026, 1, 1, 5, 5), True)], "source string, started_at timestamp, ok boolean")
    got = [monitor.program_intervals(seen, gap_s=900, log=polls, source=s).first()["censored"] for s in ("faa_status", "metar")]
    assert got == [True, False]
