"""Detectors on crafted flights: what must fire and what must not."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.config import Thresholds
from tarmac.operators import tracks

POINT = (
    "icao24 string, ts timestamp, airport string, dist_nm double, alt_ft double, agl_ft double, "
    "vertical_rate_ms double, true_track_deg double, velocity_ms double, on_ground boolean"
)
T0 = datetime(2026, 1, 1, 5, 40)


def flight(name, profile, step=30, start=T0, airport="KJFK"):
    """Points from (distance, altitude, vertical rate, heading, ground) tuples."""
    return [
        (name, start + timedelta(seconds=step * i), airport, float(d), float(a), float(a), float(v), float(h), 70.0, g)
        for i, (d, a, v, h, g) in enumerate(profile)
    ]


def descent(low=1250, near=0.5, n=20):
    return [(near + 0.6 * (n - i), low + 250 * (n - i), -2.6, 180, False) for i in range(n + 1)]


def climb(low=1250, rate=6.0, gain=600, n=6):
    return [(1 + i, low + gain * (i + 1), rate, 180, False) for i in range(n)]


GO_AROUND = descent() + climb()
LANDING = descent(low=100) + [(0.2, 0, 0, 180, True)] * 5
TOUCH_AND_GO = descent(low=100) + [(0.2, 0, 0, 180, True)] + climb(low=0)
SMALL_CLIMB = descent() + climb(gain=150, n=6)
SHORT_CLIMB = descent() + climb(gain=1200, n=1) + [(3, 2450, 0, 180, False)] * 5
FAR_LOW = [(d + 20, a, v, h, g) for d, a, v, h, g in GO_AROUND]
CIRCLING = [(15, 7000, 0, (90 * i) % 360, False) for i in range(30)]
S_TURNS = [(15, 7000, 0, 90 if i % 2 else 180, False) for i in range(40)]
STEPPING_DOWN = [(15, 9000 - 100 * i, 0, (90 * i) % 360, False) for i in range(30)]
FAR_CIRCLING = [(60, 7000, 0, (90 * i) % 360, False) for i in range(30)]
RACETRACK = [(15, 7000, 0, h, False) for _ in range(4) for h in (0, 0, 0, 60, 120, 180, 180, 180, 240, 300)]


@pytest.fixture(scope="module")
def points(spark):
    rows = []
    for name, p in {
        "goaround": GO_AROUND, "landing": LANDING, "touchgo": TOUCH_AND_GO, "small": SMALL_CLIMB, "short": SHORT_CLIMB, "farlow": FAR_LOW,
        "circling": CIRCLING, "sturns": S_TURNS, "stepping": STEPPING_DOWN, "farcirc": FAR_CIRCLING, "racetrack": RACETRACK,
    }.items():
        rows += flight(name, p)
    rows += flight("sparse", CIRCLING, step=90)
    rows += flight("faded", descent(low=400, n=10))
    # Two aborted approaches of one aircraft within one segment.
    rows += flight("twice", GO_AROUND + [(10, 6000, 0, 180, False)] * 3 + [(d, a, v, h, g) for d, a, v, h, g in GO_AROUND])
    return spark.createDataFrame(rows, POINT)


def names(df):
    return sorted(r["icao24"] for r in df.select("icao24").collect())


@pytest.mark.parametrize("bucket_s", [900, 1000, 21_600])
def test_go_arounds(points, bucket_s):
    got = tracks.go_arounds(points, Thresholds(bucket_s=bucket_s))
    assert names(got) == ["goaround", "twice", "twice"]
    row = got.filter("icao24 = 'goaround'").first()
    assert row["low_agl_ft"] == 1250.0 and row["agl_ft"] - row["low_agl_ft"] > 1000


@pytest.mark.parametrize("bucket_s", [900, 21_600])
def test_holds(points, bucket_s):
    got = tracks.holds(points, Thresholds(bucket_s=bucket_s))
    assert set(names(got)) == {"circling", "racetrack"}
    hold = got.filter("icao24 = 'circling'").collect()
    assert len(hold) == 1 and hold[0]["duration_s"] == 29 * 30


def test_sparse_samples_are_undetermined(points):
    seen = tracks.hold_points(points.filter("icao24 = 'sparse'"))
    assert seen.filter("holding IS NOT NULL").count() == 0
    cover = tracks.hold_coverage(points.filter("icao24 = 'sparse'")).first()
    assert cover["undetermined"] == cover["points"] == 30


@pytest.mark.parametrize("bucket_s", [900, 21_600])
def test_racetracks(points, bucket_s):
    got = tracks.racetracks(points, Thresholds(bucket_s=bucket_s))
    assert names(got) == ["racetrack"]
    assert got.first()["half_turns"] >= 3


@pytest.mark.parametrize("bucket_s", [900, 21_600])
def test_arrivals(points, bucket_s):
    got = {(r["icao24"], r["seen"]) for r in tracks.arrivals(points, Thresholds(bucket_s=bucket_s)).collect()}
    assert got == {("landing", "touchdown"), ("touchgo", "touchdown"), ("faded", "last_seen")}


@pytest.mark.parametrize("bucket_s", [900, 21_600])
def test_one_pass_equals_the_single_detectors(points, bucket_s):
    t = Thresholds(bucket_s=bucket_s)
    fused = tracks.point_events(points, t)
    key = ("icao24", "ts")

    def rows(df):
        return sorted(map(repr, df.select(*key).collect()))

    assert rows(fused.filter("went_around")) == rows(tracks.go_arounds(points, t))
    assert rows(fused.filter("seen IS NOT NULL")) == rows(tracks.arrivals(points, t))
    assert rows(fused.filter("on_approach")) == rows(tracks.approach_points(points, t))


def test_results_do_not_depend_on_the_bucket(points):
    want = None
    for b in (900, 1234, 3600, 86_400):
        got = sorted(map(repr, tracks.holds(points, Thresholds(bucket_s=b)).collect()))
        want = want or got
        assert got == want


def test_segments(spark):
    at = [0, 900, 1801, 1900]
    df = spark.createDataFrame([("a", T0 + timedelta(seconds=s)) for s in at], "icao24 string, ts timestamp")
    got = tracks.segment_table(tracks.segments(df, bucket_s=600)).orderBy("segment_start").collect()
    assert [r["points"] for r in got] == [2, 2]
    again = tracks.segment_table(tracks.segments(df, bucket_s=86_400)).orderBy("segment_start").collect()
    assert got == again


def test_track_points_use_elevation_and_pressure(spark, airports):
    obs = spark.createDataFrame(
        [("a", T0, 41.9786, -87.9048, 1000.0, None), ("b", T0, 0.0, 0.0, 1000.0, None), ("c", T0, 40.64, -73.78, None, 500.0)],
        "icao24 string, last_contact timestamp, latitude double, longitude double, baro_altitude_m double, geo_altitude_m double",
    )
    metar = spark.createDataFrame([("KORD", T0 - timedelta(minutes=30), 1003.25)], "station string, obs_time timestamp, altimeter_hpa double")
    got = {r["icao24"]: r for r in tracks.track_points(obs, airports, metar).collect()}
    assert set(got) == {"a", "c"}  # the third lies near no airport
    assert got["a"]["airport"] == "KORD"
    assert got["a"]["agl_ft"] == pytest.approx(3280.84 - 672 - 273, abs=0.1)
    assert got["c"]["agl_ft"] == pytest.approx(1640.42 - 13, abs=0.1)


def streamed(rows, t, forget):
    """Alerts of the stream's rules, fed point by point; with ``forget`` from their stored memory alone."""
    from tarmac.streaming.events import Watch

    fired = []
    for name in sorted({r["icao24"] for r in rows}):
        watch = Watch(t)
        for r in rows:
            if r["icao24"] == name:
                fired += [(kind, name, us) for kind, _, us, _ in watch.feed(r.asDict())]
                watch = Watch(t, watch.memory()) if forget else watch
    return sorted(fired)


def batch_alerts(points, t):
    us = F.unix_micros("ts").alias("us")
    found = [("go-around", r["icao24"], r["us"]) for r in tracks.go_arounds(points, t).select("icao24", us).collect()]
    return sorted(found + [("hold", r["icao24"], r["us"]) for r in tracks.hold_points(points, t).filter("holding").select("icao24", us).collect()])


@pytest.mark.parametrize("forget", [False, True])
def test_streamed_rules_agree_with_batch(spark, points, forget):
    rows = points.withColumn("us", F.unix_micros("ts")).orderBy("icao24", "us").collect()
    assert streamed(rows, Thresholds(), forget) == batch_alerts(points, Thresholds())


def test_alerts_come_when_the_watermark_has_passed_them(spark, points, tmp_path):
    """Many micro-batches: same alerts as batch, each soon after its point; state does not outlive its bucket."""
    from tarmac.streaming import events, flows

    t, every, delay = Thresholds(), 150, 300
    late = spark.createDataFrame([("late", T0 - timedelta(hours=9), "KJFK", 1.0, 900.0, 900.0, 9.0, 180.0, 70.0, False)], POINT)
    ends = points.agg(F.max("ts")).first()[0] + timedelta(hours=12)
    # The last delivery moves the watermark on, past every bucket.
    far = spark.createDataFrame([("far", ends, "KJFK", 1.0, 900.0, 900.0, 0.0, 180.0, 70.0, False)], POINT)
    slot = F.floor(F.unix_seconds("ts") / every)
    slots = [r[0] for r in points.select(slot).distinct().orderBy(slot).collect()]
    deliveries = [points.where(slot == s) for s in slots]
    deliveries[5] = deliveries[5].unionByName(late)  # far behind the watermark: dropped
    clock, emitted = [], []
    for d in [*deliveries, far]:
        d.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        clock.append(d.where("icao24 <> 'late'").agg(F.max(F.unix_micros("ts"))).first()[0])

    def note(df, batch_id):
        emitted.extend((batch_id, r["kind"], r["icao24"], r["us"]) for r in df.select("kind", "icao24", F.unix_micros("ts").alias("us")).collect())

    src = flows.stream_landing(spark, f"{tmp_path}/in", points.schema, files_per_trigger=1)
    query = flows.start(events.stream_events(src, t, f"{delay} seconds"), f"{tmp_path}/checkpoint", each_batch=note, conf=events.STATE_STORE)
    flows.run_to_end(query)
    kept = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    for i, kind, name, us in emitted:
        # Nothing waits for its bucket of two hours: an alert is out within two delays and one delivery.
        assert i >= len(deliveries) or clock[i] - us <= (2 * delay + every + 60) * 1_000_000, (kind, name)
    assert sum(i < len(deliveries) for i, *_ in emitted) > len(emitted) / 2
    assert sorted(e[1:] for e in emitted) == batch_alerts(points, t)
    assert len(slots) > 15 and max(kept) > 10 * kept[-1]


def test_go_around_is_found_wherever_the_bucket_ends(spark, airports):
    """A slow one: the low point lies almost the whole horizon before the climb is sustained."""
    from dataclasses import replace

    from tarmac.config import DEFAULT

    base = 1_770_000_000
    rows = [("slow", base, 6.0, 2000.0, -5.0), ("slow", base + 10, 3.0, 1200.0, -5.0)]
    rows += [("slow", base + 10 + s, 3.0, 1200.0, 0.0) for s in range(60, 780, 60)]
    rows += [("slow", base + 800 + 10 * k, 3.0, 1300.0 + 200 * k, 8.0) for k in range(10)]
    fields = [(icao, s, d, a, v) for icao, s, d, a, v in rows]
    points = spark.createDataFrame(fields, "icao24 string, s bigint, dist_nm double, alt_ft double, vertical_rate_ms double").selectExpr(
        "icao24", "timestamp_seconds(s) AS ts", "'KJFK' AS airport", "dist_nm", "alt_ft", "alt_ft AS agl_ft", "vertical_rate_ms",
        "180.0D AS true_track_deg", "70.0D AS velocity_ms", "false AS on_ground")
    found = set()
    # Widths that put the end of a bucket on many places of the track.
    for width in (1800, 1807, 1901, 1999, 2111, 2503, 7200, 10_000_000):
        t = replace(DEFAULT, bucket_s=width)
        for rows_of in (tracks.go_arounds(points, t), tracks.point_events(points, t).where("went_around")):
            found.add(tuple((r["icao24"], r["ts"]) for r in rows_of.select("icao24", "ts").collect()))
    assert len(found) == 1 and len(next(iter(found))) == 1


def test_a_box_corner_has_a_nearest_airport(spark, airports):
    from tarmac.operators.joins import assign_boxes, nearest_airport

    corner = airports.where("icao = 'KORD'").selectExpr("lat - 4.1 AS latitude", "lon - 5.5 AS longitude")
    assert assign_boxes(corner, airports, 250.0).count() == 1
    row = nearest_airport(corner, airports).first()
    assert row["nearest_icao"] == "KORD" and row["nearest_nm"] > 250
