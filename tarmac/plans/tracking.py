"""Queries over tracks: segments and the event detectors (W1-W6), the feed (U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import board, dedupe, tracks
from tarmac.plans.joining import AIRPORT_VALUES, HAVERSINE, INTERVALS, airports, intervals
from tarmac.plans.registry import query
from tarmac.plans.views import Tables


@query("w01_segments", ["v_obs"], """
    SELECT icao24, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS points,
      icao24 || '-' || CAST(epoch_us(min(ts)) AS VARCHAR) AS segment_id FROM (
      SELECT icao24, ts, sum(fresh) OVER (PARTITION BY icao24 ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT icao24, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY icao24 ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM v_obs) f) g
    GROUP BY icao24, s""")
def w01(t: Tables):
    labelled = tracks.segments(t.v_obs, gap_s=6 * 3600, bucket_s=24 * 3600)
    return tracks.segment_table(labelled)


def points(t: Tables):
    return tracks.track_points(t.v_track, airports(t))


# The same points without Spark: nearest of the three airports, feet and height.
POINTS = f"""(SELECT icao24, ts, epoch_us(ts) / 1000000 AS sec, arg_min(icao, nm) AS airport, min(nm) AS dist,
      any_value(alt) AS alt, any_value(alt) - arg_min(elev, nm) AS agl, any_value(vertical_rate_ms) AS vr,
      any_value(true_track_deg) AS hdg, any_value(velocity_ms) AS spd, any_value(on_ground) AS ground
    FROM (SELECT v.*, last_contact AS ts, baro_altitude_m / 3048e-4 AS alt, a.icao, a.elev, {HAVERSINE} AS nm FROM v_track v, {AIRPORT_VALUES}) d
    GROUP BY icao24, ts)"""
LAGGED = f"""(SELECT *, CASE WHEN sec - psec <= 900 THEN pdist END AS pd, CASE WHEN sec - psec <= 900 THEN pairport END AS pa,
      CASE WHEN sec - psec <= 900 THEN pvr END AS pv, CASE WHEN sec - psec <= 900 THEN pground END AS pg FROM (
      SELECT *, lag(sec) OVER w AS psec, lag(dist) OVER w AS pdist, lag(airport) OVER w AS pairport, lag(vr) OVER w AS pvr,
        lag(ground) OVER w AS pground, lead(sec) OVER w AS nsec
      FROM {POINTS} p WINDOW w AS (PARTITION BY icao24 ORDER BY sec)) l)"""
APPROACH = f"""(SELECT *, coalesce(dist <= 25 AND vr < -2 AND alt < 8000 AND pa = airport AND dist < pd, FALSE) AS appr FROM {LAGGED} g)"""


@query("w02_approach_points", ["v_track"], f"SELECT airport, icao24, ts, dist AS dist_nm, alt AS alt_ft FROM {APPROACH} a WHERE appr", ["dist_nm", "alt_ft"])
def w02(t: Tables):
    return tracks.approach_points(points(t)).select("airport", "icao24", "ts", "dist_nm", "alt_ft")


# Written from the climb outwards: runs by self-join, not by running windows.
GO_AROUNDS = f"""(WITH a AS (SELECT * FROM {APPROACH} x),
      low AS (SELECT icao24, airport, sec, agl FROM a WHERE appr AND dist <= 5 AND agl < 1500),
      up AS (SELECT a.*, (SELECT max(s.sec) FROM a s WHERE s.icao24 = a.icao24 AND s.sec <= a.sec AND s.vr > 5 AND NOT coalesce(s.pv > 5, FALSE)) AS run
             FROM a WHERE a.vr > 5),
      hit AS (SELECT u.icao24, u.airport, u.run, u.sec, u.agl, l.sec AS lsec, l.agl AS lagl FROM up u JOIN low l
              ON l.icao24 = u.icao24 AND l.sec = (SELECT max(sec) FROM low m WHERE m.icao24 = u.icao24 AND m.sec <= u.sec)
              WHERE l.airport = u.airport AND u.sec - l.sec <= 900 AND u.sec - u.run >= 30 AND u.agl - l.agl > 1000
                AND NOT EXISTS (SELECT 1 FROM a g WHERE g.icao24 = u.icao24 AND g.ground AND g.sec BETWEEN l.sec AND u.sec))
    SELECT arg_min(airport, sec) AS airport, icao24, make_timestamp(CAST(min(sec) * 1000000 AS BIGINT)) AS ts,
      make_timestamp(CAST(arg_min(lsec, sec) * 1000000 AS BIGINT)) AS low_ts, arg_min(lagl, sec) AS low_agl_ft, arg_min(agl, sec) AS agl_ft
    FROM hit GROUP BY icao24, run)"""


@query("w03_go_arounds", ["v_track"], f"SELECT * FROM {GO_AROUNDS} g", ["low_agl_ft", "agl_ft"])
def w03(t: Tables):
    return tracks.go_arounds(points(t))


HOLD_HITS = f"""(WITH p AS (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY sec) AS rn FROM {POINTS} x WHERE dist <= 40),
      d AS (SELECT b.*, b.sec - a.sec AS gap, CASE WHEN b.hdg - a.hdg >= 180 THEN b.hdg - a.hdg - 360 WHEN b.hdg - a.hdg < -180
              THEN b.hdg - a.hdg + 360 ELSE b.hdg - a.hdg END AS turn FROM p b LEFT JOIN p a ON a.icao24 = b.icao24 AND a.rn = b.rn - 1),
      f AS (SELECT i.airport, i.icao24, i.sec, min(j.sec) AS first_sec, count(*) AS n, max(j.alt) - min(j.alt) AS band,
              sum(j.turn) - coalesce(arg_min(coalesce(j.turn, 0), j.sec), 0) AS turned, max(CASE WHEN j.sec = i0.s0 THEN NULL ELSE j.gap END) AS worst
            FROM d i JOIN d j ON j.icao24 = i.icao24 AND j.sec BETWEEN i.sec - 600 AND i.sec
            JOIN (SELECT a.icao24, a.sec, min(b.sec) AS s0 FROM d a JOIN d b ON b.icao24 = a.icao24 AND b.sec BETWEEN a.sec - 600 AND a.sec GROUP BY ALL) i0
              ON i0.icao24 = i.icao24 AND i0.sec = i.sec GROUP BY i.airport, i.icao24, i.sec)
    SELECT *, CASE WHEN n > 1 AND worst <= 30 THEN abs(turned) >= 720 AND band <= 600 END AS holding FROM f)"""
HOLDS = f"""(SELECT airport, icao24, make_timestamp(CAST(min(sec) * 1000000 AS BIGINT)) AS first_hit,
      make_timestamp(CAST(min(first_sec) * 1000000 AS BIGINT)) AS start_ts, make_timestamp(CAST(max(sec) * 1000000 AS BIGINT)) AS end_ts,
      max(sec) - min(first_sec) AS duration_s FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY icao24, airport ORDER BY sec ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY icao24, airport ORDER BY sec) <= 600 THEN 0 ELSE 1 END AS fresh
        FROM {HOLD_HITS} h WHERE holding) a) b GROUP BY airport, icao24, g)"""


@query("w04_holds", ["v_track"], f"SELECT * FROM {HOLDS} h", ["duration_s"])
def w04(t: Tables):
    return tracks.holds(points(t))


@query("w04_hold_coverage", ["v_track"], f"""
    SELECT airport, count(*) AS points, count(*) FILTER (WHERE holding IS NULL) AS undetermined, count(*) FILTER (WHERE holding) AS holding_points
    FROM {HOLD_HITS} h GROUP BY airport""")
def w04c(t: Tables):
    return tracks.hold_coverage(points(t))


@query("w05_racetracks", ["v_track"], f"""
    WITH p AS (SELECT * FROM {POINTS} x WHERE dist <= 40),
      d AS (SELECT *, sec - lag(sec) OVER w AS gap, ((hdg - lag(hdg) OVER w + 540) % 360) - 180 AS raw FROM p WINDOW w AS (PARTITION BY icao24 ORDER BY sec)),
      e AS (SELECT *, CASE WHEN gap IS NULL OR gap > 900 THEN 0 ELSE coalesce(raw, 0) END AS delta FROM d),
      s AS (SELECT *, CASE WHEN gap <= 900 AND delta / gap >= 1 THEN 1 WHEN gap <= 900 AND delta / gap <= -1 THEN -1 ELSE 0 END AS turn FROM e),
      r AS (SELECT *, row_number() OVER (PARTITION BY icao24, airport ORDER BY sec) - row_number() OVER (PARTITION BY icao24, airport, turn ORDER BY sec) AS run FROM s),
      t AS (SELECT icao24, airport, min(sec) AS s0, max(sec) AS s1 FROM r WHERE turn <> 0 GROUP BY icao24, airport, turn, run HAVING abs(abs(sum(delta)) - 180) <= 30),
      c AS (SELECT a.icao24, a.airport, a.s1, count(*) AS n, min(b.s0) AS f FROM t a JOIN t b ON b.icao24 = a.icao24 AND b.airport = a.airport
              AND b.s1 BETWEEN a.s1 - 1800 AND a.s1 GROUP BY a.icao24, a.airport, a.s1 HAVING count(*) >= 3),
      g AS (SELECT *, sum(fresh) OVER (PARTITION BY icao24, airport ORDER BY s1 ROWS UNBOUNDED PRECEDING) AS k FROM (
              SELECT *, CASE WHEN s1 - lag(s1) OVER (PARTITION BY icao24, airport ORDER BY s1) <= 1800 THEN 0 ELSE 1 END AS fresh FROM c) q)
    SELECT airport, icao24, make_timestamp(CAST(min(s1) * 1000000 AS BIGINT)) AS first_hit, make_timestamp(CAST(min(f) * 1000000 AS BIGINT)) AS start_ts,
      make_timestamp(CAST(max(s1) * 1000000 AS BIGINT)) AS end_ts, max(n) AS half_turns, max(s1) - min(f) AS duration_s
    FROM g GROUP BY airport, icao24, k""", ["duration_s"])
def w05(t: Tables):
    return tracks.racetracks(points(t))


ARRIVALS = f"""(SELECT airport, icao24, ts, CASE WHEN ground AND pg = FALSE THEN 'touchdown' ELSE 'last_seen' END AS seen FROM {APPROACH} a
    WHERE dist <= 5 AND ((ground AND pg = FALSE) OR (NOT ground AND appr AND agl < 1000 AND spd <= 90 AND (nsec IS NULL OR nsec - sec > 900))))"""


@query("w06_arrivals", ["v_track"], f"SELECT * FROM {ARRIVALS} a")
def w06(t: Tables):
    return tracks.arrivals(points(t))


@query("w06_one_point_per_instant", ["v_bronze"], """
    SELECT icao24, ingested_at, origin_country, level FROM (SELECT *, row_number() OVER (PARTITION BY icao24, ingested_at ORDER BY poll_id) AS rn FROM (
      SELECT poll_id, icao24, date_trunc('day', ingested_at) AS ingested_at, origin_country, level FROM v_bronze) b) x WHERE rn = 1""")
def w06p(t: Tables):
    daily = t.v_bronze.withColumn("ingested_at", F.date_trunc("day", "ingested_at"))
    return dedupe.one_point_per_instant(daily, ts="ingested_at", rank="poll_id").select(
        "icao24", "ingested_at", "origin_country", "level"
    )


@query("u02_event_feed", ["v_track", "v_program", "v_scored"], f"""
    SELECT ts, 'go-around' AS kind, airport, icao24 AS detail FROM {GO_AROUNDS} g
    UNION ALL SELECT start_ts, 'hold', airport, icao24 FROM {HOLDS} h
    UNION ALL SELECT start_ts, 'program', airport, event_type FROM {INTERVALS} i
    UNION ALL SELECT ts, 'cascade', airport, model_version FROM v_scored WHERE p_delay >= 95e-2""")
def u02(t: Tables):
    p = points(t)
    return board.event_feed(tracks.go_arounds(p), tracks.holds(p), intervals(t), t.v_scored, cascade_p=0.95)



