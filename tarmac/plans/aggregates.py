"""Queries over aggregations, quality rules and monitoring (A1-A14, Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import board, dedupe, features, joins, monitor, quality, sketches, tracks
from tarmac.plans.joining import (
    AIRPORT_VALUES, HAVERSINE, INTERVALS, STATE_BAD, _DELAYS, airports, delays,
)
from tarmac.plans.registry import query
from tarmac.plans.tracking import APPROACH, ARRIVALS, GO_AROUNDS, HOLDS, points
from tarmac.plans.views import Tables
from tarmac.sources.aircraft import parse_aircraft


@query("a01_dedupe", ["v_bronze"], """
    SELECT icao24, origin_country, level, min(ingested_at) AS first_seen, max(ingested_at) AS last_seen, count(*) AS times_seen,
      array_to_string(list_sort(list(DISTINCT airport)), ',') AS seen_from FROM v_bronze GROUP BY icao24, origin_country, level""")
def a01(t: Tables):
    one = dedupe.dedupe(dedupe.with_hash(t.v_bronze))
    return one.drop("payload_hash").withColumn("seen_from", F.array_join("seen_from", ","))


@query("a02_reject_summary", ["v_obs"], """
    SELECT 'states' AS source, CAST(ts AS DATE) AS day, reason, count(*) AS rows_rejected FROM (
      SELECT ts, 'icao24' AS reason FROM v_obs WHERE icao24 LIKE 'zz%' UNION ALL SELECT ts, 'latitude' FROM v_obs WHERE latitude > 90
      UNION ALL SELECT ts, 'velocity' FROM v_obs WHERE velocity_ms < 0 UNION ALL SELECT ts, 'track' FROM v_obs WHERE true_track_deg > 360
      UNION ALL SELECT ts, 'last_contact' FROM v_obs WHERE last_contact IS NULL UNION ALL SELECT ts, 'on_ground' FROM v_obs WHERE on_ground IS NULL) r
    GROUP BY ALL""")
def a02(t: Tables):
    return quality.reject_summary(quality.validate_states(t.v_obs), F.lit("states"), "ts")


@query("a03_program_intervals", ["v_program", "v_poll"], f"""
    SELECT i.*, (epoch_us(end_ts) - epoch_us(start_ts)) / 1e6 AS duration_s,
      NOT EXISTS (SELECT 1 FROM v_poll p WHERE p.ok AND p.source = 'click' AND p.started_at > i.end_ts AND p.started_at <= i.end_ts + INTERVAL 40 MINUTE) AS censored
    FROM {INTERVALS} i""", ["duration_s"])
def a03(t: Tables):
    polls = t.v_poll.filter("source = 'click'")
    return monitor.program_intervals(t.v_program, gap_s=2400, log=polls)


def register(t: Tables):
    return parse_aircraft(t.v_register)


_FLEET = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY (built IS NULL)::INT + (typecode IS NULL)::INT,
      coalesce(CAST(built AS VARCHAR), ''), coalesce(typecode, '')) AS rn FROM (
      SELECT trim(icao24) AS icao24, nullif(trim(icaoaircrafttype), '') AS typecode,
        CASE WHEN TRY_CAST(left(trim(built), 4) AS INTEGER) BETWEEN 1900 AND 2100 THEN TRY_CAST(left(trim(built), 4) AS INTEGER) END AS built
      FROM v_register WHERE trim(icao24) <> '') r) q WHERE rn = 1)"""


def track_spine(t: Tables):
    # From the first to the last point of each airport.
    span = points(t).groupBy(F.col("airport").alias("icao")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return features.spine(span, F.col("lo"), F.col("hi") + F.make_interval(secs=F.lit(0.000001)))


def gold_counts(t: Tables):
    p = points(t)
    return features.airport_windows(
        track_spine(t), tracks.point_events(p), tracks.holds(p), register(t)
    )


_TRACK_SPINE = f"""(SELECT airport, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, lo), time_bucket(INTERVAL 15 MINUTE, hi), INTERVAL 15 MINUTE)) AS window_start
    FROM (SELECT icao AS airport, min(ts) AS lo, max(ts) AS hi FROM (SELECT arg_min(icao, nm) AS icao, ts FROM (
      SELECT v.icao24, v.last_contact AS ts, a.icao, {HAVERSINE} AS nm FROM v_track v, {AIRPORT_VALUES}) d GROUP BY icao24, ts) n GROUP BY icao) r)"""
_W = "time_bucket(INTERVAL 15 MINUTE, {c})"
WINDOWS = f"""(SELECT s.airport, s.window_start, coalesce(a.n, 0) AS n_arrivals, coalesce(g.n, 0) AS n_go_arounds, coalesce(h.n, 0) AS n_holds,
      h.d AS mean_hold_duration, p.s AS mean_approach_speed, a.w AS share_widebody, a.y AS mean_aircraft_age FROM {_TRACK_SPINE} s
    LEFT JOIN (SELECT x.airport, {_W.format(c='x.ts')} AS w0, count(*) AS n, avg(CASE WHEN f.typecode IN ('B77W', 'A359', 'B789') THEN 1.0 WHEN f.typecode IS NOT NULL THEN 0.0 END) AS w,
        avg(year(x.ts) - f.built) FILTER (WHERE f.built <= year(x.ts)) AS y FROM {ARRIVALS} x LEFT JOIN {_FLEET} f USING (icao24) GROUP BY 1, 2) a ON a.airport = s.airport AND a.w0 = s.window_start
    LEFT JOIN (SELECT airport, {_W.format(c='ts')} AS w0, count(*) AS n FROM {GO_AROUNDS} x GROUP BY 1, 2) g ON g.airport = s.airport AND g.w0 = s.window_start
    LEFT JOIN (SELECT airport, {_W.format(c='end_ts')} AS w0, count(*) AS n, avg(duration_s) AS d FROM {HOLDS} x GROUP BY 1, 2) h ON h.airport = s.airport AND h.w0 = s.window_start
    LEFT JOIN (SELECT airport, {_W.format(c='ts')} AS w0, avg(spd) AS s FROM {APPROACH} x WHERE appr GROUP BY 1, 2) p ON p.airport = s.airport AND p.w0 = s.window_start)"""


@query("a04_airport_windows", ["v_track", "v_register"], f"""
    SELECT airport, window_start, n_arrivals, n_go_arounds, n_holds, mean_hold_duration, mean_approach_speed FROM {WINDOWS} w""",
    ["mean_hold_duration", "mean_approach_speed"])
def a04(t: Tables):
    return gold_counts(t).drop("share_widebody", "mean_aircraft_age")


@query("a05_fleet_mix", ["v_track", "v_register"], f"""
    SELECT airport, window_start, share_widebody, mean_aircraft_age FROM {WINDOWS} w WHERE n_arrivals > 0""", ["share_widebody", "mean_aircraft_age"])
def a05(t: Tables):
    return gold_counts(t).filter("n_arrivals > 0").select("airport", "window_start", "share_widebody", "mean_aircraft_age")


@query("a06_delay_windows", ["v_ontime"], f"""
    SELECT 'K' || airport AS airport, window_start, departures, delay_sum, mean_delay FROM {_DELAYS} d""", ["delay_sum", "mean_delay"])
def a06(t: Tables):
    return delays(t)


TARGETS = f"""(WITH d AS (SELECT 'K' || airport AS airport, window_start, departures, delay_sum, mean_delay FROM {_DELAYS} x)
    SELECT a.airport, a.window_start, a.departures, a.delay_sum, a.mean_delay, sum(b.delay_sum) / sum(b.departures) AS mean_delay_next,
      CAST(sum(b.delay_sum) / sum(b.departures) > 15 AS INTEGER) AS target
    FROM d a LEFT JOIN d b ON b.airport = a.airport AND b.window_start BETWEEN a.window_start + INTERVAL 15 MINUTE AND a.window_start + INTERVAL 60 MINUTE
    GROUP BY ALL)"""


@query("a07_delay_target", ["v_ontime"], f"SELECT airport, window_start, mean_delay_next, target FROM {TARGETS} d", ["mean_delay_next"])
def a07(t: Tables):
    return features.delay_target(delays(t)).select("airport", "window_start", "mean_delay_next", "target")


def silver_states(t: Tables):
    """Valid observations, one row per content, each at its nearest airport."""
    good = quality.accepted(quality.validate_states(t.v_obs))
    hashed = dedupe.with_hash(good, exclude=("event_id", "ts"))
    one = dedupe.dedupe(hashed, seen="ts", airport=None)
    return joins.nearest_airport(one, airports(t), max_nm=60.0)


@query("a08_profile_silver", ["v_obs"], f"""
    SELECT CAST(first_seen AS DATE) AS day, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft, count(DISTINCT icao) AS n_airports FROM (
      SELECT o.icao24, o.first_seen, n.icao FROM (SELECT icao24, latitude, longitude, min(ts) AS first_seen, min(event_id) AS id FROM v_obs WHERE NOT {STATE_BAD}
        GROUP BY icao24, callsign, last_contact, latitude, longitude, baro_altitude_m, on_ground, velocity_ms, true_track_deg, vertical_rate_ms, spi, wind_speed_kt) o
      LEFT JOIN (SELECT event_id, arg_min(icao, (nm, icao)) AS icao FROM (SELECT event_id, icao, {HAVERSINE} AS nm FROM v_obs, {AIRPORT_VALUES} WHERE latitude <= 90) d
        WHERE nm <= 60 GROUP BY event_id) n ON n.event_id = o.id) s GROUP BY 1""")
def a08(t: Tables):
    return features.profile(silver_states(t), "first_seen", airport="nearest_icao")


@query("a08_profile_period", ["v_bronze"], """
    SELECT date_trunc('week', ingested_at) AS period, count(DISTINCT CAST(ingested_at AS DATE)) AS days, count(*) AS n_rows, count(DISTINCT icao24) AS n_icao24, count(DISTINCT airport) AS n_airport
    FROM v_bronze GROUP BY 1""")
def a08p(t: Tables):
    # Daily sketches large enough to hold every aircraft of the given tables: distinct counts are then exact.
    daily = sketches.subject_sketches(t.v_bronze, "ingested_at", ["icao24", "airport"], lg=17)
    return sketches.profile_over(daily, F.date_trunc("week", F.col("day").cast("timestamp")), ["icao24", "airport"], lg=17)


@query("a08_seen_again", ["v_bronze"], """
    SELECT count(DISTINCT icao24) FILTER (WHERE early) AS n_first, count(DISTINCT icao24) FILTER (WHERE NOT early) AS n_second,
      (SELECT count(*) FROM (SELECT icao24 FROM v_bronze GROUP BY icao24 HAVING min(ingested_at) < TIMESTAMP '2024-01-16 00:00:00' AND max(ingested_at) >= TIMESTAMP '2024-01-16 00:00:00') b) AS n_both
    FROM (SELECT icao24, ingested_at < TIMESTAMP '2024-01-16 00:00:00' AS early FROM v_bronze) x""")
def a08s(t: Tables):
    daily = sketches.subject_sketches(t.v_bronze, "ingested_at", ["icao24"], lg=17)
    early = F.col("day") < F.lit("2024-01-16").cast("date")
    return sketches.seen_in_both(daily, early, ~early, "icao24", lg=17)


@query("a09_poll_health", ["v_poll"], """
    SELECT source, count(*) AS polls, count(*) FILTER (WHERE NOT ok) AS failures, count(*) FILTER (WHERE NOT ok) / count(*) AS error_rate,
      sum(rows_written) / ((epoch_us(max(started_at)) - epoch_us(min(started_at))) / 36e8) AS rows_per_hour, quantile_cont(round(duration_seconds, 3), 0.5) AS median_latency,
      count(*) FILTER (WHERE ok AND rows_written = 0) AS empty_polls, sum(matched) / sum(nationwide) AS matched_ratio FROM v_poll GROUP BY source""",
    ["error_rate", "rows_per_hour", "median_latency", "matched_ratio"])
def a09(t: Tables):
    return monitor.poll_health(t.v_poll)


@query("a09_poll_health_daily", ["v_poll"], """
    SELECT source, date_trunc('day', started_at) AS window_start, count(*) AS polls, count(*) FILTER (WHERE NOT ok) / count(*) AS error_rate,
      quantile_cont(round(duration_seconds, 3), 0.5) AS median_latency FROM v_poll GROUP BY ALL""", ["error_rate", "median_latency"])
def a09d(t: Tables):
    return monitor.poll_health(t.v_poll, "1 day").select("source", "window_start", "polls", "error_rate", "median_latency")


NOW = "2024-01-31 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


_FRESH = f"""(SELECT source, airport, max(started_at) FILTER (WHERE ok) AS last_success,
    (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(started_at) FILTER (WHERE ok))) / 6e7 AS minutes_since_success FROM v_poll GROUP BY source, airport)"""


@query("a10_freshness", ["v_poll"], f"""
    SELECT source || '/' || airport AS feed, last_success, minutes_since_success, CASE WHEN minutes_since_success > 90 OR last_success IS NULL THEN 'stalled'
      WHEN minutes_since_success > 30 THEN 'degraded' ELSE 'healthy' END AS state FROM {_FRESH} f""", ["minutes_since_success"])
def a10(t: Tables):
    from tarmac.config import Thresholds

    feeds = t.v_poll.withColumn("feed", F.concat_ws("/", "source", "airport"))
    return monitor.freshness(feeds, now(), Thresholds(stale_min=90.0, degraded_min=30.0), key="feed")


# The ledger by a recursive walk over each day, one poll after the other.
_LEDGER = """
    WITH RECURSIVE p AS (SELECT CAST(started_at AS DATE) AS day, poll_id, started_at, attempts, credits_remaining AS cr,
        row_number() OVER (PARTITION BY CAST(started_at AS DATE) ORDER BY started_at, poll_id) AS rn FROM v_poll),
      walk AS (SELECT day, rn, poll_id, started_at, CASE WHEN cr >= 0 THEN greatest(LIM - cr, 0) ELSE least(attempts, LIM) END AS used FROM p WHERE rn = 1
        UNION ALL SELECT p.day, p.rn, p.poll_id, p.started_at, CASE WHEN p.cr >= 0 THEN greatest(LIM - p.cr, 0) ELSE least(w.used + p.attempts, LIM) END
        FROM walk w JOIN p ON p.day = w.day AND p.rn = w.rn + 1)"""


@query("a11_credit_ledger", ["v_poll"], "SELECT * FROM (" + _LEDGER.replace("LIM", "600") + """
    SELECT poll_id, day, CAST(used AS BIGINT) AS used, CAST(600 - used AS BIGINT) AS remaining, 600 - used <= 60 AS low, used >= 600 AS exhausted FROM walk) q""")
def a11(t: Tables):
    return monitor.credit_ledger(t.v_poll, 600).select("poll_id", "day", "used", "remaining", "low", "exhausted")


@query("a11_credit_days", ["v_poll"], "SELECT * FROM (" + _LEDGER.replace("LIM", "600") + """
    SELECT day, CAST(max(used) AS BIGINT) AS peak_used, min(started_at) FILTER (WHERE 600 - used <= 60) AS first_low,
      min(started_at) FILTER (WHERE used >= 600) AS first_exhausted FROM walk GROUP BY day) q""")
def a11d(t: Tables):
    return monitor.credit_days(monitor.credit_ledger(t.v_poll, 600))


_HOURLY = """(SELECT s.airport, s.hour, v.index_value, coalesce(v.n, 0) AS n, v.index_value - b.index_value AS delta FROM
    (SELECT airport, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS hour FROM (SELECT airport, date_trunc('hour', ts) AS h FROM v_scored) x GROUP BY airport) s
    LEFT JOIN (SELECT airport, date_trunc('hour', ts) AS hour, avg(p_delay) AS index_value, count(*) AS n FROM v_scored GROUP BY ALL) v ON v.airport = s.airport AND v.hour = s.hour
    LEFT JOIN (SELECT airport, date_trunc('hour', ts) AS hour, avg(p_delay) AS index_value FROM v_scored GROUP BY ALL) b ON b.airport = s.airport AND b.hour = s.hour - INTERVAL 3 HOUR)"""


@query("a12_hourly_series", ["v_scored"], f"SELECT * FROM {_HOURLY} h", ["index_value", "delta"])
def a12(t: Tables):
    return monitor.hourly_series(t.v_scored, "ts", "p_delay")


@query("a12_last_day", ["v_scored"], f"""
    SELECT * FROM {_HOURLY} h WHERE hour > TIMESTAMP '2024-01-20 05:00:00' - INTERVAL 24 HOUR AND hour <= TIMESTAMP '2024-01-20 05:00:00'""", ["index_value", "delta"])
def a12d(t: Tables):
    return monitor.hourly_series(t.v_scored, "ts", "p_delay", until=F.lit("2024-01-20 05:30:00").cast("timestamp"))


@query("a13_facets", ["v_board"], "SELECT airline_code, airline_name FROM v_board GROUP BY ALL")
def a13(t: Tables):
    return board.facets(t.v_board)


@query("a13_board_visible", ["v_board"], """
    SELECT o_orderkey, flight_number FROM v_board WHERE status IN ('scheduled', 'boarding', 'delayed', 'en-route')
      AND date_part('hour', scheduled) BETWEEN 12 AND 17 AND (contains(replace(flight_number, ' ', ''), 'NATION_2') OR contains(upper(city), 'NATION_2') OR contains(city_code, 'NATION_2'))""")
def a13b(t: Tables):
    return board.visible(t.v_board, now(), window="afternoon", query="nation_2").select("o_orderkey", "flight_number")


@query("a14_completeness", ["v_obs"], """
    SELECT column_name, nulls, (SELECT count(*) FROM v_obs) AS rows_total FROM (
      SELECT 'last_contact' AS column_name, count(*) - count(last_contact) AS nulls FROM v_obs UNION ALL SELECT 'on_ground', count(*) - count(on_ground) FROM v_obs
      UNION ALL SELECT 'latitude', count(*) - count(latitude) FROM v_obs UNION ALL SELECT 'ts', count(*) - count(ts) FROM v_obs) c""")
def a14(t: Tables):
    return quality.completeness(t.v_obs, ["last_contact", "on_ground", "latitude", "ts"])


@query("q01_validate_states", ["v_obs"], f"SELECT event_id, {STATE_BAD} AS rejected FROM v_obs")
def q01(t: Tables):
    return quality.validate_states(t.v_obs).select("event_id", (F.size(quality.REASONS) > 0).alias("rejected"))


@query("q02_validate_silver", ["v_obs"], """
    SELECT event_id, CASE WHEN baro_altitude_m < -3048e-2 THEN 'altitude,' ELSE '' END || CASE WHEN wind_speed_kt > 200 THEN 'wind,' ELSE '' END
      || CASE WHEN latitude > 90 THEN 'latitude,' ELSE '' END AS reasons FROM v_obs""")
def q02(t: Tables):
    judged = quality.validate_silver(t.v_obs)
    return judged.select("event_id", F.concat_ws("", F.transform(quality.REASONS, lambda r: F.concat(r, F.lit(",")))).alias("reasons"))


@query("q03_batch_gate", ["v_obs"], f"""
    SELECT *, bad_share > 55e-3 AS rejected, coalesce(bad_share > 15e-1 * trailing_share, FALSE) AS spike FROM (
      SELECT *, avg(bad_share) OVER (ORDER BY batch_start ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS trailing_share FROM (
        SELECT date_trunc('day', ts) AS batch_start, count(*) AS rows_total, count(*) FILTER (WHERE {STATE_BAD}) AS rows_bad,
          count(*) FILTER (WHERE {STATE_BAD}) / count(*) AS bad_share FROM v_obs GROUP BY 1) b) s""", ["bad_share", "trailing_share"])
def q03(t: Tables):
    judged = quality.validate_states(t.v_obs).withColumn("batch_start", F.date_trunc("day", "ts"))
    return quality.batch_gate(judged, ["batch_start"], "batch_start", max_bad=0.055, spike=1.5)


@query("q04_alerts", ["v_poll", "v_scored"], f"""
    SELECT 'stale_source' AS rule, source AS subject, minutes_since_success AS measured, 15e0 AS threshold FROM
      (SELECT source, min(minutes_since_success) AS minutes_since_success FROM {_FRESH} f GROUP BY source) s WHERE minutes_since_success > 15 OR minutes_since_success IS NULL
    UNION ALL SELECT 'error_rate', source, r, 2e-1 FROM (SELECT source, avg(CASE WHEN ok THEN 0.0 ELSE 1.0 END) AS r FROM v_poll GROUP BY source) e WHERE r > 2e-1
    UNION ALL SELECT 'no_predictions', airport, m, 3e1 FROM (SELECT airport, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 6e7 AS m FROM v_scored GROUP BY airport) p WHERE m > 30""",
    ["measured", "threshold"])
def q04(t: Tables):
    return quality.alerts(
        monitor.poll_health(t.v_poll), monitor.freshness(t.v_poll, now()), monitor.prediction_age(t.v_scored, now())
    )


