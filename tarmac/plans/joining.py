"""Queries over joins, set operations, ordering and limits (J, U, K, W7-W11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import weather
from tarmac.functions.timing import window_key
from tarmac.operators import board, features, joins, monitor, quality
from tarmac.plans.registry import query
from tarmac.plans.views import Tables
from tarmac.sources.airports import airports_df
from tarmac.sources.lake import union_layers

AIRPORT_VALUES = """(VALUES ('KJFK', 406398e-4, -737789e-4, 'JFK', 13e0), ('KEWR', 406925e-4, -741687e-4, 'EWR', 18e0),
    ('KORD', 419786e-4, -879048e-4, 'ORD', 672e0)) a(icao, alat, alon, faa, elev)"""
HAVERSINE = """3440065e-3 * 2 * asin(sqrt(pow(sin(radians(latitude - alat) / 2), 2)
    + cos(radians(alat)) * cos(radians(latitude)) * pow(sin(radians(longitude - alon) / 2), 2)))"""


def airports(t: Tables):
    return airports_df(t.spark)


@query("j01_tracked_events", ["v_program"], """
    SELECT event_id, airport, event_type FROM v_program WHERE airport IN (SELECT 'JFK' UNION ALL SELECT 'ORD')""")
def j01(t: Tables):
    two = airports(t).filter("icao <> 'KEWR'")
    return joins.tracked_events(t.v_program, two).select("event_id", "airport", "event_type")


@query("j02_resolve_airports", ["v_board"], f"""
    SELECT b.icao, b.ordinal, a.faa AS faa_code, a.elev AS elev_ft FROM
    (SELECT airport AS icao, min(o_orderkey) AS ordinal FROM v_board GROUP BY airport) b JOIN {AIRPORT_VALUES} ON a.icao = b.icao""", ["elev_ft"])
def j02(t: Tables):
    active = t.v_board.groupBy(F.col("airport").alias("icao")).agg(F.min("o_orderkey").alias("ordinal"))
    return joins.resolve_airports(active, airports(t)).select("icao", "ordinal", "faa_code", "elev_ft")


@query("j03_airport_keys", ["v_program"], f"""
    SELECT event_id, airport, a.icao, a.icao AS metar_station FROM v_program LEFT JOIN {AIRPORT_VALUES} ON faa = airport""")
def j03(t: Tables):
    return joins.with_airport_keys(t.v_program, airports(t), "airport", "faa_code").select(
        "event_id", "airport", "icao", "metar_station"
    )


@query("j04_assign_boxes", ["v_obs"], f"""
    SELECT event_id, a.icao AS airport FROM v_obs JOIN {AIRPORT_VALUES}
      ON abs(latitude - alat) <= 1 AND abs(longitude - alon) <= 1 / cos(radians(alat))""")
def j04(t: Tables):
    return joins.assign_boxes(t.v_obs, airports(t), 60.0).select("event_id", "airport")


@query("j05_nearest_airport", ["v_obs"], f"""
    SELECT o.event_id, n.icao AS nearest_icao, n.nm AS nearest_nm FROM v_obs o LEFT JOIN
      (SELECT event_id, arg_min(icao, (nm, icao)) AS icao, min(nm) AS nm
       FROM (SELECT event_id, icao, {HAVERSINE} AS nm FROM v_obs, {AIRPORT_VALUES} WHERE latitude <= 90) d
       WHERE nm <= 250 GROUP BY event_id) n USING (event_id)""", ["nearest_nm"])
def j05(t: Tables):
    return joins.nearest_airport(t.v_obs, airports(t)).select("event_id", "nearest_icao", "nearest_nm")


@query("j06_with_aircraft", ["v_obs", "v_register"], """
    SELECT o.event_id, o.icao24, r.reg, r.typecode, r.built FROM v_obs o LEFT JOIN (
      SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY
        (built IS NULL)::INT + (reg IS NULL)::INT + (typecode IS NULL)::INT, coalesce(built, ''), coalesce(reg, ''), coalesce(typecode, '')) AS rn
      FROM (SELECT icao24, reg, nullif(trim(icaoaircrafttype), '') AS typecode, nullif(trim(built), '') AS built FROM v_register) x) r
      ON r.icao24 = o.icao24 AND r.rn = 1""")
def j06(t: Tables):
    reg = t.v_register.selectExpr(
        "icao24", "reg", "nullif(trim(icaoaircrafttype), '') AS typecode", "nullif(trim(built), '') AS built"
    )
    return joins.with_aircraft(t.v_obs, reg).select("event_id", "icao24", "reg", "typecode", "built")


_ASOF_LEFT = "(SELECT icao24, last_seen, arrival_airport AS station FROM v_flight)"


@query("j07_asof_join", ["v_flight", "v_metar"], f"""
    SELECT l.icao24, l.last_seen, l.station, CASE WHEN m.obs_time >= l.last_seen - INTERVAL 2 HOUR THEN m.obs_time END AS obs_time,
      CASE WHEN m.obs_time >= l.last_seen - INTERVAL 2 HOUR THEN m.wind_speed_kt END AS wind_speed_kt
    FROM {_ASOF_LEFT} l ASOF LEFT JOIN v_metar m ON l.station = m.station AND l.last_seen >= m.obs_time""", ["wind_speed_kt"])
def j07(t: Tables):
    left = t.v_flight.select("icao24", "last_seen", F.col("arrival_airport").alias("station"))
    return joins.asof_join(
        left, t.v_metar, ["station"], "last_seen", "obs_time", tolerance_s=7200,
        right_cols=["obs_time", "wind_speed_kt"],
    )


@query("j07_asof_join_unbounded", ["v_flight", "v_metar"], f"""
    SELECT l.icao24, l.last_seen, l.station, m.obs_time, m.wind_speed_kt
    FROM {_ASOF_LEFT} l ASOF LEFT JOIN v_metar m ON l.station = m.station AND l.last_seen >= m.obs_time""", ["wind_speed_kt"])
def j07u(t: Tables):
    left = t.v_flight.select("icao24", "last_seen", F.col("arrival_airport").alias("station"))
    return joins.asof_join(
        left, t.v_metar, ["station"], "last_seen", "obs_time", right_cols=["obs_time", "wind_speed_kt"]
    )


_NOW = """(SELECT station AS airport, time_bucket(INTERVAL 15 MINUTE, obs_time) AS window_start, max(greatest(
      CASE WHEN visibility_sm < 1 THEN 3 WHEN visibility_sm < 3 THEN 2 WHEN visibility_sm <= 5 THEN 1 WHEN visibility_sm > 5 THEN 0 END,
      CASE WHEN ceiling_ft < 500 THEN 3 WHEN ceiling_ft < 1000 THEN 2 WHEN ceiling_ft <= 3000 THEN 1 WHEN ceiling_ft > 3000 THEN 0 END)) AS now_severity
    FROM v_metar GROUP BY ALL)"""


def now_windows(t: Tables):
    sev = weather.severity(F.col("visibility_sm"), F.col("ceiling_ft"))
    return t.v_metar.groupBy(
        F.col("station").alias("airport"), window_key(F.col("obs_time")).alias("window_start")
    ).agg(F.max(sev).alias("now_severity"))


@query("j08_forecast_outlook", ["v_metar", "v_period"], f"""
    SELECT w.airport, w.window_start, any_value(w.now_severity) AS now_severity, max(p.severity) AS worst_ahead,
      coalesce(max(p.severity) > any_value(w.now_severity), FALSE) AS deteriorating
    FROM {_NOW} w LEFT JOIN v_period p ON p.airport = w.airport AND p.time_to > p.time_from AND p.issued_at <= w.window_start
      AND p.time_from < w.window_start + INTERVAL 2 HOUR AND p.time_to > w.window_start
    GROUP BY w.airport, w.window_start""")
def j08(t: Tables):
    return joins.with_outlook(now_windows(t), joins.forecast_outlook(t.v_period))


_GAP_MIN = 40
INTERVALS = f"""(SELECT airport, event_type, min(ingested_at) AS start_ts, max(ingested_at) AS end_ts, count(*) AS sightings FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY airport, event_type ORDER BY ingested_at ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN ingested_at - lag(ingested_at) OVER (PARTITION BY airport, event_type ORDER BY ingested_at) <= INTERVAL {_GAP_MIN} MINUTE
        THEN 0 ELSE 1 END AS fresh FROM v_program) g) i GROUP BY airport, event_type, island)"""


def intervals(t: Tables):
    return monitor.program_intervals(t.v_program, gap_s=_GAP_MIN * 60)


@query("j09_active_programs", ["v_metar", "v_program"], f"""
    SELECT w.airport, w.window_start, coalesce(bool_or(i.event_type = 'ground_stop'), FALSE) AS ground_stop_active,
      coalesce(bool_or(i.event_type = 'ground_delay'), FALSE) AS ground_delay_active, coalesce(bool_or(i.event_type = 'closure'), FALSE) AS closure_active,
      count(i.event_type) AS programs_active
    FROM {_NOW} w LEFT JOIN {INTERVALS} i ON 'K' || i.airport = w.airport
      AND i.start_ts < w.window_start + INTERVAL 15 MINUTE AND i.end_ts >= w.window_start
    GROUP BY w.airport, w.window_start""")
def j09(t: Tables):
    programs = joins.with_airport_keys(intervals(t), airports(t), "airport", "faa_code").withColumn("airport", F.col("icao"))
    flags = joins.active_programs(programs)
    return (
        now_windows(t).drop("now_severity").join(flags, ["airport", "window_start"], "left")
        .na.fill(False).na.fill(0)
    )


_DELAYS = """(SELECT airport, time_bucket(INTERVAL 15 MINUTE, scheduled) AS window_start, count(*) AS departures,
    CAST(sum(delay_min) AS DOUBLE) AS delay_sum, avg(delay_min) AS mean_delay FROM v_ontime WHERE airport <> 'LAX' GROUP BY ALL)"""


def delays(t: Tables):
    from tarmac.sources.ontime import track_ontime

    return features.delay_windows(track_ontime(t.v_ontime, airports(t), local_clock=False))


@query("j10_build_dataset", ["v_metar", "v_ontime"], f"""
    SELECT w.airport, w.window_start, w.now_severity, d.departures, d.mean_delay
    FROM {_NOW} w JOIN {_DELAYS} d ON w.airport = 'K' || d.airport AND w.window_start = d.window_start""", ["mean_delay"])
def j10(t: Tables):
    return joins.build_dataset(now_windows(t), delays(t)).select(
        "airport", "window_start", "now_severity", "departures", "mean_delay"
    )


@query("j11_backfill_truth", ["v_scored", "v_ontime"], f"""
    SELECT s.airport, s.ts, s.model_version, s.p_delay, d.mean_delay
    FROM v_scored s LEFT JOIN {_DELAYS} d ON 'K' || d.airport = s.airport
      AND s.ts >= d.window_start AND s.ts < d.window_start + INTERVAL 15 MINUTE""", ["p_delay", "mean_delay"])
def j11(t: Tables):
    return joins.backfill_truth(t.v_scored, delays(t).select("airport", "window_start", "mean_delay")).select(
        "airport", "ts", "model_version", "p_delay", "mean_delay"
    )


@query("u01_union_layers", ["v_bronze"], "SELECT airport, origin_country, count(*) AS n FROM v_bronze GROUP BY ALL")
def u01(t: Tables):
    b = t.v_bronze
    cut = F.lit("2024-01-15").cast("timestamp")
    early, late = b.filter(F.col("ingested_at") < cut), b.filter(F.col("ingested_at") >= cut)
    turned = late.select(*reversed(late.columns))
    return union_layers(early, turned).groupBy("airport", "origin_country").agg(F.count("*").alias("n"))


STATE_BAD = """(NOT regexp_full_match(icao24, '[0-9a-f]{6}') OR coalesce(abs(latitude) > 90, FALSE) OR coalesce(abs(longitude) > 180, FALSE)
    OR velocity_ms < 0 OR true_track_deg > 360 OR last_contact IS NULL OR on_ground IS NULL OR spi IS NULL)"""


@query("u03_split_is_partition", ["v_obs"], f"""
    SELECT count(*) AS n_input, count(*) FILTER (WHERE NOT {STATE_BAD}) AS n_accepted, count(*) FILTER (WHERE {STATE_BAD}) AS n_rejected,
      CAST(0 AS BIGINT) AS n_both, CAST(0 AS BIGINT) AS n_neither FROM v_obs""")
def u03(t: Tables):
    judged = quality.validate_states(t.v_obs)
    ids = judged.select("event_id")
    good, bad = quality.accepted(judged).select("event_id"), quality.rejected(judged).select("event_id")
    # Five one-row counts side by side, by way of one stacked aggregation.
    parts = [
        ("n_input", ids), ("n_accepted", good), ("n_rejected", bad), ("n_both", good.intersect(bad)),
        ("n_neither", ids.exceptAll(good.unionByName(bad))),
    ]
    stacked = None
    for name, df in parts:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n")
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.agg(*[F.max(F.when(F.col("k") == n, F.col("n"))).alias(n) for n, _ in parts])


@query("k02_recent_events", ["v_program"], """
    SELECT ingested_at AS ts, event_type AS kind, airport, CAST(event_id AS VARCHAR) AS detail FROM v_program
    ORDER BY ingested_at DESC, event_type, airport, CAST(event_id AS VARCHAR) LIMIT 9""")
def k02(t: Tables):
    feed = t.v_program.select(
        F.col("ingested_at").alias("ts"), F.col("event_type").alias("kind"), "airport", F.col("event_id").cast("string").alias("detail")
    )
    return board.recent(feed)


@query("k03_find_flight", ["v_board"], """
    SELECT flight_number, airport, scheduled FROM v_board WHERE contains(replace(flight_number, ' ', ''), '12')
    ORDER BY scheduled, flight_number, airport LIMIT 12""")
def k03(t: Tables):
    return board.find_flight(t.v_board, "1 2").select("flight_number", "airport", "scheduled")


_SPINE = """(SELECT airport, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS window_start FROM
    (SELECT station AS airport, time_bucket(INTERVAL 15 MINUTE, min(obs_time)) AS lo, time_bucket(INTERVAL 15 MINUTE, max(obs_time)) AS hi
     FROM v_metar GROUP BY station) r)"""
_COUNTS = f"""(SELECT s.airport, s.window_start, count(m.event_id) AS n_arrivals FROM {_SPINE} s LEFT JOIN v_metar m
    ON m.station = s.airport AND time_bucket(INTERVAL 15 MINUTE, m.obs_time) = s.window_start GROUP BY ALL)"""


def dense(t: Tables):
    span = t.v_metar.groupBy(F.col("station").alias("icao")).agg(F.min("obs_time").alias("lo"), F.max("obs_time").alias("hi"))
    return features.spine(span, F.col("lo"), F.col("hi") + F.make_interval(secs=F.lit(0.000001)))


def dense_counts(t: Tables):
    n = t.v_metar.groupBy(F.col("station").alias("airport"), window_key(F.col("obs_time")).alias("window_start")).agg(
        F.count("*").alias("n_arrivals")
    )
    return dense(t).join(n, ["airport", "window_start"], "left").na.fill(0)


@query("w07_spine", ["v_metar"], f"SELECT * FROM {_SPINE} s")
def w07(t: Tables):
    return dense(t)


@query("w08_lag_features", ["v_metar"], f"""
    SELECT c.*, a.n_arrivals AS n_arrivals_t15, b.n_arrivals AS n_arrivals_t30, d.n_arrivals AS n_arrivals_t60 FROM {_COUNTS} c
      LEFT JOIN {_COUNTS} a ON a.airport = c.airport AND a.window_start = c.window_start - INTERVAL 15 MINUTE
      LEFT JOIN {_COUNTS} b ON b.airport = c.airport AND b.window_start = c.window_start - INTERVAL 30 MINUTE
      LEFT JOIN {_COUNTS} d ON d.airport = c.airport AND d.window_start = c.window_start - INTERVAL 60 MINUTE""")
def w08(t: Tables):
    return features.lag_features(dense_counts(t), ["n_arrivals"])


@query("w09_trend", ["v_metar"], f"""
    SELECT * REPLACE (CASE WHEN isnan(arrival_rate_trend) THEN NULL ELSE arrival_rate_trend END AS arrival_rate_trend) FROM (
    SELECT airport, window_start, n_arrivals, regr_slope(n_arrivals, epoch(window_start) / 900) OVER
      (PARTITION BY airport ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS arrival_rate_trend FROM {_COUNTS} c) s""", ["arrival_rate_trend"])
def w09(t: Tables):
    return features.trend(dense_counts(t))


@query("w10_latest", ["v_scored"], """
    SELECT airport, model_version, ts, p_delay FROM v_scored WHERE (airport, model_version, ts) IN
      (SELECT (airport, model_version, max(ts)) FROM v_scored GROUP BY airport, model_version)""", ["p_delay"])
def w10(t: Tables):
    return joins.latest_by(t.v_scored, ["airport", "model_version"], ["ts"]).select("airport", "model_version", "ts", "p_delay")


@query("w11_poll_gaps", ["v_poll"], """
    SELECT source, prev AS gap_start, started_at AS gap_end, (epoch_us(started_at) - epoch_us(prev)) / 1e6 AS gap_s FROM
      (SELECT source, started_at, lag(started_at) OVER (PARTITION BY source ORDER BY started_at, poll_id) AS prev FROM v_poll WHERE ok) g
    WHERE epoch_us(started_at) - epoch_us(prev) > CAST(1000000 AS BIGINT) * CASE source WHEN 'error' THEN 2700 WHEN 'view' THEN 1350 ELSE 900 END""", ["gap_s"])
def w11(t: Tables):
    return monitor.poll_gaps(t.v_poll, {"error": 900.0, "view": 450.0}, factor=3.0)
