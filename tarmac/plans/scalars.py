"""Queries over the column functions (F1-F30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import board as bd
from tarmac.functions import geo, text, timing, weather
from tarmac.functions.identity import payload_hash
from tarmac.plans.registry import query
from tarmac.plans.views import Tables, lat, lon

TEXT = ["v_text"]


@query("f01_epoch_utc", TEXT, """
    SELECT event_id, make_timestamp(CAST(round(TRY_CAST(epoch_text AS DOUBLE) * 1000000) AS BIGINT)) AS at
    FROM (SELECT event_id, CASE WHEN epoch_text IN ('true', 'false') THEN NULL ELSE epoch_text END AS epoch_text FROM v_text) t""")
def f01(t: Tables):
    return t.v_text.select("event_id", timing.epoch_utc(F.col("epoch_text")).alias("at"))


@query("f02_day_anchor", TEXT, """
    SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS epoch, date_trunc('day', ts) AS midnight,
      date_trunc('day', ts) + INTERVAL 18 HOUR AS evening,
      date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR AS singapore_midnight FROM v_text""", ["epoch"])
def f02(t: Tables):
    ts = F.col("ts")
    return t.v_text.select(
        "event_id", timing.utc_epoch(ts).alias("epoch"), timing.day_anchor(ts).alias("midnight"),
        timing.day_anchor(ts, 18).alias("evening"),
        timing.day_anchor(ts, 0, "Asia/Singapore").alias("singapore_midnight"),
    )


@query("f03_clean_callsign", TEXT, r"""
    SELECT event_id, nullif(regexp_replace(callsign_text, '^\s+|\s+$', '', 'g'), '') AS callsign FROM v_text""")
def f03(t: Tables):
    return t.v_text.select("event_id", text.clean_callsign(F.col("callsign_text")).alias("callsign"))


@query("f04_visibility_sm", TEXT, r"""
    SELECT event_id, CASE
      WHEN regexp_full_match(v, '\d+\s+\d+/\d+') THEN
        CAST(split_part(v, ' ', 1) AS DOUBLE) + CAST(split_part(split_part(v, ' ', 2), '/', 1) AS DOUBLE) / nullif(CAST(split_part(v, '/', 2) AS DOUBLE), 0)
      WHEN regexp_full_match(v, '\d+/\d+') THEN
        CAST(split_part(v, '/', 1) AS DOUBLE) / nullif(CAST(split_part(v, '/', 2) AS DOUBLE), 0)
      WHEN regexp_full_match(v, '[0-9.]+') THEN TRY_CAST(v AS DOUBLE) END AS visibility_sm
    FROM (SELECT event_id, trim(replace(rtrim(trim(vis_text), '+'), 'SM', '')) AS v FROM v_text) t""", ["visibility_sm"])
def f04(t: Tables):
    return t.v_text.select("event_id", weather.visibility_sm(F.col("vis_text")).alias("visibility_sm"))


@query("f05_wind_dir", TEXT, """
    SELECT event_id, d AS wind_dir_deg, d IS NULL AND coalesce(raw_text LIKE '%VRB%', FALSE) AS wind_variable
    FROM (SELECT event_id, raw_text, TRY_CAST(trim(wdir_text) AS INTEGER) AS d FROM v_text) t""")
def f05(t: Tables):
    d = weather.wind_dir(F.col("wdir_text"))
    return t.v_text.select(
        "event_id", d.alias("wind_dir_deg"), weather.wind_variable(d, F.col("raw_text")).alias("wind_variable")
    )


_LAYERS = """(SELECT event_id, unnest(covers) AS cover, unnest(bases) AS base FROM
    (SELECT event_id, ['FEW', 'BKN', 'OVC', 'VV'] AS covers,
       [event_id % 50, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 40 END,
        CASE WHEN event_id % 5 < 3 THEN NULL ELSE event_id % 30 END, CASE WHEN event_id % 7 > 0 THEN NULL ELSE event_id % 9 END] AS bases
     FROM events) z)"""


def _clouds(t: Tables):
    return t.table("events").select(
        "event_id",
        F.expr("""CASE WHEN event_id % 10 = 0 THEN NULL ELSE array(
            named_struct('cover', 'FEW', 'base_ft', CAST(event_id % 50 AS INT)),
            named_struct('cover', 'BKN', 'base_ft', CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 40 END AS INT)),
            named_struct('cover', 'OVC', 'base_ft', CAST(CASE WHEN event_id % 5 < 3 THEN NULL ELSE event_id % 30 END AS INT)),
            named_struct('cover', 'VV', 'base_ft', CAST(CASE WHEN event_id % 7 > 0 THEN NULL ELSE event_id % 9 END AS INT))) END""").alias("clouds"),
    )


@query("f06_empty_if_null", [], "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE 4 END AS layers FROM events")
def f06(t: Tables):
    filled = text.empty_if_null(F.col("clouds"), "array<struct<cover:string,base_ft:int>>")
    return _clouds(t).select("event_id", F.size(filled).alias("layers"))


@query("f07_ceiling_ft", [], f"""
    SELECT e.event_id, CAST(min(CASE WHEN l.cover <> 'FEW' AND e.event_id % 10 <> 0 THEN l.base END) AS INTEGER) AS ceiling_ft
    FROM events e LEFT JOIN {_LAYERS} l ON l.event_id = e.event_id GROUP BY e.event_id""")
def f07(t: Tables):
    return _clouds(t).select("event_id", weather.ceiling_ft(F.col("clouds")).alias("ceiling_ft"))


@query("f08_clean_text", TEXT, """
    SELECT event_id, nullif(trim(trim(trim(quoted_text), chr(39) || chr(34))), '') AS cleaned FROM v_text""")
def f08(t: Tables):
    return t.v_text.select("event_id", text.clean_text(F.col("quoted_text")).alias("cleaned"))


_YEAR = "CASE WHEN TRY_CAST(left(built_text, 4) AS INTEGER) BETWEEN 1900 AND 2100 THEN TRY_CAST(left(built_text, 4) AS INTEGER) END"


@query("f09_built_year", TEXT, f"SELECT event_id, {_YEAR} AS built FROM v_text")
def f09(t: Tables):
    return t.v_text.select("event_id", text.built_year(F.col("built_text")).alias("built"))


@query("f10_aircraft_age", TEXT, f"SELECT event_id, CASE WHEN b <= 2026 THEN 2026 - b END AS age FROM (SELECT event_id, {_YEAR} AS b FROM v_text) y")
def f10(t: Tables):
    return t.v_text.select("event_id", text.aircraft_age(text.built_year(F.col("built_text")), 2026).alias("age"))


@query("f11_first_text", TEXT, r"""
    SELECT event_id, coalesce(nullif(regexp_replace(callsign_text, '^\s+|\s+$', '', 'g'), ''), nullif(trim(quoted_text), ''), raw_text) AS picked FROM v_text""")
def f11(t: Tables):
    return t.v_text.select(
        "event_id", text.first_text(F.col("callsign_text"), F.col("quoted_text"), F.col("raw_text")).alias("picked")
    )


@query("f12_event_type", TEXT, """
    SELECT event_id, m.code AS event_type FROM v_text JOIN (VALUES ('Ground Stop Programs', 'ground_stop'),
      ('Ground Delay Programs', 'ground_delay'), ('Airport Closures', 'closure'), ('Airspace Flow Programs', 'airspace_flow'),
      ('Arrival/Departure Delays', 'arrival_departure_delay'), ('Deicing', 'deicing')) m(section, code) USING (section)""")
def f12(t: Tables):
    return t.v_text.select("event_id", text.event_type(F.col("section")).alias("event_type")).filter("event_type is not null")


@query("f13_norm_keys", [], """
    SELECT c_custkey, lower(c_name) AS icao24, upper(c_mktsegment) AS faa FROM customer""")
def f13(t: Tables):
    return t.table("customer").select(
        "c_custkey", text.norm_icao24(F.col("c_name")).alias("icao24"), text.norm_faa(F.col("c_mktsegment")).alias("faa")
    )


@query("f14_bounding_box", ["v_obs"], """
    SELECT event_id, greatest(latitude - 1.0, -90.0) AS lamin, least(latitude + 1.0, 90.0) AS lamax,
      greatest(longitude - d, -180.0) AS lomin, least(longitude + d, 180.0) AS lomax
    FROM (SELECT *, 60e0 / (60e0 * greatest(cos(radians(latitude)), 1e-2)) AS d FROM v_obs WHERE latitude <= 90) b""",
    ["lamin", "lamax", "lomin", "lomax"])
def f14(t: Tables):
    return t.v_obs.filter("latitude <= 90").select(
        "event_id", geo.bounding_box(F.col("latitude"), F.col("longitude"), 60.0).alias("b")
    ).select("event_id", "b.*")


@query("f15_in_bbox", ["v_obs"], f"""
    SELECT event_id, coalesce(abs(latitude - {lat('user_id % 3')}) <= 1 AND
      abs(longitude - {lon('user_id % 3')}) <= 1 / greatest(cos(radians({lat('user_id % 3')})), 1e-2), FALSE) AS inside
    FROM v_obs JOIN (SELECT event_id, user_id FROM events) u USING (event_id)""")
def f15(t: Tables):
    base = t.view("v_obs").join(t.table("events").select("event_id", "user_id"), "event_id")
    box = geo.bounding_box(F.expr(lat("user_id % 3")), F.expr(lon("user_id % 3")), 60.0)
    return base.select("event_id", geo.in_bbox(F.col("latitude"), F.col("longitude"), box).alias("inside"))


@query("f16_payload_hash", ["v_bronze"], """
    SELECT icao24, origin_country, level, count(*) AS sightings
    FROM v_bronze GROUP BY icao24, origin_country, level""")
def f16(t: Tables):
    # Classes, not digests, are what two engines can agree on.
    h = payload_hash(["level", "icao24", "origin_country"])
    return (
        t.v_bronze.groupBy(h.alias("h"))
        .agg(F.min("icao24").alias("icao24"), F.min("origin_country").alias("origin_country"), F.min("level").alias("level"), F.count("*").alias("sightings"))
        .drop("h")
    )


@query("f17_partition_keys", TEXT, "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour FROM v_text")
def f17(t: Tables):
    return t.v_text.select("event_id", *timing.partition_keys(F.col("ts")))


@query("f18_units", ["v_obs"], "SELECT event_id, baro_altitude_m / 3048e-4 AS alt_ft, velocity_ms * 3600 / 1852 AS speed_kt FROM v_obs", ["alt_ft", "speed_kt"])
def f18(t: Tables):
    return t.v_obs.select(
        "event_id", geo.m_to_ft(F.col("baro_altitude_m")).alias("alt_ft"), geo.ms_to_kt(F.col("velocity_ms")).alias("speed_kt")
    )


@query("f19_distance_nm", ["v_obs"], """
    SELECT event_id, 3440065e-3 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS nm FROM (
      SELECT event_id, pow(sin(radians(latitude - 406398e-4) / 2), 2)
        + cos(radians(406398e-4)) * cos(radians(latitude)) * pow(sin(radians(longitude + 737789e-4) / 2), 2) AS a
      FROM v_obs WHERE latitude <= 90) h""", ["nm"])
def f19(t: Tables):
    return t.v_obs.filter("latitude <= 90").select(
        "event_id",
        geo.distance_nm(F.lit(40.6398), F.lit(-73.7789), F.col("latitude"), F.col("longitude")).alias("nm"),
    )


@query("f20_heading_delta", [], """
    SELECT event_id, CASE WHEN d >= 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END AS turn
    FROM (SELECT event_id, CAST((event_id * 7) % 360 - (event_id * 13) % 360 AS DOUBLE) AS d FROM events) h""", ["turn"])
def f20(t: Tables):
    a, b = F.expr("CAST((event_id * 13) % 360 AS DOUBLE)"), F.expr("CAST((event_id * 7) % 360 AS DOUBLE)")
    return t.table("events").select("event_id", geo.heading_delta(a, b).alias("turn"))


@query("f21_crosswind_kt", ["v_metar"], """
    SELECT event_id, least(abs(wind_speed_kt * sin(radians(wind_dir_deg - 40))), abs(wind_speed_kt * sin(radians(wind_dir_deg - 130)))) AS crosswind_kt
    FROM v_metar WHERE wind_dir_deg IS NOT NULL UNION ALL SELECT event_id, NULL FROM v_metar WHERE wind_dir_deg IS NULL""", ["crosswind_kt"])
def f21(t: Tables):
    runways = F.array(F.lit(40.0), F.lit(130.0))
    return t.v_metar.select(
        "event_id", geo.least_crosswind_kt(F.col("wind_dir_deg").cast("double"), F.col("wind_speed_kt"), runways).alias("crosswind_kt")
    )


@query("f22_is_precip", TEXT, "SELECT event_id, coalesce(wx_string IN ('-RA', '+SN', 'TSRA', 'FZDZ'), FALSE) AS precip FROM v_text")
def f22(t: Tables):
    return t.v_text.select("event_id", weather.is_precip(F.col("wx_string")).alias("precip"))


@query("f23_notice_times", TEXT, r"""
    SELECT event_id, try_strptime(regexp_extract(notam_text, '(\d{10})-(\d{10})', 1), '%y%m%d%H%M') AS notam_start,
      try_strptime(regexp_extract(notam_text, '(\d{10})-(\d{10})', 2), '%y%m%d%H%M') AS notam_end,
      (SELECT arg_min(c, (abs(epoch(c) - epoch(ts)), -epoch(c))) FROM
        (SELECT try_strptime(CAST(y AS VARCHAR) || ' ' || left(notice_text, 6) || ' ' || substr(notice_text, 11, 5), '%Y %b %d %H:%M') AS c
         FROM (SELECT unnest([2022, 2023, 2024, 2025, 2026]) AS y) ys) cs WHERE c IS NOT NULL) AS loose_start
    FROM v_text""")
def f23(t: Tables):
    a, b = timing.notam_window(F.col("notam_text"))
    return t.v_text.select(
        "event_id", a.alias("notam_start"), b.alias("notam_end"),
        timing.faa_time(F.col("notice_text"), F.col("ts")).alias("loose_start"),
    )


@query("f24_delay_minutes", TEXT, """
    SELECT event_id, CASE delay_text WHEN '45 minutes' THEN 45 WHEN '1 hour and 15 minutes' THEN 75 WHEN '2 hours' THEN 120
      ELSE TRY_CAST(split_part(delay_text, ' min', 1) AS INTEGER) END AS minutes FROM v_text""")
def f24(t: Tables):
    return t.v_text.select("event_id", text.delay_minutes(F.col("delay_text")).alias("minutes"))


@query("f25_flight_category", ["v_metar"], "SELECT flight_category, count(*) AS n FROM v_metar GROUP BY flight_category")
def f25(t: Tables):
    return t.v_metar.groupBy("flight_category").agg(F.count("*").alias("n"))


@query("f26_window_key", TEXT, "SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, count(*) AS n FROM v_text GROUP BY 1")
def f26(t: Tables):
    return t.v_text.groupBy(timing.window_key(F.col("ts")).alias("window_start")).agg(F.count("*").alias("n"))


@query("f27_status_group", ["v_board"], """
    SELECT o_orderkey, status IN ('scheduled', 'boarding', 'delayed', 'en-route') AS active, status = 'delayed' AS delayed,
      status IN ('departed', 'landed', 'cancelled') AS done FROM v_board""")
def f27(t: Tables):
    s = F.col("status")
    return t.v_board.select("o_orderkey", *[bd.status_group(s, g).alias(g) for g in ("active", "delayed", "done")])


@query("f28_time_window", ["v_board"], """
    SELECT o_orderkey, scheduled BETWEEN TIMESTAMP '2024-01-01 11:45:00' AND TIMESTAMP '2024-01-01 15:00:00' AS soon,
      date_part('hour', scheduled) BETWEEN 5 AND 11 AS morning, date_part('hour', scheduled) BETWEEN 12 AND 17 AS afternoon,
      date_part('hour', scheduled) >= 18 AS evening FROM v_board""")
def f28(t: Tables):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    names = ("soon", "morning", "afternoon", "evening")
    return t.v_board.select("o_orderkey", *[bd.time_window(F.col("scheduled"), w, now).alias(w) for w in names])


@query("f29_board_match", ["v_board"], """
    SELECT o_orderkey, replace(flight_number, ' ', '') LIKE '%12%' OR upper(city) LIKE '%1 2%' OR city_code LIKE '%1 2%' AS by_text,
      contains(upper(city), 'NATION_1') AS by_city
    FROM v_board""")
def f29(t: Tables):
    cols = (F.col("flight_number"), F.col("city"), F.col("city_code"))
    return t.v_board.select(
        "o_orderkey", bd.board_match(" 1 2 ", *cols).alias("by_text"), bd.board_match("nation_1", *cols).alias("by_city")
    )


@query("f30_risk_band", ["v_board"], """
    SELECT o_orderkey, CASE WHEN p_delay >= 65e-2 THEN 'high' WHEN p_delay >= 35e-2 THEN 'medium' ELSE 'low' END AS band FROM v_board""")
def f30(t: Tables):
    return t.v_board.select("o_orderkey", bd.risk_band(F.col("p_delay")).alias("band"))
