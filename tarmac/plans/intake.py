"""Queries over payload readers, sinks and layers (S1-S14).

Payload texts are assembled from whole tables by Spark, read back by the readers, and
compared with values taken straight from the tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators import quality
from tarmac.plans.joining import airports
from tarmac.plans.registry import query
from tarmac.plans.views import T0, Tables
from tarmac.session import scratch_dir
from tarmac.sources import aircraft, faa, lake, ontime, states, weather

SWEEP = "CAST(FLOOR(event_id / 50) AS BIGINT)"


def landed(rows: DataFrame, per: int, joined) -> DataFrame:
    """Bodies of ``per`` consecutive events each; ``joined`` makes one text of the pieces."""
    sweep = F.expr(f"CAST(FLOOR(event_id / {per}) AS BIGINT)")
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("event_id", "piece"))), lambda x: x["piece"])
    return rows.groupBy(sweep.alias("sweep")).agg(pieces.alias("pieces"), F.min("ts").cast("timestamp").alias("ingested_at")).select(
        F.col("sweep").cast("string").alias("poll_id"), F.lit("KJFK").alias("airport"), "ingested_at", joined("pieces", F.col("sweep")).alias("body"),
    )


def state_bodies(t: Tables) -> DataFrame:
    def js(e: str) -> str:
        return f"coalesce({e}, 'null')"

    parts = [
        "'\"' || lpad(CAST(user_id AS STRING), 6, '0') || '\"'", "'\"E' || CAST(event_id AS STRING) || '  \"'", "'\"' || event_type || '\"'",
        js("CASE WHEN event_id % 6 > 0 THEN CAST(1704067200 + event_id AS STRING) END"), js("CASE WHEN event_id % 103 <> 4 THEN CAST(1704067200 + event_id AS STRING) END"),
        js("CAST(CAST(event_id % 360 - 180 AS DOUBLE) AS STRING)"), js("CASE WHEN event_id % 97 = 13 THEN '1234.5' ELSE CAST(CAST(event_id % 180 - 90 AS DOUBLE) AS STRING) END"),
        js("CASE WHEN event_id % 4 > 0 THEN CAST(value AS STRING) END"), "CASE WHEN event_id % 10 = 0 THEN 'true' ELSE 'false' END",
        "CAST(value AS STRING)", "CAST(event_id % 360 AS STRING)", "CAST(event_id % 21 - 10 AS STRING)",
        "CASE WHEN event_id % 5 = 0 THEN '[1,' || CAST(event_id AS STRING) || ']' ELSE 'null' END", "'null'", "'\"7700\"'", "'false'", "CAST(event_id % 4 AS STRING)",
    ]
    short, full = ", ".join(parts[:10]), ", ".join(parts)
    piece = (
        f"CASE WHEN event_id % 37 = 5 THEN '[' || concat_ws(',', {short}) || ']' "
        f"WHEN event_id % 41 = 2 THEN '[' || concat_ws(',', {full}, '3') || ']' ELSE '[' || concat_ws(',', {full}) || ']' END"
    )
    rows = t.table("events").withColumn("piece", F.expr(piece))
    return landed(
        rows, 50,
        lambda c, s: F.concat(F.lit('{"time":'), (F.lit(1704067200) + s).cast("string"), F.lit(',"states":['), F.concat_ws(",", c), F.lit("]}")),
    )


@query("s01_parse_states", [], f"""
    SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS icao24, 'E' || CAST(event_id AS VARCHAR) AS callsign, event_type AS origin_country,
      make_timestamp(CAST({T0} + {SWEEP} * 1000000 AS BIGINT)) AS response_time,
      CASE WHEN event_id % 6 > 0 THEN make_timestamp({T0} + event_id * 1000000) END AS time_position,
      CASE WHEN event_id % 103 <> 4 THEN make_timestamp({T0} + event_id * 1000000) END AS last_contact,
      CAST(event_id % 360 - 180 AS DOUBLE) AS longitude, CASE WHEN event_id % 97 = 13 THEN 12345e-1 ELSE CAST(event_id % 180 - 90 AS DOUBLE) END AS latitude,
      CASE WHEN event_id % 4 > 0 THEN value END AS baro_altitude_m, event_id % 10 = 0 AS on_ground, value AS velocity_ms,
      CASE WHEN event_id % 37 <> 5 THEN CAST(event_id % 360 AS DOUBLE) END AS true_track_deg,
      CASE WHEN event_id % 37 <> 5 AND event_id % 5 = 0 THEN event_id END AS second_sensor,
      CASE WHEN event_id % 37 <> 5 THEN '7700' END AS squawk, CASE WHEN event_id % 37 <> 5 THEN CAST(event_id % 4 AS INTEGER) END AS position_source,
      CASE WHEN event_id % 37 = 5 THEN 'elements,' ELSE '' END || CASE WHEN event_id % 103 = 4 THEN 'last_contact,' ELSE '' END
        || CASE WHEN event_id % 97 = 13 THEN 'latitude,' ELSE '' END || CASE WHEN event_id % 37 = 5 THEN 'spi,' ELSE '' END AS reasons
    FROM events""", ["longitude", "latitude", "baro_altitude_m", "velocity_ms", "true_track_deg"])
def s01(t: Tables):
    judged = quality.validate_states(states.parse_states(state_bodies(t)))
    return judged.select(
        "icao24", "callsign", "origin_country", "response_time", "time_position", "last_contact", "longitude", "latitude", "baro_altitude_m",
        "on_ground", "velocity_ms", "true_track_deg", F.try_element_at("sensors", F.lit(2)).alias("second_sensor"), "squawk", "position_source",
        F.concat_ws("", F.transform(F.sort_array(quality.REASONS), lambda r: F.concat(r, F.lit(",")))).alias("reasons"),
    )


METAR_PIECE = """to_json(named_struct('icaoId', CASE WHEN event_id % 61 <> 3 THEN 'K' || CAST(user_id AS STRING) END,
    'obsTime', CASE WHEN event_id % 53 <> 2 THEN 1704067200 + event_id END, 'rawOb', CASE WHEN event_id % 6 = 0 THEN 'X VRB03KT' ELSE 'X 27010KT' END,
    'temp', value, 'extra', 'ignored', 'wdir', CASE WHEN event_id % 6 = 0 THEN 'VRB' WHEN event_id % 6 = 1 THEN NULL ELSE CAST(event_id % 36 * 10 AS STRING) END,
    'wspd', event_id % 40, 'visib', CASE WHEN event_id % 3 = 0 THEN '10+' WHEN event_id % 3 = 1 THEN '1 1/2' ELSE '2.25' END,
    'fltCat', 'VFR', 'clouds', CASE WHEN event_id % 7 > 0 THEN array(named_struct('cover', 'FEW', 'base', 100), named_struct('cover', 'BKN', 'base', CAST(event_id % 90 AS INT))) END))"""


def metar_bodies(t: Tables) -> DataFrame:
    rows = t.table("events").withColumn("piece", F.expr(METAR_PIECE))
    single = F.expr("CAST(FLOOR(event_id / 20) AS BIGINT) % 5 = 0")
    lists = landed(rows.filter(~single), 20, lambda c, s: F.concat(F.lit("["), F.concat_ws(",", c), F.lit("]")))
    # A request for one station is answered by a bare object.
    bare = rows.filter(single).select(
        F.concat(F.lit("e"), "event_id").alias("poll_id"), F.lit("KJFK").alias("airport"), F.col("ts").cast("timestamp").alias("ingested_at"), F.col("piece").alias("body")
    )
    return lists.unionByName(bare)


@query("s02_parse_metar", [], """
    SELECT CASE WHEN event_id % 61 <> 3 THEN 'K' || CAST(user_id AS VARCHAR) END AS station,
      CASE WHEN event_id % 53 <> 2 THEN make_timestamp(1704067200000000 + event_id * 1000000) END AS obs_time, value AS temp_c,
      CASE WHEN event_id % 6 > 1 THEN CAST(event_id % 36 * 10 AS INTEGER) END AS wind_dir_deg, event_id % 6 = 0 AS wind_variable,
      CAST(event_id % 40 AS DOUBLE) AS wind_speed_kt, CASE event_id % 3 WHEN 0 THEN 1e1 WHEN 1 THEN 15e-1 ELSE 225e-2 END AS visibility_sm,
      CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 90 AS INTEGER) END AS ceiling_ft, CAST(CASE WHEN event_id % 7 > 0 THEN 2 ELSE 0 END AS INTEGER) AS layers
    FROM events""", ["temp_c", "wind_speed_kt", "visibility_sm"])
def s02(t: Tables):
    return weather.silver_metar(weather.parse_metar(metar_bodies(t))).select(
        "station", "obs_time", "temp_c", "wind_dir_deg", "wind_variable", "wind_speed_kt", "visibility_sm", "ceiling_ft", F.size("clouds").alias("layers")
    )


@query("q05_validate_weather", [], """
    SELECT CAST(event_id % 61 = 3 AS INTEGER) + 2 * CAST(event_id % 53 = 2 AS INTEGER) AS broken, count(*) AS n FROM events GROUP BY 1""")
def q05(t: Tables):
    judged = quality.validate_weather(weather.parse_metar(metar_bodies(t)))
    has = [F.array_contains(quality.REASONS, r).cast("int") for r in ("station", "obs_time")]
    return judged.groupBy((has[0] + 2 * has[1]).alias("broken")).agg(F.count("*").alias("n"))


TAF_PIECE = """to_json(named_struct('icaoId', 'K' || CAST(user_id AS STRING), 'validTimeFrom', 1704067200 + event_id * 60, 'validTimeTo', 1704067200 + event_id * 60 + 86400,
    'rawTAF', 'TAF ' || CAST(event_id AS STRING), 'fcsts', CASE WHEN event_id % 5 > 0 THEN array(
      named_struct('timeFrom', 1704067200 + event_id * 60, 'timeTo', 1704067200 + event_id * 60 + 3600, 'wdir', 'VRB', 'wspd', CAST(event_id % 30 AS STRING), 'visib', '6+', 'fcstChange', CAST(NULL AS STRING)),
      named_struct('timeFrom', 1704067200 + event_id * 60 + 3600, 'timeTo', CAST(NULL AS BIGINT), 'wdir', '270', 'wspd', CAST(NULL AS STRING), 'visib', '1/2', 'fcstChange', 'BECMG')) END))"""


def taf_bodies(t: Tables) -> DataFrame:
    rows = t.table("events").withColumn("piece", F.expr(TAF_PIECE))
    return landed(rows, 10, lambda c, s: F.concat(F.lit("["), F.concat_ws(",", c), F.lit("]")))


@query("s03_parse_taf", [], """
    SELECT 'TAF ' || CAST(event_id AS VARCHAR) AS raw_text, 'K' || CAST(user_id AS VARCHAR) AS station,
      make_timestamp(1704067200000000 + event_id * 60000000) AS valid_from, make_timestamp(1704153600000000 + event_id * 60000000) AS valid_to,
      CAST(CASE WHEN event_id % 5 > 0 THEN 2 ELSE 0 END AS INTEGER) AS n_periods FROM events""")
def s03(t: Tables):
    return weather.parse_taf(taf_bodies(t)).select("raw_text", "station", "valid_from", "valid_to", F.size("periods").alias("n_periods"))


@query("s04_explode_taf", [], """
    SELECT 'TAF ' || CAST(event_id AS VARCHAR) AS raw_text, CASE WHEN event_id % 5 > 0 THEN make_timestamp(1704067200000000 + (event_id * 60 + p * 3600) * 1000000) END AS time_from,
      CASE WHEN p = 0 AND event_id % 5 > 0 THEN make_timestamp(1704067200000000 + (event_id * 60 + 3600) * 1000000) END AS time_to,
      CASE WHEN event_id % 5 > 0 AND p = 1 THEN 270 END AS wind_dir_deg, CASE WHEN event_id % 5 > 0 AND p = 0 THEN CAST(event_id % 30 AS DOUBLE) END AS wind_speed_kt,
      CASE WHEN event_id % 5 = 0 THEN NULL WHEN p = 0 THEN 6e0 ELSE 5e-1 END AS visibility_sm, CASE WHEN event_id % 5 > 0 AND p = 1 THEN 'BECMG' END AS change_indicator,
      CASE WHEN event_id % 5 = 0 THEN NULL WHEN p = 0 THEN 0 ELSE 3 END AS severity
    FROM events JOIN (SELECT unnest([0, 1]) AS p) ps ON p = 0 OR event_id % 5 > 0""", ["wind_speed_kt", "visibility_sm"])
def s04(t: Tables):
    return weather.explode_taf(weather.parse_taf(taf_bodies(t))).select(
        "raw_text", "time_from", "time_to", "wind_dir_deg", "wind_speed_kt", "visibility_sm", "change_indicator", "severity"
    )


def faa_bodies(t: Tables) -> DataFrame:
    arpt = "CASE WHEN event_id % 17 = 4 THEN '' WHEN event_id % 3 = 0 THEN '<ARPT>jfk</ARPT>' ELSE '<Arpt> EWR </Arpt>' END"
    # Shapes that mislead a reader of plain text: commented-out sections, attributes, character data, children with children.
    reason = "'<Reason lang=\"en\"><![CDATA[r' || CAST(event_id AS STRING) || ']]></Reason>'"
    note = "'<Detail><Item><Text>a &gt; b</Text></Item></Detail>'"
    hidden = "'<!-- <Delay_type><Name>Airport Closures</Name><X><ARPT>LAX</ARPT></X></Delay_type> -->'"
    piece = f"""CASE event_id % 4
        WHEN 0 THEN {hidden} || '<Delay_type kind="x > y"><Name>Ground Stop Programs</Name><Ground_Stop_List><Program>' || {note} || {arpt} || {reason} || '<End_Time>18:00</End_Time></Program></Ground_Stop_List></Delay_type>'
        WHEN 1 THEN '<Delay_type><Name a="b">Ground Delay Programs</Name><Ground_Delay_List><Deep><Deeper><Ground_Delay>' || {arpt} || {reason} || '<Avg>45 minutes</Avg></Ground_Delay></Deeper></Deep></Ground_Delay_List></Delay_type>'
        WHEN 2 THEN '<Delay_type><Name>Airport Closures</Name><Airport_Closure_List><Airport>' || {arpt} || {reason} || '<Start>Aug 08 at 02:00 UTC.</Start><Reopen>x</Reopen></Airport><Airport><ARPT>ORD</ARPT>' || {reason} || '<Start> </Start></Airport></Airport_Closure_List></Delay_type>'
        ELSE '<Delay_type><Name>Volcano Watch</Name><Ground_Stop_List><Program>' || {arpt} || {reason} || '</Program></Ground_Stop_List></Delay_type>' END"""
    rows = t.table("events").withColumn("piece", F.expr(piece))
    return landed(
        rows, 10,
        lambda c, s: F.concat(F.lit('<?xml version="1.0"?><AIRPORT_STATUS_INFORMATION><Update_Time>now</Update_Time>'), F.concat_ws("", c), F.lit("</AIRPORT_STATUS_INFORMATION>")),
    )


@query("s05_parse_faa", [], """
    SELECT 'r' || CAST(event_id AS VARCHAR) AS reason, CASE WHEN second THEN 'ORD' WHEN event_id % 3 = 0 THEN 'JFK' ELSE 'EWR' END AS airport,
      CASE event_id % 4 WHEN 0 THEN 'ground_stop' WHEN 1 THEN 'ground_delay' ELSE 'closure' END AS event_type,
      CASE WHEN event_id % 4 = 2 AND NOT second THEN 'Aug 08 at 02:00 UTC.' END AS start_text,
      CASE WHEN event_id % 4 = 0 THEN '18:00' WHEN event_id % 4 = 2 AND NOT second THEN 'x' END AS end_text,
      CASE WHEN event_id % 4 = 1 THEN '45 minutes' END AS avg_delay_text, TRUE AS fragment_is_own
    FROM events JOIN (SELECT unnest([FALSE, TRUE]) AS second) s ON (NOT second AND event_id % 17 <> 4) OR (second AND event_id % 4 = 2) WHERE event_id % 4 < 3""")
def s05(t: Tables):
    e = faa.parse_faa(faa_bodies(t))
    code = F.when(F.col("airport") == "JFK", "<ARPT>jfk</ARPT>").when(F.col("airport") == "ORD", "<ARPT>ORD</ARPT>").otherwise("<Arpt> EWR </Arpt>")
    own = F.contains("raw_xml", F.concat(F.lit('<Reason lang="en">'), "reason", F.lit("</Reason>"))) & F.contains("raw_xml", code)
    return e.select("reason", "airport", "event_type", "start_text", "end_text", "avg_delay_text", F.coalesce(own, F.lit(False)).alias("fragment_is_own"))


@query("s05_unseen_records", [], "SELECT count(*) FILTER (WHERE event_id % 4 = 3 AND event_id % 17 <> 4) AS missed FROM events")
def s05_unseen(t: Tables):
    # The unknown section's airports are the only ones that are named and not read.
    bodies = faa_bodies(t)
    return faa.unseen_records(bodies, faa.parse_faa(bodies)).agg(F.coalesce(F.sum(F.col("named") - F.col("parsed")), F.lit(0)).alias("missed"))


@query("s06_parse_aircraft", ["v_register"], r"""
    SELECT lower(trim(icao24)) AS icao24, nullif(trim(reg, chr(39)), '') AS registration, nullif(trim(icaoaircrafttype), '') AS typecode, model,
      trim(manufacturername) AS manufacturer, nullif(trim(operator), '') AS operator, CAST(NULL AS VARCHAR) AS operator_icao,
      CASE WHEN TRY_CAST(left(trim(built), 4) AS INTEGER) BETWEEN 1900 AND 2100 THEN TRY_CAST(left(trim(built), 4) AS INTEGER) END AS built
    FROM v_register WHERE trim(icao24) <> ''""")
def s06(t: Tables):
    path = scratch_dir(t.spark, "register")
    t.v_register.write.option("header", True).option("escape", '"').csv(path)
    return aircraft.read_aircraft(t.spark, path)


@query("s07_read_ontime", ["v_ontime"], "SELECT 'K' || airport AS airport, scheduled, actual FROM v_ontime WHERE airport <> 'LAX'")
def s07(t: Tables):
    path = scratch_dir(t.spark, "ontime")
    t.v_ontime.select("airport", "scheduled", "actual").write.option("header", True).csv(path)
    return ontime.read_ontime(t.spark, path, airports(t), local_clock=False)


@query("s08_flights_by_airport", ["v_flight"], """
    SELECT 'arrival' AS direction, icao24, callsign, first_seen, last_seen FROM v_flight WHERE arrival_airport = 'KJFK' AND last_seen BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-05 18:00:00'
    UNION ALL SELECT 'departure', icao24, callsign, first_seen, last_seen FROM v_flight WHERE departure_airport = 'KEWR' AND first_seen BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-05 23:59:59'""")
def s08(t: Tables):
    cols = ("icao24", "callsign", "first_seen", "last_seen")
    a = ontime.flights_by_airport(t.v_flight, "KJFK", datetime(2024, 1, 5, 6), datetime(2024, 1, 5, 18))
    d = ontime.flights_by_airport(t.v_flight, "KEWR", datetime(2024, 1, 5), datetime(2024, 1, 5, 23, 59, 59), "departure")
    return a.select(F.lit("arrival").alias("direction"), *cols).unionByName(d.select(F.lit("departure").alias("direction"), *cols))


def drawn_together(ts: str) -> Column:
    """A month of times as half a day, so that layers have a dozen hours and not seven hundred."""
    return F.timestamp_micros((F.lit(T0) + (F.unix_micros(ts) - F.lit(T0)) / 60).cast("bigint"))


def sightings(t: Tables) -> DataFrame:
    """All events as program notices, the month drawn together into half a day."""
    at = drawn_together("ingested_at")
    empty = F.lit(None).cast("string")
    return t.v_program.select(
        F.col("event_id").cast("string").alias("poll_id"), at.alias("ingested_at"), F.md5(F.col("event_id").cast("string")).alias("payload_hash"), "airport", "event_type",
        *[empty.alias(c) for c in ("reason", "start_text", "end_text", "avg_delay_text", "raw_xml")],
    )


_AT = f"make_timestamp(CAST({T0} + trunc((epoch_us(ingested_at) - {T0}) / 60) AS BIGINT))"
_HOURS = f"(SELECT event_id, airport, event_type, {_AT} AS seen_at FROM v_program)"


@query("s09_append_bronze", ["v_program"], f"""
    SELECT strftime(seen_at, '%Y-%m-%d') AS date, strftime(seen_at, '%H') AS hour, count(*) AS n_rows, CAST((SELECT count(*) FROM v_program) AS BIGINT) AS reported, TRUE AS grew FROM {_HOURS} h GROUP BY 1, 2""")
def s09(t: Tables):
    root = scratch_dir(t.spark, "bronze")
    early = F.col("event_type").isin("ground_stop", "closure")
    one = lake.append_bronze(sightings(t).filter(early), root, "faa_status")
    none = lake.append_bronze(sightings(t).filter(F.lit(False)), root, "faa_status")
    two = lake.append_bronze(sightings(t).filter(~early), root, "faa_status")
    rows = lake.read_layer(t.spark, root, "faa_status")
    return rows.groupBy("date", "hour").agg(F.count("*").alias("n_rows")).withColumns(
        {"reported": F.lit(one.rows + none.rows + two.rows).cast("bigint"), "grew": F.lit(one.bytes > 0 and two.bytes > 0 and none.bytes == 0)}
    )


@query("s10_replace_reference", ["v_register"], """
    SELECT lower(trim(icao24)) AS icao24, count(*) AS n FROM v_register WHERE trim(icao24) <> '' GROUP BY 1""")
def s10(t: Tables):
    path = scratch_dir(t.spark, "reference")
    table = aircraft.parse_aircraft(t.v_register)
    lake.replace_reference(table.filter("built is null"), path)
    lake.replace_reference(table, path)
    return lake.read_reference(t.spark, path).groupBy("icao24").agg(F.count("*").alias("n"))


@query("s11_read_layer", ["v_program"], f"""
    SELECT event_type, strftime(seen_at, '%H') AS hour, count(*) AS n FROM {_HOURS} h WHERE seen_at >= TIMESTAMP '2024-01-01 02:30:00' AND seen_at < TIMESTAMP '2024-01-01 07:10:00' GROUP BY 1, 2""")
def s11(t: Tables):
    root = scratch_dir(t.spark, "layer")
    lake.append_bronze(sightings(t), root, "faa_status")
    part = lake.read_layer(t.spark, root, "faa_status", datetime(2024, 1, 1, 2, 30), datetime(2024, 1, 1, 7, 10))
    return part.groupBy("event_type", "hour").agg(F.count("*").alias("n"))


@query("s12_views_by_day", ["v_program"], f"SELECT strftime(seen_at, '%Y-%m-%d') AS date, count(*) AS n_rows FROM {_HOURS} h GROUP BY 1")
def s12(t: Tables):
    root = scratch_dir(t.spark, "views")
    lake.append_bronze(sightings(t), root, "faa_status")
    lake.register_views(t.spark, root, ["faa_status"])
    return t.spark.sql("SELECT date, n_rows FROM faa_status_by_day")


@query("s13_compact", ["v_program"], f"""
    SELECT strftime(seen_at, '%H') AS hour, airport, count(*) AS n_rows, TRUE AS fewer_files, CAST((SELECT count(*) FROM v_program) AS BIGINT) AS compacted FROM {_HOURS} h GROUP BY 1, 2""")
def s13(t: Tables):
    root = scratch_dir(t.spark, "small-files")
    for code in ("JFK", "EWR", "ORD"):
        lake.append_bronze(sightings(t).filter(F.col("airport") == code), root, "faa_status")
    done = lake.compact(t.spark, root, "faa_status", "2024-01-01", now=datetime(2024, 1, 3))
    return lake.read_layer(t.spark, root, "faa_status").groupBy("hour", "airport").agg(F.count("*").alias("n_rows")).withColumns(
        {"fewer_files": F.lit(done["files_after"] < done["files_before"]), "compacted": F.lit(done["rows"]).cast("bigint")}
    )


_CAND = """(SELECT CASE WHEN s_suppkey % 13 = 4 THEN 'bad' ELSE 'K' || chr(CAST(65 + s_suppkey % 26 AS INT)) || chr(CAST(65 + s_suppkey % 25 AS INT)) || chr(CAST(65 + s_suppkey % 7 AS INT)) END AS icao,
      s_name AS name, CASE WHEN s_suppkey % 11 = 3 THEN 91e0 ELSE CAST(s_suppkey % 90 AS DOUBLE) END AS lat, CAST(s_suppkey % 360 - 180 AS DOUBLE) AS lon, 'KJFK' AS metar_station,
      CASE WHEN s_suppkey % 7 = 1 THEN 'x' ELSE 'A1B' END AS faa_code FROM {supplier})"""


@query("s14_check_airports", [], f"""
    WITH c AS (SELECT * FROM {_CAND.replace('{supplier}', 'supplier')} s)
    SELECT icao, problem, count(*) AS n FROM (
      SELECT icao, 'icao' AS problem FROM c WHERE icao = 'bad' UNION ALL SELECT icao, 'lat' FROM c WHERE lat > 90 UNION ALL SELECT icao, 'faa_code' FROM c WHERE faa_code = 'x'
      UNION ALL SELECT icao, 'duplicate' FROM c GROUP BY icao HAVING count(*) > 1) p GROUP BY ALL""")
def s14(t: Tables):
    c = t.spark.sql(f"SELECT * FROM {_CAND} s", supplier=t.table("supplier"))
    return quality.check_airports(c).groupBy("icao", "problem").agg(F.count("*").alias("n"))


@query("k01_sorted_files", ["v_program"], f"""
    SELECT strftime(seen_at, '%H') AS hour, count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM {_HOURS} h GROUP BY 1""")
def k01(t: Tables):
    root = scratch_dir(t.spark, "sorted")
    lake.append_bronze(sightings(t), root, "faa_status")
    # Position in the file against position in time, file by file.
    w = Window.partitionBy("__file").orderBy("__at")
    placed = lake.read_layer(t.spark, root, "faa_status").select(
        "hour", "ingested_at", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")
    )
    late = placed.withColumn("__bad", F.col("ingested_at") < F.lag("ingested_at").over(w))
    return late.groupBy("hour").agg(F.count("*").alias("n"), F.count_if("__bad").alias("out_of_order"))
