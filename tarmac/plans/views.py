"""Aviation-shaped views over the given tables.

The tables hold no aviation data, so each view is a deterministic projection of whole
tables, written once in SQL that Spark and DuckDB both read. Two function names differ
between them and are swapped by ``_DIALECT``. Braces mark base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_DIALECT = {"TS_OF(": ("timestamp_micros(", "make_timestamp("), "US_OF(": ("unix_micros(", "epoch_us(")}

# Airport reference points by number 0..2, as in the airport dimension.
_ICAO = "CASE {n} WHEN 0 THEN 'KJFK' WHEN 1 THEN 'KEWR' ELSE 'KORD' END"
_FAA = "CASE {n} WHEN 0 THEN 'JFK' WHEN 1 THEN 'EWR' ELSE 'ORD' END"
_LAT = "CASE {n} WHEN 0 THEN 406398e-4 WHEN 1 THEN 406925e-4 ELSE 419786e-4 END"
_LON = "CASE {n} WHEN 0 THEN -737789e-4 WHEN 1 THEN -741687e-4 ELSE -879048e-4 END"
_ELEV = "CASE {n} WHEN 0 THEN 13e0 WHEN 1 THEN 18e0 ELSE 672e0 END"


def icao(n: str) -> str:
    return _ICAO.replace("{n}", n)


def faa(n: str) -> str:
    return _FAA.replace("{n}", n)


def lat(n: str) -> str:
    return _LAT.replace("{n}", n)


def lon(n: str) -> str:
    return _LON.replace("{n}", n)


def elev(n: str) -> str:
    return _ELEV.replace("{n}", n)


def pick(expr: str, values: list[str | None]) -> str:
    """CASE over ``expr % len(values)``; values are SQL text, None is NULL."""
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else v}" for i, v in enumerate(values)
    )
    return f"CASE ({expr}) % {len(values)} {arms} END"


def q(s: str) -> str:
    return f"'{s}'"


# 2024-01-01 00:00:00 UTC in microseconds.
T0 = 1_704_067_200_000_000
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

VISIBILITY = ["10+", "10", "3.5", "6+", "1/2", "1 1/2", "1/4", "10SM", "unknown", None, "10+SM", "P6SM", "3/0", "nan"]

# Delayed or not, in step with the score of the first model.
_OUTCOME = (
    "CASE WHEN event_id % 131 = 1 THEN NULL "
    "WHEN (event_id * 104729) % 1000 < (event_id * 7919) % 1000 THEN 1 ELSE 0 END"
)

VIEWS: dict[str, str] = {
    # Typed state reports around the airports, some of them faulty.
    "v_obs": f"""
        SELECT event_id,
          CASE WHEN event_id % 101 = 3 THEN 'zz' || CAST(user_id AS STRING)
               ELSE lpad(CAST(user_id AS STRING), 6, '0') END AS icao24,
          CASE WHEN event_id % 11 = 0 THEN '   ' ELSE 'FLT' || CAST(event_id % 97 AS STRING) || '  ' END AS callsign,
          CASE WHEN event_id % 103 = 4 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS last_contact,
          CAST(ts AS TIMESTAMP) AS ts,
          CASE WHEN event_id % 97 = 13 THEN 12345e-1 WHEN event_id % 113 = 5 THEN NULL
               ELSE {lat('user_id % 3')} + ((event_id % 41) - 20) * 6e-2 END AS latitude,
          CASE WHEN event_id % 113 = 5 THEN NULL
               ELSE {lon('user_id % 3')} + ((event_id % 53) - 26) * 6e-2 END AS longitude,
          value * 1e2 - 5e1 AS baro_altitude_m,
          CASE WHEN event_id % 107 = 9 THEN NULL ELSE event_id % 10 = 0 END AS on_ground,
          CASE WHEN event_id % 89 = 7 THEN -1e0 ELSE value END AS velocity_ms,
          CASE WHEN event_id % 83 = 5 THEN 3615e-1 ELSE CAST(event_id % 361 AS DOUBLE) END AS true_track_deg,
          CAST((event_id % 21) - 10 AS DOUBLE) AS vertical_rate_ms,
          event_id % 19 = 0 AS spi,
          CAST(event_id % 7 AS DOUBLE) * 40 AS wind_speed_kt
        FROM {{events}}
    """,
    # Repeated sightings: coarse content, so many rows say the same thing.
    "v_bronze": f"""
        SELECT 'p' || CAST(event_id AS STRING) AS poll_id,
          {icao('event_id % 3')} AS airport, CAST(ts AS TIMESTAMP) AS ingested_at,
          lpad(CAST(user_id AS STRING), 6, '0') AS icao24, event_type AS origin_country,
          CASE WHEN value < 5 THEN NULL ELSE CAST(FLOOR(value / 25) AS INT) END AS level
        FROM {{events}}
    """,
    # Flights of 200 points in eight shapes; see the comment on each.
    "v_track": f"""
        SELECT trk, k, shape, lpad(CAST(trk AS STRING), 6, '0') AS icao24,
          {icao('trk % 3')} AS airport,
          TS_OF({T0} + (trk * 20000 + k * (CASE WHEN shape = 7 THEN 90 ELSE 30 END)) * 1000000) AS last_contact,
          {lat('trk % 3')} + dist / 6e1 AS latitude, {lon('trk % 3')} AS longitude,
          (alt + {elev('trk % 3')}) * 3048e-4 AS baro_altitude_m, CAST(NULL AS DOUBLE) AS geo_altitude_m,
          alt AS agl, vr AS vertical_rate_ms, hdg AS true_track_deg,
          ground AS on_ground, 7e1 + (trk % 20) AS velocity_ms
        FROM (
          SELECT trk, k, shape,
            CASE -- distance: approaches pass over the field at k = 68, holds stay at 20 nm
              WHEN shape IN (1, 3, 5, 7) THEN 2e1 ELSE 35e-2 * abs(68 - k) END AS dist,
            CASE -- 0 go-around, 4 touch-and-go, 6 climb that regains too little, 2 landing
              WHEN shape IN (1, 3, 5, 7) THEN 7e3
              WHEN k < 40 THEN 8e3
              WHEN shape = 2 THEN greatest(8e3 - 25e1 * (k - 40), 0e0)
              WHEN shape = 4 AND k < 72 THEN 8e3 - 25e1 * (k - 40)
              WHEN shape = 4 AND k < 74 THEN 0e0
              WHEN shape = 4 AND k < 86 THEN 6e2 * (k - 74)
              WHEN shape = 4 THEN 72e2
              WHEN k < 68 THEN 8e3 - 25e1 * (k - 40)
              WHEN shape = 6 THEN 125e1 + 2e2 * least(k - 68, 3)
              WHEN k < 80 THEN 125e1 + 6e2 * (k - 68)
              ELSE 845e1 END AS alt,
            CASE
              WHEN shape IN (1, 3, 5, 7) OR k < 40 THEN 0e0
              WHEN shape = 2 THEN CASE WHEN k < 72 THEN -254e-2 ELSE 0e0 END
              WHEN shape = 4 THEN CASE WHEN k < 72 THEN -254e-2 WHEN k < 74 THEN 0e0 WHEN k < 86 THEN 6e0 ELSE 0e0 END
              WHEN k < 68 THEN -254e-2
              WHEN shape = 6 THEN CASE WHEN k < 72 THEN 52e-1 ELSE 0e0 END
              WHEN k < 80 THEN 6096e-3 ELSE 0e0 END AS vr,
            CASE -- 1 circling hold, 3 racetrack, 5 S-turns, 7 circling seen too rarely
              WHEN shape IN (1, 7) AND k BETWEEN 50 AND 90 THEN CAST((90 * k) % 360 AS DOUBLE)
              WHEN shape = 3 AND k BETWEEN 40 AND 110 THEN
                CASE (k - 40) % 6 WHEN 0 THEN 0e0 WHEN 1 THEN 0e0 WHEN 2 THEN 9e1 WHEN 3 THEN 18e1 WHEN 4 THEN 18e1 ELSE 27e1 END
              WHEN shape = 5 AND k BETWEEN 40 AND 110 THEN CASE WHEN k % 2 = 0 THEN 9e1 ELSE 18e1 END
              ELSE 18e1 END AS hdg,
            CASE WHEN shape = 2 THEN k >= 72 WHEN shape = 4 THEN k BETWEEN 72 AND 73 ELSE FALSE END AS ground
          FROM (
            SELECT CAST(FLOOR(event_id / 200) AS BIGINT) AS trk, event_id % 200 AS k,
              CAST(FLOOR(event_id / 200) AS BIGINT) % 8 AS shape
            FROM {{events}}
          ) a
        ) b
    """,
    "v_metar": f"""
        SELECT event_id, {icao('user_id % 3')} AS station, CAST(ts AS TIMESTAMP) AS obs_time,
          CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST((event_id * 10) % 360 AS INT) END AS wind_dir_deg,
          CAST(event_id % 45 AS DOUBLE) AS wind_speed_kt,
          CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 45 + 10 AS DOUBLE) END AS wind_gust_kt,
          {pick('event_id', ['1e1', '6e0', '4e0', '2e0', '5e-1', '1e1', '1e1', '25e-1', 'CAST(NULL AS DOUBLE)', '8e0'])} AS visibility_sm,
          CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST((event_id % 60) * 100 AS INT) END AS ceiling_ft,
          {pick('event_id', [q('VFR'), q('MVFR'), q('IFR'), q('LIFR')])} AS flight_category,
          {pick('event_id', [q('-RA'), q('BR'), None, q('+SN'), q('HZ'), q('TSRA'), q('FG')])} AS wx_string,
          1e3 + (event_id % 40) AS altimeter_hpa
        FROM {{events}}
    """,
    "v_period": f"""
        SELECT event_id, {icao('user_id % 3')} AS airport, CAST(ts AS TIMESTAMP) AS issued_at,
          TS_OF(US_OF(CAST(ts AS TIMESTAMP)) + 1800000000) AS time_from,
          TS_OF(US_OF(CAST(ts AS TIMESTAMP)) + 1800000000 + (event_id % 4) * 3600000000) AS time_to,
          CAST(event_id % 4 AS INT) AS severity
        FROM {{events}}
    """,
    "v_program": f"""
        SELECT event_id, {faa('user_id % 3')} AS airport,
          CASE event_type WHEN 'error' THEN 'ground_stop' WHEN 'view' THEN 'ground_delay'
            WHEN 'click' THEN 'closure' WHEN 'signup' THEN 'airspace_flow' ELSE 'deicing' END AS event_type,
          CAST(ts AS TIMESTAMP) AS ingested_at
        FROM {{events}}
    """,
    "v_poll": f"""
        SELECT lpad(CAST(event_id AS STRING), 12, '0') AS poll_id, event_type AS source,
          {icao('user_id % 3')} AS airport, CAST(ts AS TIMESTAMP) AS started_at,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) >= 15 AS ok,
          CAST(1 + event_id % 3 AS INT) AS attempts,
          CAST(CASE WHEN event_id % 6 = 0 THEN 0 ELSE event_id % 400 END AS BIGINT) AS rows_written,
          CAST(event_id % 30 + 5 AS INT) AS nationwide, CAST(event_id % 5 AS INT) AS matched,
          value AS duration_seconds,
          CAST(CASE WHEN event_id % 50 = 0 THEN (event_id * 7) % 650 - 20 END AS INT) AS credits_remaining
        FROM {{events}}
    """,
    "v_ontime": f"""
        SELECT airport, scheduled_us, delay_min,
          TS_OF(scheduled_us) AS scheduled, TS_OF(scheduled_us + delay_min * 60000000) AS actual
        FROM (
          SELECT CASE l_suppkey % 4 WHEN 0 THEN 'JFK' WHEN 1 THEN 'EWR' WHEN 2 THEN 'ORD' ELSE 'LAX' END AS airport,
            {T0} + ((o_custkey % 60) * 1440 + (l_orderkey * 7 + l_linenumber * 13) % 1440) * 60000000 AS scheduled_us,
            CAST(FLOOR((US_OF(CAST(l_shipdate AS TIMESTAMP)) - US_OF(CAST(o_orderdate AS TIMESTAMP))) / 86400000000) AS BIGINT) % 97 - 20 AS delay_min
          FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
        ) x
    """,
    # The register as text, with repeated keys and faulty cells.
    "v_register": f"""
        SELECT CASE WHEN c_custkey % 41 = 7 THEN ' ' ELSE lpad(CAST(c_custkey % 4000 AS STRING), 6, '0') END AS icao24,
          chr(39) || c_name || chr(39) AS reg,
          {pick('c_custkey', [q('B77W'), q('A320'), q('A359'), q('B738'), q(' '), q('E190'), q('B789')])} AS icaoaircrafttype,
          c_mktsegment AS model, ' ' || c_mktsegment || ' ' AS manufacturername,
          {pick('c_custkey', [q('Delta'), None, q('  '), q('United')])} AS operator,
          {pick('c_custkey', [q('2011'), q('2011-05-14'), q(''), q('n/a'), q('0003'), 'CAST(1950 + c_custkey % 75 AS STRING)', q(' 1999 ')])} AS built
        FROM {{customer}}
    """,
    "v_board": f"""
        SELECT o_orderkey,
          {pick('o_orderkey', [q('scheduled'), q('boarding'), q('delayed'), q('en-route'), q('departed'), q('landed'), q('cancelled')])} AS status,
          TS_OF({T0} + (o_orderkey % 2880) * 60000000) AS scheduled,
          {icao('o_custkey % 3')} AS airport,
          substr(o_orderpriority, 3, 2) || ' ' || CAST(o_orderkey % 9973 AS STRING) AS flight_number,
          substr(o_orderpriority, 1, 1) || substr(o_orderpriority, 3, 1) AS airline_code,
          o_orderpriority AS airline_name, 'City ' || n_name AS city,
          upper(substr(n_name, 1, 1)) || lpad(CAST(n_nationkey AS STRING), 2, '0') AS city_code,
          CAST(o_orderkey % 101 AS DOUBLE) / 100 AS p_delay
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
    """,
    "v_flight": f"""
        SELECT lpad(CAST(user_id AS STRING), 6, '0') AS icao24, CAST(ts AS TIMESTAMP) AS first_seen,
          {icao('user_id % 3')} AS departure_airport,
          TS_OF(US_OF(CAST(ts AS TIMESTAMP)) + 5400000000) AS last_seen,
          CASE WHEN event_id % 9 = 0 THEN NULL ELSE {icao('event_id % 3')} END AS arrival_airport,
          'FLT' || CAST(event_id % 97 AS STRING) AS callsign
        FROM {{events}}
    """,
    # Two model versions scoring the same rows; the outcome follows the score of the first.
    "v_scored": f"""
        SELECT airport, ts, model_version, p_delay, target FROM (
          SELECT event_id, {icao('user_id % 3')} AS airport, CAST(ts AS TIMESTAMP) AS ts, 'v1' AS model_version,
            CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000 AS p_delay, {_OUTCOME} AS target FROM {{events}}
          UNION ALL
          SELECT event_id, {icao('user_id % 3')} AS airport, CAST(ts AS TIMESTAMP) AS ts, 'v2' AS model_version,
            CAST((event_id * 7919 + 13) % 1000 AS DOUBLE) / 2000 + CAST((event_id * 7919) % 1000 AS DOUBLE) / 2000 AS p_delay,
            {_OUTCOME} AS target FROM {{events}}
        ) x
    """,
    # Ragged text of every kind the readers must survive.
    "v_text": f"""
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, value,
          {pick('event_id', ['CAST(1700000000 + event_id AS STRING)', q('true'), q('abc'), None, 'CAST(1700000000 + event_id AS STRING) || chr(46) || chr(53)'])} AS epoch_text,
          {pick('event_id', [q('QXA17K  '), q('   '), 'chr(9) || CAST(event_id AS STRING) || chr(10)', None])} AS callsign_text,
          {pick('event_id', [None if v is None else q(v) for v in VISIBILITY])} AS vis_text,
          {pick('event_id', [q('VRB'), q(' vrb '), q('270'), q('090'), None, q('360')])} AS wdir_text,
          {pick('event_id', [q('KJFK VRB04KT 10SM'), q('KJFK 27010KT'), None])} AS raw_text,
          {pick('event_id', ['chr(39) || event_type || chr(39)', 'chr(34) || chr(32) || event_type || chr(34)', q('  '), 'chr(32) || event_type', None])} AS quoted_text,
          {pick('event_id', [q('2011'), q('2011-05-14'), q(''), q('n/a'), q('0003'), 'CAST(1880 + event_id % 250 AS STRING)', None])} AS built_text,
          {pick('event_id', [q('Ground Stop Programs'), q('Ground Delay Programs'), q('Airport Closures'), q('Airspace Flow Programs'), q('Arrival/Departure Delays'), q('Deicing'), q('Volcano Watch'), None])} AS section,
          {pick('event_id', [q('-RA'), q('+SN'), q('BR'), q('HZ'), None, q('TSRA'), q('FZDZ')])} AS wx_string,
          {pick('event_id', [q('45 minutes'), q('1 hour and 15 minutes'), q('2 hours'), None, q('unknown'), "CAST(event_id % 90 AS STRING) || ' min'"])} AS delay_text,
          '!SEA 11/042 CLSD 555-010-0147 ' || '26' || lpad(CAST(1 + event_id % 12 AS STRING), 2, '0') || lpad(CAST(1 + event_id % 28 AS STRING), 2, '0')
            || lpad(CAST(event_id % 24 AS STRING), 2, '0') || '26-27' || lpad(CAST(1 + event_id % 12 AS STRING), 2, '0') || '281600' AS notam_text,
          substr('{MONTHS}', CAST(1 + 3 * (event_id % 12) AS INT), 3) || ' ' || lpad(CAST(1 + event_id % 28 AS STRING), 2, '0')
            || ' at ' || lpad(CAST(event_id % 24 AS STRING), 2, '0') || ':30 UTC.' AS notice_text
        FROM {{events}}
    """,
}


def _sql(name: str, dialect: int) -> str:
    text = VIEWS[name]
    for token, forms in _DIALECT.items():
        text = text.replace(token, forms[dialect])
    return text


def duck_sql(name: str) -> str:
    return _sql(name, 1).format(**{t: t for t in TABLES})


class Tables:
    """The given tables of one directory, and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = _sql(name, 0)
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_"):
            return self.view(name)
        raise AttributeError(name)
