"""Pinned table schemas. Nothing in the package infers or merges a schema.

The column names, order and types below are fixed values: stored tables must keep
unioning with batches written weeks earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_CLOUDS = "array<struct<cover:string,base_ft:int>>"

_DDL = {
    "states": (
        "poll_id string, airport string, ingested_at timestamp, payload_hash string, "
        "response_time timestamp, icao24 string, callsign string, origin_country string, "
        "time_position timestamp, last_contact timestamp, longitude double, latitude double, "
        "baro_altitude_m double, geo_altitude_m double, on_ground boolean, velocity_ms double, "
        "true_track_deg double, vertical_rate_ms double, sensors array<bigint>, squawk string, "
        "spi boolean, position_source int"
    ),
    "metar": (
        "poll_id string, ingested_at timestamp, payload_hash string, station string, "
        "obs_time timestamp, raw_text string, temp_c double, dewpoint_c double, "
        "wind_dir_deg int, wind_variable boolean, wind_speed_kt double, wind_gust_kt double, "
        "visibility_sm double, altimeter_hpa double, wx_string string, flight_category string, "
        f"clouds {_CLOUDS}"
    ),
    "taf": (
        "poll_id string, ingested_at timestamp, payload_hash string, station string, "
        "valid_from timestamp, valid_to timestamp, raw_text string, "
        "periods array<struct<time_from:timestamp,time_to:timestamp,change_indicator:string,"
        "wind_dir_deg:int,wind_speed_kt:double,wind_gust_kt:double,visibility_sm:double,"
        f"wx_string:string,clouds:{_CLOUDS}>>"
    ),
    "faa_status": (
        "poll_id string, ingested_at timestamp, payload_hash string, airport string, "
        "event_type string, reason string, start_text string, end_text string, "
        "avg_delay_text string, raw_xml string"
    ),
    "aircraft": (
        "icao24 string, registration string, typecode string, model string, "
        "manufacturer string, operator string, operator_icao string, built int"
    ),
    "airports": (
        "icao string, name string, lat double, lon double, metar_station string, "
        "faa_code string, elev_ft double, tz string"
    ),
    "runways": "icao string, heading_deg double",
    "poll_log": (
        "poll_id string, source string, airport string, started_at timestamp, ok boolean, "
        "error_type string, attempts int, rows_written bigint, nationwide int, matched int, "
        "duration_seconds double, credits_remaining int"
    ),
    "ontime": "airport string, scheduled timestamp, actual timestamp",
    "predictions": "airport string, ts timestamp, p_delay double, model_version string",
    # What was not accepted: a row as JSON, or a body as it came.
    "quarantine": "poll_id string, ingested_at timestamp, source string, reasons array<string>, row string",
    # What lands before parsing: one row per response body.
    "landing": (
        "poll_id string, airport string, ingested_at timestamp, body string"
    ),
}

class _Schemas(dict[str, StructType]):
    """Parsed on first use: reading DDL needs a running session."""

    def __missing__(self, name: str) -> StructType:
        self[name] = StructType.fromDDL(_DDL[name])
        return self[name]

    def __contains__(self, name: object) -> bool:
        return name in _DDL


SCHEMAS = _Schemas()


def ddl(name: str) -> str:
    return _DDL[name]


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the pinned columns in order and fail when a type or name differs."""
    want = SCHEMAS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: want {f.dataType.simpleString()}, have "
        f"{have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in want.fields
        if f.name not in have or have[f.name].simpleString() != f.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{name} does not match its schema: {'; '.join(wrong)}")
    return df.select(*[f.name for f in want.fields])
