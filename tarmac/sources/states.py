"""Aircraft state reports: positional JSON arrays to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.identity import payload_hash
from tarmac.functions.text import clean_callsign
from tarmac.functions.timing import epoch_utc
from tarmac.schemas import conform

# Order of the fields in one reported array. Fixed values.
FIELDS = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude_m", "on_ground", "velocity_ms",
    "true_track_deg", "vertical_rate_ms", "sensors", "geo_altitude_m", "squawk",
    "spi", "position_source",
)
_TYPES = {
    "longitude": "double", "latitude": "double", "baro_altitude_m": "double",
    "velocity_ms": "double", "true_track_deg": "double", "vertical_rate_ms": "double",
    "geo_altitude_m": "double", "on_ground": "boolean", "spi": "boolean",
    "position_source": "int",
}
BODY = "time bigint, states array<array<string>>"

IDENTITY = [f for f in FIELDS]


def _field(name: str) -> Column:
    raw = F.try_element_at("__s", F.lit(FIELDS.index(name) + 1))
    if name in ("time_position", "last_contact"):
        return epoch_utc(raw)
    if name == "callsign":
        return clean_callsign(raw)
    if name == "sensors":
        return F.from_json(raw, "array<bigint>")
    return raw.try_cast(_TYPES[name]) if name in _TYPES else raw


def parse_states(landed: DataFrame, body: str = "body") -> DataFrame:
    """One row per reported aircraft, with ``n_elements`` and ``misread`` for the rules.

    A null list is an empty response. Elements past the known ones are ignored.
    ``misread`` is set where text was present but could not be typed.
    """
    parsed = landed.withColumn("__j", F.from_json(body, BODY))
    rows = parsed.withColumn("__s", F.explode(F.col("__j")["states"]))
    named = rows.select(
        "poll_id", "airport", "ingested_at",
        epoch_utc(F.col("__j")["time"]).alias("response_time"),
        *[_field(n).alias(n) for n in FIELDS],
        F.coalesce(F.size("__s"), F.lit(0)).alias("n_elements"),
        _misread().alias("misread"),
    )
    return named.withColumn("payload_hash", payload_hash(IDENTITY))


def _misread() -> Column:
    bad = F.lit(False)
    for name in (*_TYPES, "time_position", "last_contact"):
        raw = F.try_element_at("__s", F.lit(FIELDS.index(name) + 1))
        bad = bad | (raw.isNotNull() & _field(name).isNull())
    return bad


def unreadable_states(landed: DataFrame, body: str = "body") -> DataFrame:
    """Bodies that are not a state response at all, for the reject counts."""
    j = F.from_json(body, BODY)
    return landed.filter(j.isNull() | j["time"].isNull())


def to_bronze(valid: DataFrame) -> DataFrame:
    return conform(valid, "states")
