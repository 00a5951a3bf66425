"""Historical departures and per-airport flight lists."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


FLIGHTS = (
    "icao24 string, first_seen timestamp, departure_airport string, last_seen timestamp, "
    "arrival_airport string, callsign string"
)


# Headers of the published monthly files, in their two spellings. Fixed values.
PUBLISHED = {
    "airport": ("origin",), "day": ("flightdate", "fl_date"), "clock": ("crsdeptime", "crs_dep_time"),
    "delay": ("depdelay", "dep_delay"), "cancelled": ("cancelled",), "diverted": ("diverted",),
}


def _plain(name: str) -> str:
    return name.strip().lower()


def typed_ontime(raw: DataFrame) -> DataFrame:
    """airport, scheduled, actual and the reason why a row can't be used (null if it can).

    Columns are found by name, in any order and among any others: either airport, scheduled and
    actual, or those of the published files, where the actual time is the scheduled clock and
    date plus the delay, so that it may fall on the next day. A missing one is an error.
    """
    have = {_plain(c): F.trim(F.col(f"`{c}`").cast("string")) for c in raw.columns}
    if {"airport", "scheduled", "actual"} <= set(have):
        scheduled, actual = (F.try_to_timestamp(have[c]) for c in ("scheduled", "actual"))
        none = F.lit(False)
        return _judged(raw, have["airport"], scheduled, actual, none, none)
    found = {name: next((have[s] for s in spellings if s in have), None) for name, spellings in PUBLISHED.items()}
    lacking = [n for n in ("airport", "day", "clock", "delay") if found[n] is None]
    if lacking:
        raise ValueError(f"the file lacks {', '.join(lacking)}; it has {', '.join(sorted(have))}")
    clock = found["clock"].try_cast("double").cast("int")
    sound = clock.between(0, 2400) & (clock % 100 < 60)
    day = F.coalesce(F.try_to_timestamp(found["day"]), F.try_to_timestamp(found["day"], F.lit("M/d/yyyy h:mm:ss a")))
    after = lambda c, minutes: F.timestamp_micros(F.unix_micros(c) + (minutes * 60_000_000).cast("bigint"))
    scheduled = F.when(sound, after(day, F.floor(clock / 100) * 60 + clock % 100))
    said = lambda name: F.coalesce(found[name].try_cast("double") > 0, F.lit(False)) if found[name] is not None else F.lit(False)
    return _judged(raw, found["airport"], scheduled, after(scheduled, found["delay"].try_cast("double")), said("cancelled"), said("diverted"))


def _judged(raw: DataFrame, airport: Column, scheduled: Column, actual: Column, cancelled: Column, diverted: Column) -> DataFrame:
    reason = (
        F.when(cancelled, "cancelled").when(diverted, "diverted").when(F.coalesce(airport, F.lit("")) == "", "airport")
        .when(scheduled.isNull(), "scheduled").when(actual.isNull(), "actual")
    )
    return raw.select(F.upper(airport).alias("airport"), scheduled.alias("scheduled"), actual.alias("actual"), reason.alias("reason"))


def read_ontime(spark: SparkSession, paths: str | list[str], airports: DataFrame, local_clock: bool = True) -> DataFrame:
    """Monthly CSVs, reduced to tracked airports. Files of one call must have one header; others are an error."""
    return track_ontime(scan_ontime(spark, paths).where("reason IS NULL"), airports, local_clock)


def scan_ontime(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All rows of the files, typed, with the reasons of those for the quarantine."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(paths)
    return typed_ontime(raw)


def track_ontime(raw: DataFrame, airports: DataFrame, local_clock: bool = True) -> DataFrame:
    """Departures of tracked airports in UTC.

    Published schedules are clock time at the airport, hence the zone of the airport
    dimension. ``raw`` names airports by their three-letter code; the result by icao.
    """
    dim = airports.select(F.col("faa_code").alias("airport"), "icao", "tz")
    rows = raw.join(dim, "airport", "inner")

    def utc(c: str) -> Column:
        return F.to_utc_timestamp(c, F.col("tz")) if local_clock else F.col(c)

    return rows.select(F.col("icao").alias("airport"), utc("scheduled").alias("scheduled"), utc("actual").alias("actual"))


def flights_by_airport(
    flights: DataFrame, airport: str, begin: datetime, end: datetime, direction: str = "arrival"
) -> DataFrame:
    """Flights of one airport inside [begin, end], which must lie in one UTC day."""
    if not 3 <= len(airport) <= 4:
        raise ValueError(f"not an airport code: {airport!r}")
    b, e = (d.astimezone(timezone.utc) if d.tzinfo else d.replace(tzinfo=timezone.utc) for d in (begin, end))
    if b > e:
        raise ValueError("begin is after end")
    if b.date() != e.date():
        raise ValueError("the interval must stay within one UTC day")
    if b.timestamp() < 0:
        raise ValueError("the interval starts before 1970")
    at, where = {
        "arrival": ("last_seen", "arrival_airport"), "departure": ("first_seen", "departure_airport"),
    }[direction]
    rows = flights
    if "date" in flights.columns:
        rows = rows.filter(F.col("date") == b.strftime("%Y-%m-%d"))
    return rows.filter((F.col(where) == airport) & F.col(at).between(F.lit(b), F.lit(e)))
