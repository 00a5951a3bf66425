"""Text cleaning and key normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"

# Section name in a delay-program notice -> event code. Fixed values.
EVENT_CODES = {
    "Ground Stop Programs": "ground_stop",
    "Ground Delay Programs": "ground_delay",
    "Airport Closures": "closure",
    "Airspace Flow Programs": "airspace_flow",
    "Arrival/Departure Delays": "arrival_departure_delay",
    "Deicing": "deicing",
}


def strip(c: Column) -> Column:
    """Trim every kind of blank; Spark's plain trim removes spaces only."""
    return F.trim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def clean_callsign(c: Column) -> Column:
    return blank_to_null(c)


def clean_text(c: Column) -> Column:
    return blank_to_null(F.trim(strip(c), F.lit("'\"")))


def first_text(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def empty_if_null(c: Column, type_ddl: str) -> Column:
    return F.coalesce(c, F.array().cast(type_ddl))


def norm_icao24(c: Column) -> Column:
    return F.lower(c)


def norm_faa(c: Column) -> Column:
    return F.upper(c)


def event_type(c: Column) -> Column:
    """Event code of a section name; null when the section is unknown."""
    pairs = [F.lit(x) for kv in EVENT_CODES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), strip(c))


def built_year(c: Column) -> Column:
    year = F.substring(clean_text(c), 1, 4).try_cast("int")
    return F.when(year.between(1900, 2100), year)


def aircraft_age(built: Column, year: Column | int) -> Column:
    age = (year if isinstance(year, Column) else F.lit(year)) - built
    return F.when(age >= 0, age)


def delay_minutes(c: Column) -> Column:
    """Average-delay text such as ``1 hour and 15 minutes`` as minutes."""
    low = F.lower(c)
    hours = F.regexp_extract(low, r"(\d+)\s*h", 1).try_cast("int")
    minutes = F.regexp_extract(low, r"(\d+)\s*m", 1).try_cast("int")
    known = hours.isNotNull() | minutes.isNotNull()
    return F.when(
        known, F.coalesce(hours, F.lit(0)) * 60 + F.coalesce(minutes, F.lit(0))
    )
