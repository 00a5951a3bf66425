"""Timestamps, window keys and the year-less times of delay notices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.text import strip


def epoch_utc(c: Column) -> Column:
    """Epoch seconds (number or numeric text) to a timestamp; anything else is null.

    A boolean is not a number: JSON ``true`` arrives as text and fails the cast.
    """
    return F.timestamp_micros(F.round(c.try_cast("double") * 1_000_000).cast("bigint"))


def utc_epoch(c: Column) -> Column:
    return F.unix_micros(c) / F.lit(1_000_000)


def day_anchor(ts: Column, hour: int = 0, tz: str = "UTC") -> Column:
    """The instant of ``hour`` o'clock in ``tz`` on the local day of ``ts``."""
    local = F.from_utc_timestamp(ts, tz)
    anchored = F.date_trunc("day", local) + F.make_interval(hours=F.lit(hour))
    return F.to_utc_timestamp(anchored, tz)


def window_key(ts: Column, seconds: int = 900) -> Column:
    """Start of the fixed window holding ``ts``; cheaper than window() in a key."""
    sec = F.unix_seconds(ts)
    return F.timestamp_seconds(sec - F.pmod(sec, F.lit(seconds)))


def partition_keys(ts: Column) -> tuple[Column, Column]:
    return (
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
        F.date_format(ts, "HH").alias("hour"),
    )


_NOTAM_SPAN = r"(\d{10})-(\d{10})"


def notam_window(reason: Column) -> tuple[Column, Column]:
    """Start and end from the ``YYMMDDHHMM-YYMMDDHHMM`` group of a notice text."""

    def part(i: int) -> Column:
        return F.try_to_timestamp(
            F.nullif(F.regexp_extract(reason, _NOTAM_SPAN, i), F.lit("")), F.lit("yyMMddHHmm")
        )

    return part(1), part(2)


def faa_time(text: Column, anchor: Column) -> Column:
    """Year-less or day-less notice time as the reading nearest to ``anchor``.

    ``Aug 08 at 04:30 UTC.`` is tried in the years around the anchor and a bare
    ``18:00`` on the days around it. On a tie the later reading is used.
    """
    clean = strip(text)
    day = F.nullif(F.regexp_extract(clean, r"^([A-Za-z]{3} \d{2}) at \d{2}:\d{2}", 1), F.lit(""))
    clock = F.nullif(F.regexp_extract(clean, r"(\d{2}:\d{2})", 1), F.lit(""))
    dated = [
        F.try_to_timestamp(
            F.concat_ws(" ", F.year(anchor) + shift, F.initcap(day), clock),
            F.lit("yyyy MMM dd HH:mm"),
        )
        for shift in (-1, 0, 1)
    ]
    undated = [
        F.try_to_timestamp(
            F.concat_ws(" ", F.date_add(anchor.cast("date"), shift), clock),
            F.lit("yyyy-MM-dd HH:mm"),
        )
        for shift in (-1, 0, 1)
    ]
    options = [
        F.when(clock.isNotNull(), F.when(day.isNotNull(), d).otherwise(u))
        for d, u in zip(dated, undated, strict=True)
    ]
    ranked = F.array(
        *[
            F.struct(
                F.abs(F.unix_seconds(o) - F.unix_seconds(anchor)).alias("off"),
                (-F.unix_seconds(o)).alias("late"),
                o.alias("at"),
            )
            for o in options
        ]
    )
    return F.array_min(F.filter(ranked, lambda x: x["at"].isNotNull()))["at"]


def program_times(
    start_text: Column, end_text: Column, reason: Column, anchor: Column
) -> tuple[Column, Column]:
    """Start and end of a program: the notice group first, then the loose texts."""
    start, end = notam_window(reason)
    return (
        F.coalesce(start, faa_time(start_text, anchor)),
        F.coalesce(end, faa_time(end_text, anchor)),
    )
