"""Traveller-board predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status groups. Fixed values.
STATUS_GROUPS = {
    "active": ("scheduled", "boarding", "delayed", "en-route"),
    "delayed": ("delayed",),
    "done": ("departed", "landed", "cancelled"),
}


def status_group(status: Column, group: str) -> Column:
    """Whether a status belongs to the group; an unknown group matches everything."""
    members = STATUS_GROUPS.get(group)
    return F.lit(True) if members is None else status.isin(*members)


def time_window(ts: Column, window: str, now: Column, tz: str = "UTC") -> Column:
    hour = F.hour(F.from_utc_timestamp(ts, tz))
    if window == "all":
        return F.lit(True)
    if window == "soon":
        ahead = F.unix_micros(ts) - F.unix_micros(now)
        return ahead.between(-15 * 60 * 1_000_000, 3 * 3600 * 1_000_000)
    if window == "morning":
        return (hour >= 5) & (hour < 12)
    if window == "afternoon":
        return (hour >= 12) & (hour < 18)
    if window == "evening":
        return hour >= 18
    raise ValueError(f"unknown time window {window!r}")


def board_match(query: str, number: Column, city: Column, code: Column) -> Column:
    """Free-text search over flight number (blanks ignored), city and code."""
    q = query.strip().upper()
    if not q:
        return F.lit(True)
    packed = "".join(q.split())
    return (
        F.contains(F.upper(F.regexp_replace(number, r"\s", "")), F.lit(packed))
        | F.contains(F.upper(city), F.lit(q))
        | F.contains(F.upper(code), F.lit(q))
    )


def risk_band(p: Column, cuts: tuple[float, float] = (0.35, 0.65)) -> Column:
    """Low, medium or high; the cut points are the caller's."""
    low, high = cuts
    return F.when(p < low, "low").when(p < high, "medium").when(p.isNotNull(), "high")
