"""Airport feature windows, their lags and the delay labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import DEFAULT, WIDEBODY_TYPES, Thresholds
from tarmac.functions import geo, weather
from tarmac.functions.text import aircraft_age
from tarmac.functions.timing import window_key
from tarmac.operators.joins import (
    active_programs, asof_join, forecast_outlook, with_aircraft, with_outlook,
)

KEY = ("airport", "window_start")


def spine(airports: DataFrame, t0: Column | datetime, t1: Column | datetime, window_s: int = 900) -> DataFrame:
    """Every airport x window in [t0, t1); t0 and t1 may be columns of ``airports``."""
    first = window_key(t0 if isinstance(t0, Column) else F.lit(t0), window_s)
    end = t1 if isinstance(t1, Column) else F.lit(t1)
    last = window_key(end - F.make_interval(secs=F.lit(0.000001)), window_s)
    return airports.select(
        F.col("icao").alias("airport"),
        F.explode(F.sequence(first, last, F.make_interval(secs=F.lit(window_s)))).alias("window_start"),
    )


def airport_windows(
    dense: DataFrame, events: DataFrame, holds: DataFrame, aircraft: DataFrame, *, widebody: Sequence[str] = WIDEBODY_TYPES,
    window_s: int = 900,
) -> DataFrame:
    """Counts, means and fleet mix per airport and window.

    ``events`` comes from ``point_events``, which finds approaches, go-arounds and
    arrivals in one pass. Holds are stacked on it and all of it is reduced in one
    aggregation. An event belongs to the window in which it became known.
    """
    fleet = aircraft.select("icao24", "typecode", "built")
    known = with_aircraft(events, fleet)
    landed = F.col("seen").isNotNull()
    age = aircraft_age(F.col("built"), F.year("ts")).cast("double")
    wide = F.when(F.col("typecode").isNotNull(), F.col("typecode").isin(*widebody).cast("double"))
    none = F.lit(None).cast("double")
    one = F.lit(1.0)

    def part(df: DataFrame, at: str, **cols: Column) -> DataFrame:
        names = ("arrival", "go_around", "hold", "hold_s", "speed_ms", "wide", "age")
        return df.select(
            "airport", window_key(F.col(at), window_s).alias("window_start"),
            *[cols.get(n, none).alias(n) for n in names],
        )

    stacked = part(
        known, "ts", arrival=F.when(landed, one), go_around=F.when(F.col("went_around"), one),
        speed_ms=F.when(F.col("on_approach"), F.col("velocity_ms")),
        wide=F.when(landed, wide), age=F.when(landed, age),
    ).unionByName(part(holds, "end_ts", hold=one, hold_s=F.col("duration_s")))
    counts = stacked.groupBy(*KEY).agg(
        F.count("arrival").alias("n_arrivals"), F.count("go_around").alias("n_go_arounds"),
        F.count("hold").alias("n_holds"), F.avg("hold_s").alias("mean_hold_duration"),
        F.avg("speed_ms").alias("mean_approach_speed"), F.avg("wide").alias("share_widebody"),
        F.avg("age").alias("mean_aircraft_age"),
    )
    filled = ("n_arrivals", "n_go_arounds", "n_holds")
    return dense.join(counts, list(KEY), "left").na.fill(0, list(filled))


def with_weather(
    windows: DataFrame, metar: DataFrame, airports: DataFrame, runways: DataFrame | None = None,
    max_age_s: int = 5400,
) -> DataFrame:
    """Latest METAR at or before the window start, with crosswind and precipitation."""
    station = airports.select(F.col("icao").alias("airport"), F.col("metar_station").alias("station"))
    cols = [
        "wind_dir_deg", "wind_speed_kt", "wind_gust_kt", "visibility_sm", "ceiling_ft",
        "flight_category", "wx_string",
    ]
    joined = asof_join(
        windows.join(station, "airport", "left"), metar, ["station"], "window_start", "obs_time",
        tolerance_s=max_age_s, right_cols=cols + ["obs_time"],
        right_tie=["payload_hash"] if "payload_hash" in metar.columns else (),
    )
    headings: Column = F.lit(None).cast("array<double>")
    if runways is not None:
        strips = runways.groupBy(F.col("icao").alias("airport")).agg(
            F.sort_array(F.collect_set("heading_deg")).alias("headings")
        )
        joined = joined.join(strips, "airport", "left")
        headings = F.col("headings")
    return (
        joined.withColumn(
            "crosswind_kt",
            geo.least_crosswind_kt(F.col("wind_dir_deg").cast("double"), F.col("wind_speed_kt"), headings),
        )
        .withColumn("precip", weather.is_precip(F.col("wx_string")))
        .withColumn("now_severity", weather.severity(F.col("visibility_sm"), F.col("ceiling_ft")))
        .drop("headings", "station")
    )


def lag_features(
    df: DataFrame, cols: Sequence[str], lags: Sequence[int] = (1, 2, 4), window_min: int = 15
) -> DataFrame:
    """The same columns 15, 30 and 60 minutes ago; needs the dense spine.

    One row per airport and window is all that is ordered here, however many
    observations lie behind it.
    """
    w = Window.partitionBy("airport").orderBy("window_start")
    return df.withColumns(
        {f"{c}_t{n * window_min}": F.lag(c, n).over(w) for c in cols for n in lags}
    )


def trend(df: DataFrame, col: str = "n_arrivals", rows: int = 4, name: str = "arrival_rate_trend") -> DataFrame:
    """Least-squares slope of a count over the trailing windows, per window."""
    w = Window.partitionBy("airport").orderBy("window_start").rowsBetween(-(rows - 1), 0)
    x = F.unix_seconds("window_start") / F.lit(900.0)
    return df.withColumn(name, F.regr_slope(F.col(col).cast("double"), x).over(w))


def airport_features(
    windows: DataFrame, metar: DataFrame, taf_periods: DataFrame,
    programs: DataFrame, airports: DataFrame, runways: DataFrame | None = None,
    t: Thresholds = DEFAULT,
) -> DataFrame:
    """The gold table: one row per airport and window, no gaps.

    ``windows`` is the output of ``airport_windows`` on the dense spine.
    """
    wx = with_weather(windows, metar, airports, runways)
    ahead = with_outlook(wx, forecast_outlook(taf_periods, t.window_s))
    flags = active_programs(programs, t.window_s)
    full = ahead.join(flags, list(KEY), "left").na.fill(
        False, ["ground_stop_active", "ground_delay_active", "closure_active"]
    ).na.fill(0, ["programs_active"])
    return lag_features(trend(full), ["n_arrivals", "n_go_arounds", "n_holds"])


def profile(df: DataFrame, ts: str, key: str = "icao24", airport: str = "airport", approx: bool = False) -> DataFrame:
    """Rows, distinct aircraft and airports per day."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n_rows"), distinct(F.col(key)).alias("n_aircraft"),
        distinct(F.col(airport)).alias("n_airports"),
    )


def delay_windows(ontime: DataFrame, window_s: int = 900) -> DataFrame:
    """Departures, delay minutes and mean delay per airport and scheduled window."""
    delay = (F.unix_micros("actual") - F.unix_micros("scheduled")) / F.lit(60_000_000)
    return (
        ontime.withColumn("delay_min", delay)
        .groupBy("airport", window_key(F.col("scheduled"), window_s).alias("window_start"))
        .agg(
            F.count("delay_min").alias("departures"), F.sum("delay_min").alias("delay_sum"),
            F.avg("delay_min").alias("mean_delay"),
        )
    )


def delay_target(
    windows: DataFrame, horizon_s: int = 3600, threshold_min: float = 15.0, window_s: int = 900
) -> DataFrame:
    """Whether the mean delay of the hour *after* the window exceeds the threshold.

    For window [w, w+15) these are departures scheduled in [w+15, w+75) minutes. The
    mean weighs departures, not windows; null when nothing departs.
    """
    w = (
        Window.partitionBy("airport").orderBy(F.unix_seconds("window_start"))
        .rangeBetween(window_s, horizon_s)
    )
    ahead = F.try_divide(F.sum("delay_sum").over(w), F.sum("departures").over(w))
    return windows.withColumn("mean_delay_next", ahead).withColumn(
        "target", (F.col("mean_delay_next") > threshold_min).cast("int")
    )
