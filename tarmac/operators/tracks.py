"""Tracks: segments, approaches, go-arounds, holds, racetracks and arrivals.

Detectors read points with icao24, ts, airport, dist_nm, alt_ft, agl_ft,
vertical_rate_ms, true_track_deg, velocity_ms and on_ground, one point per aircraft
and instant (``track_points`` makes them). All of them work on the same (aircraft,
time bucket) shuffle; each rule looks back a bounded time, which the halo covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tarmac.config import DEFAULT, Thresholds
from tarmac.functions import geo
from tarmac.operators.joins import asof_join, nearest_airport
from tarmac.operators.ordered import (
    before, bucket_window, gap_breaks, islands, owned, so_far, time_bucket, with_halo,
)
from tarmac.session import settle

STANDARD_HPA = 1013.25
FT_PER_HPA = 27.3


def segments(
    obs: DataFrame, t: Thresholds = DEFAULT, key: str = "icao24", ts: str = "ts",
    gap_s: float | None = None, bucket_s: int | None = None,
) -> DataFrame:
    """Add segment_start and segment_id; a silence longer than the gap starts a new one.

    The id is the aircraft and the start time, so a rerun names it alike.
    """
    labelled = islands(
        obs, [key], [ts], gap_breaks(ts, gap_s or t.segment_gap_s),
        bucket=time_bucket(ts, bucket_s or t.bucket_s), name="__start",
    )
    start = F.col("__start")[ts]
    return labelled.withColumn("segment_start", start).withColumn(
        "segment_id", F.concat_ws("-", F.col(key), F.unix_micros(start))
    ).drop("__start")


def segment_table(points: DataFrame, key: str = "icao24", ts: str = "ts") -> DataFrame:
    return points.groupBy("segment_id", key).agg(
        F.min(ts).alias("segment_start"), F.max(ts).alias("segment_end"),
        F.count("*").alias("points"),
    )


def track_points(
    obs: DataFrame, airports: DataFrame, metar: DataFrame | None = None,
    ts: str = "last_contact", pressure_age_s: int = 7200,
) -> DataFrame:
    """Observations to detector input: nearest airport, distance, feet and height.

    Height above the field is pressure altitude less elevation, corrected by the
    latest altimeter setting where a METAR of the last two hours is given.
    """
    # The box an observation was seen from gives way to the airport nearest to it.
    seen = obs.drop("airport", "dist_nm", "elev_ft", "metar_station")
    near = nearest_airport(
        seen, airports, name="airport", dist="dist_nm", extra=("elev_ft", "metar_station")
    )
    alt = geo.m_to_ft(F.coalesce("baro_altitude_m", "geo_altitude_m"))
    pts = near.filter(F.col("airport").isNotNull()).withColumn("alt_ft", alt).withColumn("ts", F.col(ts))
    fix: Column = F.lit(0.0)
    if metar is not None:
        setting = metar.select(
            F.col("station").alias("metar_station"), "obs_time", "altimeter_hpa"
        ).filter("altimeter_hpa is not null")
        pts = asof_join(
            pts, setting, ["metar_station"], "ts", "obs_time",
            tolerance_s=pressure_age_s, right_cols=["altimeter_hpa"], right_tie=["altimeter_hpa"],
            # Short buckets: the few reports are copied, the many points are spread.
            bucket_s=900,
        )
        fix = F.coalesce((F.col("altimeter_hpa") - STANDARD_HPA) * FT_PER_HPA, F.lit(0.0))
    return pts.withColumn("agl_ft", F.col("alt_ft") + fix - F.coalesce("elev_ft", F.lit(0.0)))


def _secs(c: str | Column) -> Column:
    return F.unix_micros(c) / F.lit(1_000_000)


def _framed(points: DataFrame, t: Thresholds, lookback_s: int, lookahead_s: int = 0):
    """Halo copies plus the previous point of the same segment and airport.

    ``lookback_s`` is how far a rule reads back. The halo reaches one segment gap further,
    because each point that a rule reads must itself see the point before it.
    """
    back = lookback_s + t.segment_gap_s
    df = with_halo(
        points, "ts", width_s=max(t.bucket_s, back), lookback_s=back, lookahead_s=lookahead_s
    )
    w = bucket_window(["icao24"], ["ts"])
    prev = F.struct("ts", "dist_nm", "airport", "true_track_deg", "vertical_rate_ms", "on_ground")
    df = df.withColumn("__prev", F.lag(prev).over(w)).withColumn("__sec", _secs("ts"))
    recent = (F.col("__sec") - _secs(F.col("__prev")["ts"])) <= t.segment_gap_s
    return df.withColumn("__prev", F.when(recent, F.col("__prev"))), w


def _with_approach(df: DataFrame, t: Thresholds) -> DataFrame:
    prev = F.col("__prev")
    return df.withColumn(
        "on_approach",
        F.coalesce(
            (F.col("dist_nm") <= t.approach_nm)
            & (F.col("vertical_rate_ms") < t.approach_descent_ms)
            & (F.col("alt_ft") < t.approach_max_alt_ft)
            & (prev["airport"] == F.col("airport"))
            & (F.col("dist_nm") < prev["dist_nm"]),
            F.lit(False),
        ),
    )


def approach_points(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Points close, low, descending and closing in on their airport."""
    df, _ = _framed(points, t, 0)
    return owned(_with_approach(df, t)).filter("on_approach").drop("__prev", "__sec", "on_approach")


def _with_go_around(df: DataFrame, w: WindowSpec, t: Thresholds) -> DataFrame:
    prev, sec = F.col("__prev"), F.col("__sec")
    climbing = F.coalesce(F.col("vertical_rate_ms") > t.climb_ms, F.lit(False))
    was_climbing = F.coalesce(prev["vertical_rate_ms"] > t.climb_ms, F.lit(False))
    low = (
        F.col("on_approach") & (F.col("dist_nm") <= t.field_nm) & (F.col("agl_ft") < t.low_agl_ft)
    )
    run = so_far(w)
    df = df.withColumns(
        {
            "__low": F.last(F.when(low, F.struct("__sec", "agl_ft", "airport")), True).over(run),
            "__ground": F.last(F.when(F.col("on_ground"), sec), True).over(run),
            "__climb": F.last(F.when(climbing & ~was_climbing, sec), True).over(run),
            "__up": climbing,
        }
    )
    fires = (
        F.col("__up")
        & (F.col("__low")["airport"] == F.col("airport"))
        & (sec - F.col("__low")["__sec"] <= t.go_around_horizon_s)
        & (F.col("__ground").isNull() | (F.col("__ground") < F.col("__low")["__sec"]))
        & (sec - F.col("__climb") >= t.climb_sustain_s)
        & (F.col("agl_ft") - F.col("__low")["agl_ft"] > t.regain_ft)
    )
    df = df.withColumn("__fire", F.when(F.coalesce(fires, F.lit(False)), sec))
    df = df.withColumn("__fired", F.last("__fire", True).over(before(w)))
    first = F.col("__fire").isNotNull() & (
        F.col("__fired").isNull() | (F.col("__fired") < F.col("__climb"))
    )
    return df.withColumn("went_around", first)


def go_arounds(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """One row per aborted approach, at the first point where all of the rule holds.

    Low on approach near the field within the horizon; since then no ground contact;
    climbing without a break for the sustain time; regained more than the height.
    """
    df, w = _framed(points, t, t.go_around_horizon_s)
    return owned(_with_go_around(_with_approach(df, t), w, t).filter("went_around")).select(
        "airport", "icao24", "ts",
        F.timestamp_micros((F.col("__low")["__sec"] * 1_000_000).cast("bigint")).alias("low_ts"),
        F.col("__low")["agl_ft"].alias("low_agl_ft"), "agl_ft",
    )


def hold_points(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Every point with the turn and altitude band of its last ten minutes.

    ``holding`` is null where the samples are too sparse to decide: a turn of 3 deg/s
    cannot be followed across a gap of 90 s.
    """
    df, w = _framed(points.filter(F.col("dist_nm") <= t.hold_nm), t, t.hold_window_s)
    prev = F.col("__prev")
    df = df.withColumns(
        {
            "__delta": geo.heading_delta(prev["true_track_deg"], F.col("true_track_deg")),
            "__gap": F.col("__sec") - _secs(prev["ts"]),
            "__us": F.unix_micros("ts"),
        }
    )
    frame = bucket_window(["icao24"], ["__us"]).rangeBetween(-t.hold_window_s * 1_000_000, 0)
    # The first point of a frame has turned before the frame began, so its turn and
    # its gap do not count.
    df = df.withColumns(
        {
            "__turn": F.sum("__delta").over(frame)
            - F.coalesce(F.first("__delta").over(frame), F.lit(0.0)),
            "__band": F.max("alt_ft").over(frame) - F.min("alt_ft").over(frame),
            "__frame": F.first("ts").over(frame),
            "__n": F.count("*").over(frame),
            "__tight": F.count_if(F.col("__gap") <= t.max_sample_gap_s).over(frame)
            - F.first((F.coalesce("__gap", F.lit(1e9)) <= t.max_sample_gap_s).cast("int")).over(frame),
        }
    )
    dense = (F.col("__n") > 1) & (F.col("__tight") == F.col("__n") - 1)
    hit = (F.abs("__turn") >= t.hold_turn_deg) & (F.col("__band") <= 2 * t.hold_alt_band_ft)
    return owned(df).select(
        "airport", "icao24", "ts", F.col("__frame").alias("frame_start"),
        F.col("__turn").alias("turn_deg"), F.col("__band").alias("alt_band_ft"),
        F.when(dense, F.coalesce(hit, F.lit(False))).alias("holding"),
    )


def holds(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Holding patterns with their duration; overlapping ten-minute hits are merged."""
    hits = settle(hold_points(points, t).filter("holding"), "hold-hits")
    merged = islands(
        hits, ["icao24", "airport"], ["ts"], gap_breaks("ts", t.hold_window_s),
        bucket=time_bucket("ts", t.bucket_s), name="__h",
    )
    return (
        merged.groupBy("airport", "icao24", F.col("__h")["ts"].alias("first_hit"))
        .agg(F.min("frame_start").alias("start_ts"), F.max("ts").alias("end_ts"))
        .withColumn("duration_s", _secs("end_ts") - _secs("start_ts"))
    )


def hold_coverage(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """How many points per airport could be decided at all."""
    return hold_points(points, t).groupBy("airport").agg(
        F.count("*").alias("points"),
        F.count_if(F.col("holding").isNull()).alias("undetermined"),
        F.count_if(F.coalesce("holding", F.lit(False))).alias("holding_points"),
    )


def racetracks(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Patterns of straight legs and half turns, independent of the 720 degree rule.

    Points are cut into straight and turning runs; a racetrack is at least the
    minimum number of half-circle turns inside the racetrack window.
    """
    near = points.filter(F.col("dist_nm") <= t.hold_nm)
    df, _ = _framed(near, t, 0)
    gap = F.col("__sec") - _secs(F.col("__prev")["ts"])
    delta = geo.heading_delta(F.col("__prev")["true_track_deg"], F.col("true_track_deg"))
    # +1 right turn, -1 left turn, 0 straight or unknown.
    rate = F.try_divide(delta, gap)
    sense = F.when(rate >= t.turn_rate_dps, 1).when(rate <= -t.turn_rate_dps, -1).otherwise(0)
    legs = owned(df.withColumn("turn", sense).withColumn("delta", F.coalesce(delta, F.lit(0.0)))).select(
        "icao24", "airport", "ts", "turn", "delta"
    )
    limit = int(t.segment_gap_s * 1_000_000)
    runs = islands(
        legs, ["icao24", "airport"], ["ts"],
        lambda p, c: (p["turn"] != c["turn"])
        | ((F.unix_micros(c["ts"]) - F.unix_micros(p["ts"])) > limit),
        bucket=time_bucket("ts", t.bucket_s), carry=["turn"], name="__run",
    )
    turns = settle(
        runs.filter("turn != 0")
        .groupBy("icao24", "airport", F.col("__run")["ts"].alias("turn_start"))
        .agg(F.max("ts").alias("ts"), F.sum("delta").alias("turned"))
        .filter(
            F.abs(F.abs(F.col("turned")) - t.racetrack_turn_deg) <= t.racetrack_tolerance_deg
        ),
        "half-turns",
    )
    width = max(t.bucket_s, t.racetrack_window_s)
    halo = with_halo(turns, "ts", width_s=width, lookback_s=t.racetrack_window_s)
    halo = halo.withColumn("__us", F.unix_micros("ts"))
    frame = bucket_window(["icao24", "airport"], ["__us"]).rangeBetween(
        -t.racetrack_window_s * 1_000_000, 0
    )
    counted = halo.withColumns(
        {"__n": F.count("*").over(frame), "frame_start": F.min("turn_start").over(frame)}
    )
    hits = owned(counted.filter(F.col("__n") >= t.racetrack_min_turns)).drop("__us")
    merged = islands(
        hits, ["icao24", "airport"], ["ts"], gap_breaks("ts", t.racetrack_window_s),
        bucket=time_bucket("ts", t.bucket_s), name="__h",
    )
    return (
        merged.groupBy("airport", "icao24", F.col("__h")["ts"].alias("first_hit"))
        .agg(
            F.min("frame_start").alias("start_ts"), F.max("ts").alias("end_ts"),
            F.max("__n").alias("half_turns"),
        )
        .withColumn("duration_s", _secs("end_ts") - _secs("start_ts"))
    )


def _with_arrival(df: DataFrame, w: WindowSpec, t: Thresholds) -> DataFrame:
    next_sec = F.lead("__sec").over(w)
    last = next_sec.isNull() | (next_sec - F.col("__sec") > t.segment_gap_s)
    df = df.withColumn("__last", last)
    near = F.col("dist_nm") <= t.field_nm
    touched = near & F.col("on_ground") & (F.col("__prev")["on_ground"] == F.lit(False))
    faded = (
        near & F.col("__last") & ~F.col("on_ground") & F.col("on_approach")
        & (F.col("agl_ft") < t.last_seen_agl_ft) & (F.col("velocity_ms") <= t.last_seen_max_ms)
    )
    return df.withColumn(
        "seen",
        F.when(F.coalesce(touched, F.lit(False)), "touchdown").when(
            F.coalesce(faded, F.lit(False)), "last_seen"
        ),
    )


def arrivals(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Landings: air to ground near the field, or a track that ends low, slow and close.

    ``seen`` tells the two apart, because low-altitude coverage is known to have holes.
    """
    df, w = _framed(points, t, 0, lookahead_s=t.segment_gap_s)
    return (
        owned(_with_arrival(_with_approach(df, t), w, t)).filter(F.col("seen").isNotNull())
        .select("airport", "icao24", "ts", "seen")
    )


def point_events(points: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Approach points, go-arounds and arrivals in one pass over one shuffle.

    Rows carry on_approach, went_around and seen; the rules are those of the single
    detectors. Points with none of the three are dropped.
    """
    df, w = _framed(points, t, t.go_around_horizon_s, lookahead_s=t.segment_gap_s)
    flagged = _with_arrival(_with_go_around(_with_approach(df, t), w, t), w, t)
    return owned(flagged).filter("on_approach OR went_around OR seen IS NOT NULL").select(
        "airport", "icao24", "ts", "velocity_ms", "on_approach", "went_around", "seen"
    )
