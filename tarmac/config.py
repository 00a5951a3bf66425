"""Every threshold of the detectors, features and monitors in one record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # tracks
    segment_gap_s: int = 900
    # Width of the time buckets a track is cut into. Wider means fewer halo copies,
    # narrower means smaller tasks for a busy aircraft.
    bucket_s: int = 7200
    # approach
    approach_nm: float = 25.0
    approach_max_alt_ft: float = 8000.0
    approach_descent_ms: float = -2.0
    # go-around
    field_nm: float = 5.0
    low_agl_ft: float = 1500.0
    climb_ms: float = 5.0
    climb_sustain_s: int = 30
    regain_ft: float = 1000.0
    go_around_horizon_s: int = 900
    # hold
    hold_nm: float = 40.0
    hold_alt_band_ft: float = 300.0
    hold_turn_deg: float = 720.0
    hold_window_s: int = 600
    max_sample_gap_s: int = 30
    # racetrack
    turn_rate_dps: float = 1.0
    racetrack_turn_deg: float = 180.0
    racetrack_tolerance_deg: float = 30.0
    racetrack_min_turns: int = 3
    racetrack_window_s: int = 1800
    # arrival fallback where coverage ends before touchdown
    last_seen_agl_ft: float = 1000.0
    last_seen_max_ms: float = 90.0
    # windows, labels
    window_s: int = 900
    horizon_s: int = 3600
    delay_target_min: float = 15.0
    # monitoring
    stale_min: float = 15.0
    degraded_min: float = 5.0
    error_rate: float = 0.20
    prediction_stale_min: float = 30.0
    pr_auc_tolerance: float = 0.02
    precision_floor: float = 0.8


DEFAULT = Thresholds()

# Poll cadence per source, in seconds.
CADENCE_S = {"states": 90, "metar": 600, "taf": 3600, "faa_status": 300}

# Widebody type designators. Not defined upstream, so callers may pass their own.
WIDEBODY_TYPES = (
    "A306", "A332", "A333", "A339", "A343", "A346", "A359", "A35K", "A388",
    "B744", "B748", "B763", "B764", "B772", "B77L", "B77W", "B788", "B789", "B78X",
    "MD11",
)
