"""Joins: lookups, boxes, nearest airport, as-of and interval conditions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import geo
from tarmac.operators.ordered import BUCKET, HOME, bucket_window, running_last, so_far, with_halo
from tarmac.operators.ordered import time_bucket

CELL_DEG = 1.0
# The largest box an airport may have, and the latitude up to which airports lie.
LARGEST_BOX_NM, LAST_AIRPORT_LAT = 250.0, 83.0


def box_reach_nm(radius_nm: float = LARGEST_BOX_NM, lat: float = LAST_AIRPORT_LAT) -> float:
    """An upper bound of the distance from an airport to a corner of its box, up to a latitude.

    A box is as wide in degrees at its equator-ward edge as at its centre, where a degree is shorter.
    """
    high = radius_nm / geo.NM_PER_DEGREE
    half = radius_nm / (geo.NM_PER_DEGREE * max(math.cos(math.radians(lat)), geo.MIN_COS_LAT))
    return geo.NM_PER_DEGREE * math.hypot(high, half * math.cos(math.radians(lat - high)))


def tracked_events(events: DataFrame, airports: DataFrame, code: str = "airport") -> DataFrame:
    """Keep the nationwide events whose airport code is one of ours."""
    codes = airports.select(F.col("faa_code").alias(code)).distinct()
    return events.join(codes, code, "left_semi")


def resolve_airports(active: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference rows of the active codes, in the order given by ``ordinal``.

    ``active`` has (ordinal, icao). A code without a reference row is an error.
    """
    unknown = active.join(reference.select("icao"), "icao", "left_anti")
    missing = [r["icao"] for r in unknown.select("icao").distinct().orderBy("icao").limit(20).collect()]
    if missing:
        raise ValueError(f"unknown airport(s): {', '.join(missing)}")
    return active.join(reference, "icao", "inner").orderBy("ordinal")


def with_airport_keys(df: DataFrame, airports: DataFrame, key: str, on: str) -> DataFrame:
    """Attach icao, metar_station and faa_code, matching column ``key`` to ``on``."""
    keys = ("icao", "metar_station", "faa_code")
    dim = airports.select(F.col(on).alias("__on"), *keys).dropDuplicates(["__on"])
    return (
        df.join(dim, F.col(key) == F.col("__on"), "left").drop("__on")
    )


def _cell(c: Column) -> Column:
    return F.floor(c / F.lit(CELL_DEG)).cast("int")


def _cells_of_boxes(boxes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row per grid cell with the airports whose rectangle touches the cell.

    Expects lamin, lamax, lomin, lomax. Longitude cells wrap at the antimeridian, so
    a rectangle may reach beyond 180 degrees. The array of a cell is bounded by how
    many airports lie around one square degree. Whether the cells are broadcast is left
    to Spark's own estimate of their size.
    """
    wrap = int(360 / CELL_DEG)
    edges = boxes.withColumns(
        {
            "__a0": _cell(F.col("lamin")), "__a1": _cell(F.col("lamax")),
            "__o0": _cell(F.col("lomin")), "__o1": _cell(F.col("lomax")),
        }
    )
    cells = (
        edges.withColumn("__la", F.explode(F.sequence("__a0", "__a1")))
        .withColumn("__lo", F.explode(F.sequence("__o0", "__o1")))
        .withColumn("__lo", F.pmod(F.col("__lo"), F.lit(wrap)))
        .groupBy("__la", "__lo")
        .agg(F.sort_array(F.collect_set(F.struct(*payload))).alias("__near"))
    )
    return cells


def _with_cell(obs: DataFrame, lat: str, lon: str) -> DataFrame:
    wrap = int(360 / CELL_DEG)
    return obs.withColumn("__la", _cell(F.col(lat))).withColumn(
        "__lo", F.pmod(_cell(F.col(lon)), F.lit(wrap))
    )


def assign_boxes(
    obs: DataFrame, airports: DataFrame, radius_nm: float,
    lat: str = "latitude", lon: str = "longitude", name: str = "airport",
) -> DataFrame:
    """One row per (observation, airport box holding it); overlaps give several.

    An equi-join on grid cells brings each row the few boxes of its cell, so no
    nested loop over the airports is needed.
    """
    box = geo.bounding_box(F.col("lat"), F.col("lon"), radius_nm)
    edges = ("lamin", "lamax", "lomin", "lomax")
    boxes = airports.withColumn("__b", box).select("icao", *[F.col("__b")[e].alias(e) for e in edges])
    cells = _cells_of_boxes(boxes, ("icao", *edges))
    hits = F.filter("__near", lambda b: geo.in_bbox(F.col(lat), F.col(lon), b))
    return (
        _with_cell(obs, lat, lon)
        .join(cells, ["__la", "__lo"], "inner")
        .withColumn(name, F.explode(F.transform(hits, lambda b: b["icao"])))
        .drop("__la", "__lo", "__near")
    )


def nearest_airport(
    obs: DataFrame, airports: DataFrame, max_nm: float | None = None,
    lat: str = "latitude", lon: str = "longitude",
    name: str = "nearest_icao", dist: str = "nearest_nm",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Nearest airport within ``max_nm`` of each row; nulls beyond. Ties by icao.

    Without a limit the reach is the farthest corner of the largest legal box, so every row
    that a box holds finds an airport.

    Each airport is filed under the grid cells its circle can touch. A row meets only
    the airports of its own cell, keeps its single row and is not shuffled.
    ``extra`` names further airport columns to attach.
    """
    max_nm = box_reach_nm() if max_nm is None else max_nm
    reach = math.degrees(max_nm / geo.EARTH_RADIUS_NM)
    half = geo.lon_reach_deg(F.col("lat"), max_nm)
    boxes = airports.select(
        "icao", "lat", "lon", *extra,
        F.greatest(F.col("lat") - reach, F.lit(-90.0)).alias("lamin"),
        F.least(F.col("lat") + reach, F.lit(90.0)).alias("lamax"),
        (F.col("lon") - half).alias("lomin"),
        (F.col("lon") + half).alias("lomax"),
    )
    cells = _cells_of_boxes(boxes, ("icao", "lat", "lon", *extra))
    ranked = F.transform(
        "__near",
        lambda a: F.struct(
            geo.distance_nm(F.col(lat), F.col(lon), a["lat"], a["lon"]).alias("nm"),
            a["icao"].alias("icao"),
            *[a[e].alias(e) for e in extra],
        ),
    )
    best = F.array_min(F.filter(ranked, lambda r: r["nm"] <= max_nm))
    out = (
        _with_cell(obs, lat, lon)
        .join(cells, ["__la", "__lo"], "left")
        .withColumn("__best", best)
    )
    return out.select(
        *[c for c in obs.columns],
        F.col("__best")["icao"].alias(name),
        F.col("__best")["nm"].alias(dist),
        *[F.col("__best")[e].alias(e) for e in extra],
    )


def unique_aircraft(aircraft: DataFrame, key: str = "icao24") -> DataFrame:
    """One register row per key: the most filled in, then the smallest by value."""
    rest = sorted(c for c in aircraft.columns if c != key)
    filled = sum((F.col(c).isNotNull().cast("int") for c in rest), F.lit(0))
    rank = F.struct(
        (-filled).alias("f"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rest],
    )
    return (
        aircraft.groupBy(key)
        .agg(F.min_by(F.struct(*[c for c in aircraft.columns if c != key]), rank).alias("__a"))
        .select(key, "__a.*")
    )


def with_aircraft(obs: DataFrame, aircraft: DataFrame, key: str = "icao24") -> DataFrame:
    """Left lookup into the register; repeated register keys do not multiply rows."""
    return obs.join(unique_aircraft(aircraft, key), key, "left")


def asof_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
    *, tolerance_s: int | None = None, right_cols: Sequence[str] | None = None,
    right_tie: Sequence[str] = (), bucket_s: int = 3600, prefix: str = "",
) -> DataFrame:
    """Latest right row at or before each left row, per key; left rows all stay.

    Both sides are stacked and scanned once in time order. With a tolerance, right
    rows are copied into the buckets they can still reach; without one, the last right
    row of each bucket is carried forward. Among right rows of one instant the
    greatest by ``right_tie`` is used.
    """
    cols = list(right_cols or [c for c in right.columns if c not in {*on}])
    need = list(dict.fromkeys([*cols, right_ts]))
    rstruct = F.struct(*need)
    rtype = right.select(rstruct.alias("r")).schema["r"].dataType
    tie = F.struct(*right_tie) if right_tie else F.struct(F.lit(0).alias("z"))
    ttype = right.select(tie.alias("t")).schema["t"].dataType
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()

    stacked_right = right.filter(known & F.col(right_ts).isNotNull()).select(
        *on, F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"), tie.alias("__tie"),
        rstruct.alias("__r"), F.lit(None).cast(left.select(F.struct("*").alias("l")).schema["l"].dataType).alias("__l"),
    )
    stacked_left = left.select(
        *on, F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"), F.lit(None).cast(ttype).alias("__tie"),
        F.lit(None).cast(rtype).alias("__r"), F.struct("*").alias("__l"),
    )
    order = ["__ts", "__side", "__tie"]
    if tolerance_s is None:
        both = stacked_right.unionByName(stacked_left)
        # Left rows without a key or time match nothing and must not meet the carry join.
        usable = known & F.col("__ts").isNotNull()
        found = running_last(
            both.filter(usable), on, order, {"__hit": F.col("__r")},
            bucket=time_bucket("__ts", bucket_s),
        ).filter("__side = 1").select("__l", "__hit")
        rest = both.filter(~usable).select("__l", F.lit(None).cast(rtype).alias("__hit"))
        found = found.unionByName(rest)
        ok = F.lit(True)
    else:
        both = with_halo(
            stacked_right, "__ts", width_s=bucket_s, lookback_s=tolerance_s
        ).unionByName(
            stacked_left.withColumn(HOME, time_bucket("__ts", bucket_s)).withColumn(BUCKET, F.col(HOME))
        )
        w = so_far(bucket_window(on, order))
        found = both.withColumn("__hit", F.last("__r", ignorenulls=True).over(w)).filter("__side = 1")
        age = F.unix_micros("__l." + left_ts) - F.unix_micros("__hit." + right_ts)
        ok = (age <= tolerance_s * 1_000_000) & known
    return found.select(
        "__l.*", *[F.when(ok, F.col("__hit")[c]).alias(prefix + c) for c in cols]
    )


def covered_windows(
    start: Column, end: Column, window_s: int, reach_s: int = 0, closed: bool = False
) -> Column:
    """Starts of the windows [w, w + window + reach) that meet [start, end), as an array.

    With ``closed`` the end belongs to the interval, so a single sighting counts.
    Empty when the interval is empty or either end is unknown.
    """
    width = F.lit(window_s)
    s, e = F.unix_micros(start) / 1_000_000, F.unix_micros(end) / 1_000_000
    first = (F.floor((s - reach_s - window_s) / width) + 1) * width
    last = (F.floor(e / width) if closed else F.ceil(e / width) - 1) * width
    span = F.sequence(F.timestamp_seconds(first), F.timestamp_seconds(last), F.make_interval(secs=width))
    return F.when(((e >= s) if closed else (e > s)) & (last >= first), span)


def active_programs(
    programs: DataFrame, window_s: int = 900,
    start: str = "start_ts", end: str = "end_ts", kind: str = "event_type",
) -> DataFrame:
    """(airport, window_start) with a flag per program kind overlapping the window.

    Each interval is laid onto the windows it covers and reduced before any join, so
    the caller adds it with an equi-join.
    """
    return (
        programs.withColumn(
            "window_start",
            F.explode(covered_windows(F.col(start), F.col(end), window_s, closed=True)),
        )
        .groupBy("airport", "window_start")
        .agg(
            F.bool_or(F.col(kind) == "ground_stop").alias("ground_stop_active"),
            F.bool_or(F.col(kind) == "ground_delay").alias("ground_delay_active"),
            F.bool_or(F.col(kind) == "closure").alias("closure_active"),
            F.count("*").alias("programs_active"),
        )
    )


def forecast_outlook(
    periods: DataFrame, window_s: int = 900, horizon_s: int = 7200,
    issued: str = "issued_at", start: str = "time_from", end: str = "time_to",
    severity: str = "severity",
) -> DataFrame:
    """(airport, window_start) with the worst forecast severity in the next hours.

    A period counts for window w when it overlaps [w, w + horizon) and had been
    issued by w, so no later forecast leaks into an earlier window.
    """
    reach = max(horizon_s - window_s, 0)
    return (
        periods.withColumn(
            "window_start",
            F.explode(covered_windows(F.col(start), F.col(end), window_s, reach)),
        )
        .filter(F.col(issued) <= F.col("window_start"))
        .groupBy("airport", "window_start")
        .agg(F.max(severity).alias("worst_ahead"))
    )


def with_outlook(windows: DataFrame, outlook: DataFrame, now_severity: str = "now_severity") -> DataFrame:
    """Flag windows for which a worse forecast than the present lies ahead."""
    return windows.join(outlook, ["airport", "window_start"], "left").withColumn(
        "deteriorating",
        F.coalesce(F.col("worst_ahead") > F.col(now_severity), F.lit(False)),
    )


def build_dataset(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and targets of the same airport and window."""
    return features.join(labels, ["airport", "window_start"], "inner")


def backfill_truth(predictions: DataFrame, outcomes: DataFrame, window_s: int = 900) -> DataFrame:
    """Past predictions with the outcome of the window they were made in, once known."""
    start = F.unix_seconds("ts") - F.pmod(F.unix_seconds("ts"), F.lit(window_s))
    keyed = predictions.withColumn("window_start", F.timestamp_seconds(start))
    return keyed.join(outcomes, ["airport", "window_start"], "left")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by the order columns, all descending.

    Spark keeps one candidate per key in every task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
