"""Operations monitoring over the poll log and the program sightings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import CADENCE_S, DEFAULT, Thresholds
from tarmac.operators.joins import asof_join
from tarmac.operators.ordered import (
    gap_breaks, islands, running_last, running_sum, time_bucket, with_previous,
)


def poll_health(log: DataFrame, window: str | None = None) -> DataFrame:
    """Polls, failures, error rate, volume, median latency per source (and window).

    Latencies are logged in milliseconds, so the exact median merges small
    value-count maps and never holds a row per poll.
    """
    keys: list[Column] = [F.col("source")]
    if window:
        keys.append(F.window("started_at", window)["start"].alias("window_start"))
    hours = (F.unix_micros(F.max("started_at")) - F.unix_micros(F.min("started_at"))) / 3.6e9
    return log.groupBy(*keys).agg(
        F.count("*").alias("polls"),
        F.count_if(~F.col("ok")).alias("failures"),
        (F.count_if(~F.col("ok")) / F.count("*")).alias("error_rate"),
        F.try_divide(F.sum("rows_written"), hours).alias("rows_per_hour"),
        F.percentile(F.round("duration_seconds", 3), F.lit(0.5)).alias("median_latency"),
        F.count_if(F.col("ok") & (F.col("rows_written") == 0)).alias("empty_polls"),
        F.try_divide(F.sum("matched"), F.sum("nationwide")).alias("matched_ratio"),
    )


def freshness(
    log: DataFrame, now: Column, t: Thresholds = DEFAULT, key: str = "source", expected: DataFrame | None = None
) -> DataFrame:
    """Minutes since the last success per source, and what that means.

    ``expected`` lists the sources that ought to report (column ``key``); one that never did is
    stalled like one that never succeeded.
    """
    last = F.max(F.when(F.col("ok"), F.col("started_at")))
    minutes = (F.unix_micros(now) - F.unix_micros("last_success")) / F.lit(60_000_000)
    state = (
        F.when(F.col("last_success").isNull(), "stalled")
        .when(F.col("minutes_since_success") > t.stale_min, "stalled")
        .when(F.col("minutes_since_success") > t.degraded_min, "degraded")
        .otherwise("healthy")
    )
    seen = log.groupBy(key).agg(last.alias("last_success"))
    return (
        _with_silent(seen, expected, key)
        .withColumn("minutes_since_success", minutes)
        .withColumn("state", state)
    )


def _with_silent(seen: DataFrame, expected: DataFrame | None, key: str) -> DataFrame:
    """Subjects that have no rows at all beside those that have."""
    return seen if expected is None else seen.join(expected.select(key).distinct(), key, "full_outer")


def prediction_age(predictions: DataFrame, now: Column, expected: DataFrame | None = None) -> DataFrame:
    """Minutes since the last prediction per airport; null for an expected one that has none."""
    return _with_silent(predictions.groupBy("airport").agg(F.max("ts").alias("last_ts")), expected, "airport").withColumn(
        "minutes_since_prediction",
        (F.unix_micros(now) - F.unix_micros("last_ts")) / F.lit(60_000_000),
    )


def credit_ledger(
    log: DataFrame, limit: int, low_water: float = 0.1, bucket_s: int = 3600
) -> DataFrame:
    """Credits used after each poll, per UTC day.

    Every attempt costs one credit until the allowance is spent; a remaining count
    sent by the server (if not negative) replaces the local one.
    """
    if limit < 1:
        raise ValueError(f"an allowance of {limit} credits buys no poll")
    # Low water in whole credits, and never so low that the last credit goes unnoticed.
    floor = int(limit * low_water) or 1
    reported = F.col("credits_remaining")
    stated = F.when(
        reported.isNotNull() & (reported >= 0),
        F.greatest(F.lit(limit) - reported, F.lit(0)).cast("bigint"),
    )
    base = log.withColumn("day", F.to_date("started_at")).withColumn("__stated", stated)
    bucket = time_bucket("started_at", bucket_s)
    order = ["started_at", "poll_id"]
    summed = running_sum(base, ["day"], order, {"__spent": F.col("attempts")}, bucket=bucket)
    anchor = F.when(F.col("__stated").isNotNull(), F.struct("__stated", "__spent"))
    known = running_last(summed, ["day"], order, {"__anchor": anchor}, bucket=bucket)
    since = F.col("__spent") - F.coalesce(F.col("__anchor")["__spent"], F.lit(0))
    used = F.least(
        F.coalesce(F.col("__anchor")["__stated"], F.lit(0)) + since,
        F.greatest(F.lit(limit), F.coalesce(F.col("__anchor")["__stated"], F.lit(0))),
    )
    return (
        known.withColumn("used", used.cast("bigint"))
        .withColumn("remaining", F.greatest(F.lit(limit) - F.col("used"), F.lit(0)))
        .withColumn("low", F.col("remaining") <= floor)
        .withColumn("exhausted", F.col("used") >= limit)
        .drop("__stated", "__spent", "__anchor")
    )


def credit_days(ledger: DataFrame) -> DataFrame:
    """Per day: when the low-water mark and the end of the allowance were first reached."""
    at = F.col("started_at")
    return ledger.groupBy("day").agg(
        F.max("used").alias("peak_used"),
        F.min(F.when(F.col("low"), at)).alias("first_low"),
        F.min(F.when(F.col("exhausted"), at)).alias("first_exhausted"),
    )


def poll_gaps(
    log: DataFrame, cadence: dict[str, float] | None = None, factor: float = 3.0,
    keys: Sequence[str] = ("source",), bucket_s: int = 3600, default_s: float = 300.0,
) -> DataFrame:
    """Silences longer than ``factor`` times the cadence of their source."""
    cadence = CADENCE_S if cadence is None else cadence
    pairs = [F.lit(x) for k, v in cadence.items() for x in (k, float(v))]
    expected = F.lit(default_s)
    if pairs:
        expected = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), expected)
    seen = with_previous(
        log.filter("ok"), list(keys), ["started_at", "poll_id"], ["started_at"],
        bucket=time_bucket("started_at", bucket_s),
    )
    gap = (F.unix_micros("started_at") - F.unix_micros(F.col("prev")["started_at"])) / 1_000_000
    return (
        seen.withColumn("gap_s", gap).filter(F.col("gap_s") > expected * factor)
        .select(*keys, F.col("prev")["started_at"].alias("gap_start"), F.col("started_at").alias("gap_end"), "gap_s")
    )


def program_intervals(
    sightings: DataFrame, gap_s: float = 900, ts: str = "ingested_at",
    keys: Sequence[str] = ("airport", "event_type"), log: DataFrame | None = None,
    bucket_s: int = 3600, source: str | None = None,
) -> DataFrame:
    """Repeated sightings of a program as intervals.

    Keyed by airport and type, not by content: a program that is updated changes its
    text, and an identical stop on the next day is a new one. With the poll log, an
    interval is censored when no poll succeeded in the gap after its last sighting, so
    its end is not known. ``source`` names the poller of the sightings in the log; without it
    the log must hold that one alone.
    """
    labelled = islands(
        sightings, list(keys), [ts], gap_breaks(ts, gap_s),
        bucket=time_bucket(ts, bucket_s), name="__i",
    )
    spans = (
        labelled.groupBy(*keys, F.col("__i")[ts].alias("start_ts"))
        .agg(F.max(ts).alias("end_ts"), F.count("*").alias("sightings"))
        .withColumn("duration_s", (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1_000_000)
    )
    if log is None:
        return spans
    own = log.filter("ok") if source is None else log.filter(F.col("ok") & (F.col("source") == source))
    polls = own.select(F.lit(0).alias("__one"), F.col("started_at").alias("poll_ts"))
    probe = spans.withColumn("__one", F.lit(0)).withColumn(
        "__until", F.col("end_ts") + F.make_interval(secs=F.lit(gap_s))
    )
    seen = asof_join(
        probe, polls, ["__one"], "__until", "poll_ts", tolerance_s=int(gap_s),
        right_cols=["poll_ts"], bucket_s=max(int(gap_s), 3600),
    )
    alive = F.col("poll_ts").isNotNull() & (F.col("poll_ts") > F.col("end_ts"))
    return seen.withColumn("censored", ~alive).drop("__one", "__until", "poll_ts")


def hourly_series(
    df: DataFrame, ts: str, value: str, airport: str = "airport", back: int = 3,
    until: Column | None = None, hours: int = 24,
) -> DataFrame:
    """Dense hourly mean per airport with the change against ``back`` hours ago.

    With ``until`` only the last ``hours`` hours up to it are returned.
    """
    hourly = df.groupBy(
        F.col(airport).alias("airport"), F.date_trunc("hour", ts).alias("hour")
    ).agg(F.avg(value).alias("index_value"), F.count("*").alias("n"))
    span = hourly.groupBy("airport").agg(F.min("hour").alias("h0"), F.max("hour").alias("h1"))
    dense = span.select(
        "airport", F.explode(F.sequence("h0", "h1", F.make_interval(hours=F.lit(1)))).alias("hour")
    )
    w = Window.partitionBy("airport").orderBy("hour")
    out = dense.join(hourly, ["airport", "hour"], "left").withColumn(
        "delta", F.col("index_value") - F.lag("index_value", back).over(w)
    )
    if until is not None:
        end = F.date_trunc("hour", until)
        out = out.filter(
            (F.col("hour") <= end) & (F.col("hour") > end - F.make_interval(hours=F.lit(hours)))
        )
    return out.na.fill(0, ["n"])
