"""Row rules, quarantine, batch gates and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import DEFAULT, Thresholds
from tarmac.functions import geo

REASONS = "reject_reasons"


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Array of the names of the rules a row breaks; each rule says what is *bad*.

    A rule that cannot be decided because an input is null is not broken.
    """
    broken = F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return df.withColumn(REASONS, F.filter(broken, lambda x: x.isNotNull()))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.size(REASONS) > 0)


def _outside(c: str, low: float, high: float) -> Column:
    return ~F.col(c).between(low, high)


def state_rules(columns: Sequence[str]) -> dict[str, Column]:
    rules = {
        "icao24": F.coalesce(~F.col("icao24").rlike("^[0-9a-f]{6}$"), F.lit(True)),
        "latitude": _outside("latitude", -90, 90),
        "longitude": _outside("longitude", -180, 180),
        "velocity": F.col("velocity_ms") < 0,
        "track": _outside("true_track_deg", 0, 360),
        "last_contact": F.col("last_contact").isNull(),
        "on_ground": F.col("on_ground").isNull(),
        "spi": F.col("spi").isNull() if "spi" in columns else F.lit(False),
    }
    if "n_elements" in columns:
        rules["elements"] = F.coalesce(F.col("n_elements") < 17, F.lit(True))
    if "misread" in columns:
        rules["misread"] = F.col("misread")
    return rules


def validate_states(df: DataFrame) -> DataFrame:
    return with_reasons(df, state_rules(df.columns))


def validate_silver(df: DataFrame) -> DataFrame:
    """Range rules of the typed layer; only those whose columns are present apply."""
    rules: dict[str, Column] = {}
    if "baro_altitude_m" in df.columns:
        rules["altitude"] = geo.m_to_ft(F.col("baro_altitude_m")) < -100
    if "wind_speed_kt" in df.columns:
        rules["wind"] = F.col("wind_speed_kt") > 200
    if "latitude" in df.columns:
        rules["latitude"] = _outside("latitude", -90, 90)
        rules["longitude"] = _outside("longitude", -180, 180)
    return with_reasons(df, rules)


def validate_weather(df: DataFrame) -> DataFrame:
    """Required keys of an observation or forecast."""
    rules = {"station": F.col("station").isNull()}
    if "obs_time" in df.columns:
        rules["obs_time"] = F.col("obs_time").isNull()
    if "misread" in df.columns:
        rules["misread"] = F.col("misread")
    return with_reasons(df, rules)


def reject_summary(df: DataFrame, source: Column, ts: str) -> DataFrame:
    """Rejected rows by source, day and reason (a row counts once per reason)."""
    return (
        df.select(
            source.alias("source"), F.to_date(ts).alias("day"), F.explode(REASONS).alias("reason")
        )
        .groupBy("source", "day", "reason")
        .agg(F.count("*").alias("rows_rejected"))
    )


def batch_gate(
    df: DataFrame, batch: Sequence[str], order: str, max_bad: float = 0.1,
    trailing: int = 5, spike: float = 3.0, within: Sequence[str] = (),
) -> DataFrame:
    """Verdict per batch: bad share, rejected or not, and a spike flag.

    A spike is a bad share above ``spike`` times the mean of the trailing batches of
    the same ``within`` group. Only the one-row-per-batch summary is ordered.
    """
    bad = F.size(REASONS) > 0
    per = df.groupBy(*batch).agg(
        F.count("*").alias("rows_total"), F.count_if(bad).alias("rows_bad")
    )
    share = F.col("rows_bad") / F.col("rows_total")
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(-trailing, -1)
    return (
        per.withColumn("bad_share", share)
        .withColumn("trailing_share", F.avg("bad_share").over(w))
        .withColumn("rejected", F.col("bad_share") > max_bad)
        .withColumn(
            "spike",
            F.coalesce(F.col("bad_share") > spike * F.col("trailing_share"), F.lit(False)),
        )
    )


def completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count per required column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols], F.count("*").alias("__n"))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols]
    )
    return counts.select(F.explode(pairs).alias("p"), "__n").select(
        "p.column_name", "p.nulls", F.col("__n").alias("rows_total")
    )


def check_airports(df: DataFrame) -> DataFrame:
    """Every violated constraint of an airport dimension: (icao, problem)."""
    code = r"^[A-Z]{4}$"

    def not_like(c: str, pattern: str) -> Column:
        return F.coalesce(~F.col(c).rlike(pattern), F.lit(True))

    rules = {
        "icao": not_like("icao", code),
        "name": F.coalesce(F.length("name") < 1, F.lit(True)),
        "lat": F.coalesce(_outside("lat", -90, 90), F.lit(True)),
        "lon": F.coalesce(_outside("lon", -180, 180), F.lit(True)),
        "metar_station": not_like("metar_station", code),
        "faa_code": not_like("faa_code", r"^[A-Z0-9]{3}$"),
    }
    broken = with_reasons(df, rules).select("icao", F.explode(REASONS).alias("problem"))
    repeats = (
        df.groupBy("icao").count().filter("count > 1")
        .select("icao", F.lit("duplicate").alias("problem"))
    )
    return broken.unionByName(repeats)


def alerts(
    health: DataFrame, fresh: DataFrame, predictions: DataFrame, t: Thresholds = DEFAULT
) -> DataFrame:
    """One row per firing rule: (rule, subject, measured, threshold).

    ``health`` has (source, error_rate), ``fresh`` (source, minutes_since_success) and
    ``predictions`` (airport, minutes_since_prediction).
    """

    def fire(df: DataFrame, rule: str, subject: str, value: str, limit: float) -> DataFrame:
        never = F.col(value).isNull()
        return df.filter((F.col(value) > limit) | never).select(
            F.lit(rule).alias("rule"), F.col(subject).alias("subject"),
            F.col(value).cast("double").alias("measured"), F.lit(float(limit)).alias("threshold"),
        )

    return (
        fire(fresh, "stale_source", "source", "minutes_since_success", t.stale_min)
        .unionByName(fire(health.filter("error_rate is not null"), "error_rate", "source", "error_rate", t.error_rate))
        .unionByName(
            fire(predictions, "no_predictions", "airport", "minutes_since_prediction", t.prediction_stale_min)
        )
    )
