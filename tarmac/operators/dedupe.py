"""Collapsing repeated sightings of one fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.identity import identity_columns, payload_hash


def with_hash(df: DataFrame, exclude: Sequence[str] = ("airport",)) -> DataFrame:
    return df.withColumn("payload_hash", payload_hash(identity_columns(df.columns, exclude)))


def dedupe(
    df: DataFrame, seen: str = "ingested_at", airport: str | None = "airport",
    key: str = "payload_hash", drop: Sequence[str] = ("poll_id", "response_time"),
) -> DataFrame:
    """One row per content hash with first and last seen, count and observing airports.

    Copies are merged inside each task before the shuffle, so a fact seen a billion
    times crosses the network once per task. Equal hashes carry equal content, so
    any copy may supply the content columns.
    """
    skip = {seen, key, *drop} | ({airport} if airport else set())
    content = [c for c in df.columns if c not in skip]
    aggs = [F.first(c).alias(c) for c in content]
    aggs += [
        F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"),
        F.count("*").alias("times_seen"),
    ]
    if airport:
        aggs.append(F.sort_array(F.collect_set(airport)).alias("seen_from"))
    return df.groupBy(key).agg(*aggs)


def one_point_per_instant(
    df: DataFrame, key: str = "icao24", ts: str = "last_contact", rank: str = "payload_hash"
) -> DataFrame:
    """At most one point per aircraft and instant; the smallest ``rank`` is kept."""
    rest = [c for c in df.columns if c not in (key, ts)]
    return (
        df.groupBy(key, ts)
        .agg(F.min_by(F.struct(*rest), F.col(rank)).alias("__p"))
        .select(key, ts, "__p.*")
    )
