"""All feeds from one landing: a stream of response bodies, routed by source into bronze and quarantine.

Every micro-batch is routed inside ``foreachBatch``, so each source is parsed and judged by the same
functions as in batch. Rows go to their layer under the micro-batch's name in the ledger,
so one that was cut off anywhere is completed when it is run again, and nothing is brought twice. Rows that break
a rule, bodies that cannot be read and bodies of unknown sources go to ``quarantine`` with their reasons.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.operators import quality
from tarmac.schemas import SCHEMAS
from tarmac.sources import faa, lake, states, weather
from tarmac.streaming import flows


@dataclass(frozen=True)
class Feed:
    """How one source is read, judged, and found to be unreadable as a whole."""

    parse: Callable[[DataFrame], DataFrame]
    judge: Callable[[DataFrame], DataFrame]
    unreadable: Callable[[DataFrame], DataFrame]


FEEDS = {
    "states": Feed(states.parse_states, quality.validate_states, states.unreadable_states),
    "metar": Feed(weather.parse_metar, quality.validate_weather, lambda df: weather.unreadable_list(df, weather.METAR_JSON)),
    "taf": Feed(weather.parse_taf, quality.validate_weather, lambda df: weather.unreadable_list(df, weather.TAF_JSON)),
    "faa_status": Feed(faa.parse_faa, lambda df: quality.with_reasons(df, {"airport": F.col("airport").isNull()}), faa.unreadable_faa),
}


def landing_schema() -> StructType:
    return StructType([StructField("source", StringType()), *SCHEMAS["landing"].fields])


def _set_aside(rows: DataFrame, source: str | Column, reasons: Column, row: Column) -> DataFrame:
    name = F.lit(source) if isinstance(source, str) else source
    return rows.select("poll_id", "ingested_at", name.alias("source"), reasons.alias("reasons"), row.alias("row"))


def route(landed: DataFrame, root: str, batch: str) -> dict[str, lake.WriteResult]:
    """Bring one batch of (source, landing columns) to all its layers; what was written where.

    The batch is held while it is routed, since every feed reads its part of it, and so are a feed's
    judged rows, which go to two layers. Bodies are dealt out over all tasks first: a file is read by
    few tasks, however long it takes to parse.
    """
    width = int(landed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    landed = landed.repartition(width).persist(StorageLevel.DISK_ONLY)
    held = [landed]
    try:
        done, aside = {}, []
        for source, feed in FEEDS.items():
            own = landed.filter(F.col("source") == source)
            judged = feed.judge(feed.parse(own)).persist(StorageLevel.DISK_ONLY)
            held.append(judged)
            done[source] = lake.append_bronze(quality.accepted(judged), root, source, batch=batch)
            whole = F.to_json(F.struct(*[c for c in judged.columns if c != quality.REASONS]))
            aside.append(_set_aside(quality.rejected(judged), source, F.col(quality.REASONS), whole))
            aside.append(_set_aside(feed.unreadable(own), source, F.array(F.lit("unreadable")), F.col("body")))
        unknown = landed.filter(F.col("source").isNull() | ~F.col("source").isin(*FEEDS))
        aside.append(_set_aside(unknown, F.col("source"), F.array(F.lit("source")), F.col("body")))
        done["quarantine"] = lake.append_bronze(lake.union_layers(*aside), root, "quarantine", batch=batch)
        return done
    finally:
        for frame in held:
            frame.unpersist()


def start_feeds(
    spark: SparkSession, landing: str, root: str, checkpoint: str, name: str = "feeds", files_per_trigger: int | None = None
) -> StreamingQuery:
    """Route the landing folder from its checkpoint on; ``name`` stands for this checkpoint in the ledger.

    The number of bodies of each source is observed on the way and stands in the query's progress.
    """
    stream = flows.stream_landing(spark, landing, landing_schema(), files_per_trigger)
    stream = stream.observe("landed", *[F.count_if(F.col("source") == s).alias(s) for s in FEEDS], F.count(F.lit(1)).alias("bodies"))
    return flows.start(stream, checkpoint, each_batch=lambda df, batch_id: route(df, root, f"{name}-{batch_id}") and None)
