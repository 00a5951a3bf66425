"""Landing, silver, windows and sessions as streams; late rows, restart and backfill."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.operators.dedupe import with_hash
from tarmac.schemas import SCHEMAS
from tarmac.session import settings
from tarmac.sources.lake import exists, overwrite_days


def stream_landing(
    spark: SparkSession, path: str, schema: StructType | None = None, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Landed payload files as a stream; the schema is pinned, never inferred."""
    reader = spark.readStream.schema(schema or SCHEMAS["landing"])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_silver(
    bronze: DataFrame, delay: str = "2 hours", seen: str = "ingested_at", exclude: tuple[str, ...] = ("airport",)
) -> DataFrame:
    """First sighting of every content within the watermark.

    Last-seen times and program intervals need every sighting and read bronze instead.
    """
    hashed = bronze if "payload_hash" in bronze.columns else with_hash(bronze, exclude)
    return hashed.withWatermark(seen, delay).dropDuplicatesWithinWatermark(["payload_hash"])


def stream_windows(
    df: DataFrame, ts: str = "ts", airport: str = "airport", width: str = "15 minutes", delay: str = "15 minutes"
) -> DataFrame:
    """Counts per airport and window, emitted once the watermark has passed the window."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"), F.col(airport).alias("airport"))
        .agg(F.count("*").alias("n"))
        .select("airport", F.col("w")["start"].alias("window_start"), "n")
    )


def stream_segments(
    df: DataFrame, gap: str = "15 minutes", ts: str = "ts", key: str = "icao24", delay: str = "15 minutes"
) -> DataFrame:
    """Track segments as session windows; equal to the batch segments on closed ones.

    A session ends one gap after its last point, so the gap is taken off again.
    """
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap).alias("s"), F.col(key).alias(key))
        .agg(F.max(ts).alias("segment_end"), F.count("*").alias("points"))
        .select(key, F.col("s")["start"].alias("segment_start"), "segment_end", "points")
    )


def start(
    df: DataFrame, checkpoint: str, *, path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None, mode: str = "append", once: bool = True,
    conf: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start a query that resumes from its checkpoint, with ``conf`` for it alone.

    A file sink commits each batch as a whole, so a restart loses at most the batch in
    flight and leaves no partial file.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    if each_batch is None and path is None:
        raise ValueError("either path or each_batch is needed")
    with settings(df.sparkSession, conf or {}):
        if each_batch is not None:
            return writer.foreachBatch(each_batch).start()
        return writer.format("parquet").option("path", path).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an availableNow query; its failure becomes ours."""
    query.awaitTermination()


def merge_late(
    batch: DataFrame, path: str, ts: str, schema: StructType, key: str = "payload_hash", day: str = "date",
    tie: str | None = None,
) -> None:
    """Bring a micro-batch into the event-dated table by adding what it does not hold yet.

    Rows whose key is there already, on the same day, are left out, so replaying a batch changes
    nothing; only the partitions of the batch's days are read, and none is rewritten. Of equal
    keys in the batch the row that is smallest by ``tie`` and its other columns stays. ``compact``
    folds the small files later.
    """
    spark = batch.sparkSession
    names = [f.name for f in schema.fields]
    full = StructType([*schema.fields, StructField(day, StringType())])
    fresh = batch.select(*names).withColumn(day, F.date_format(ts, "yyyy-MM-dd"))
    order = F.struct(*([F.col(tie)] if tie else []), *[F.to_json(F.struct(c)).alias(f"j{i}") for i, c in enumerate(names)])
    one = fresh.groupBy(key, day).agg(F.min_by(F.struct(*[c for c in fresh.columns if c not in (key, day)]), order).alias("__row"))
    one = one.select(key, day, "__row.*").select(*names, day)
    if exists(spark, path):
        held = spark.read.schema(full).parquet(path).select(key, day).join(one.select(day).distinct(), day, "left_semi")
        one = one.join(held, [key, day], "left_anti").select(*names, day)
    one.write.mode("append").option("compression", "zstd").partitionBy(day).parquet(path)


def backfill(job: Callable[[datetime, datetime], DataFrame], path: str, ts: str, begin: datetime, end: datetime) -> None:
    """Run a job over [begin, end) and replace exactly those days; safe to repeat.

    Bounds lie on midnight, so no day is replaced by part of itself.
    """
    for bound in (begin, end):
        if bound != bound.replace(hour=0, minute=0, second=0, microsecond=0):
            raise ValueError("backfill bounds must be midnights")
    if end - begin < timedelta(days=1):
        raise ValueError("the range is empty")
    rows = job(begin, end).filter((F.col(ts) >= F.lit(begin)) & (F.col(ts) < F.lit(end)))
    overwrite_days(rows, path, ts)
