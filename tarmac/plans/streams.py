"""Streaming queries (S15, R1-R7): each runs to the end of its input and is read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.operators import quality, tracks
from tarmac.operators.dedupe import with_hash
from tarmac.plans.intake import drawn_together, faa_bodies, metar_bodies, state_bodies, taf_bodies
from tarmac.plans.joining import airports
from tarmac.plans.registry import query
from tarmac.plans.tracking import GO_AROUNDS, HOLD_HITS
from tarmac.plans.views import Tables, _sql
from tarmac.session import scratch_dir
from tarmac.sources import lake, states
from tarmac.streaming import events as ev
from tarmac.streaming import feeds, flows


def live(t: Tables, view: str) -> DataFrame:
    """A view over the events table, read as a stream."""
    schema = t.table("events").schema
    raw = flows.stream_landing(t.spark, t.sf_dir, schema, glob="events.parquet")
    return t.spark.sql(_sql(view, 0), events=raw)


def finish(t: Tables, df: DataFrame, name: str, conf: dict[str, str] | None = None) -> DataFrame:
    """Run a streaming frame to the end of its input and read what it wrote."""
    root = scratch_dir(t.spark, name)
    flows.run_to_end(flows.start(df, f"{root}/checkpoint", path=f"{root}/out", conf=conf))
    return t.spark.read.schema(df.schema).parquet(f"{root}/out")


@query("s15_stream_landing", [], """
    SELECT event_type AS origin_country, event_id % 10 = 0 AS on_ground, count(*) AS n, count(*) FILTER (WHERE event_id % 37 = 5 OR event_id % 97 = 13 OR event_id % 103 = 4) AS rejected
    FROM events GROUP BY ALL""")
def s15(t: Tables):
    path = scratch_dir(t.spark, "landing")
    state_bodies(t).write.parquet(path)
    judged = quality.validate_states(states.parse_states(flows.stream_landing(t.spark, path)))
    out = finish(t, judged.select("origin_country", "on_ground", F.size(quality.REASONS).alias("broken")), "landed")
    return out.groupBy("origin_country", "on_ground").agg(F.count("*").alias("n"), F.count_if(F.col("broken") > 0).alias("rejected"))


@query("s15_mixed_feeds", [], """
    SELECT 'states' AS source, count(*) FILTER (WHERE NOT bad) AS n_rows, count(*) FILTER (WHERE bad) AS rejected FROM (SELECT event_id % 37 = 5 OR event_id % 97 = 13 OR event_id % 103 = 4 AS bad FROM events) e
    UNION ALL SELECT 'metar', count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad) FROM (SELECT event_id % 61 = 3 OR event_id % 53 = 2 AS bad FROM events) e
    UNION ALL SELECT 'taf', count(*), 0 FROM events
    UNION ALL SELECT 'faa_status', count(*) FILTER (WHERE event_id % 4 < 3 AND event_id % 17 <> 4) + count(*) FILTER (WHERE event_id % 4 = 2), 0 FROM events""")
def s15m(t: Tables):
    # Four feeds land together in two deliveries, each a micro-batch that is routed and entered once.
    root = scratch_dir(t.spark, "feeds")
    bodies = {"states": state_bodies(t), "metar": metar_bodies(t), "taf": taf_bodies(t), "faa_status": faa_bodies(t)}
    mixed = lake.union_layers(*[b.select(F.lit(s).alias("source"), *[f.name for f in feeds.landing_schema().fields[1:]]) for s, b in bodies.items()])
    mixed.withColumn("ingested_at", drawn_together("ingested_at")).write.parquet(f"{root}/all")
    part = F.pmod(F.xxhash64("source", "poll_id"), F.lit(2))
    for i in range(2):
        # The second start goes on from the checkpoint of the first.
        t.spark.read.parquet(f"{root}/all").filter(part == i).write.mode("append").parquet(f"{root}/in")
        flows.run_to_end(feeds.start_feeds(t.spark, f"{root}/in", root, f"{root}/checkpoint"))
    rows = [lake.read_layer(t.spark, root, s).select(F.lit(s).alias("source"), F.lit(1).alias("n"), F.lit(0).alias("bad")) for s in bodies]
    aside = lake.read_layer(t.spark, root, "quarantine").select("source", F.lit(0).alias("n"), F.lit(1).alias("bad"))
    return lake.union_layers(*rows, aside).groupBy("source").agg(F.sum("n").alias("n_rows"), F.sum("bad").alias("rejected"))


@query("r01_stream_silver", ["v_bronze"], "SELECT icao24, origin_country, level, count(*) AS copies FROM (SELECT DISTINCT icao24, origin_country, level FROM v_bronze) d GROUP BY ALL")
def r01(t: Tables):
    once = flows.stream_silver(live(t, "v_bronze"), delay="60 days")
    return finish(t, once.select("icao24", "origin_country", "level", "payload_hash"), "silver").groupBy("icao24", "origin_country", "level").agg(F.count("*").alias("copies"))


@query("r02_stream_windows", ["v_flight"], """
    SELECT departure_airport AS airport, time_bucket(INTERVAL 15 MINUTE, first_seen) AS window_start, count(*) AS n FROM v_flight GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 15 MINUTE, first_seen) + INTERVAL 30 MINUTE <= (SELECT max(first_seen) FROM v_flight)""")
def r02(t: Tables):
    df = live(t, "v_flight").select(F.col("departure_airport").alias("airport"), F.col("first_seen").alias("ts"))
    return finish(t, flows.stream_windows(df), "windows")


@query("r03_stream_segments", ["v_flight"], """
    SELECT icao24, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS points FROM (
      SELECT icao24, ts, sum(fresh) OVER (PARTITION BY icao24 ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT icao24, first_seen AS ts, CASE WHEN first_seen - lag(first_seen) OVER (PARTITION BY icao24 ORDER BY first_seen) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM v_flight) f) g
    GROUP BY icao24, s HAVING max(ts) + INTERVAL 6 HOUR + INTERVAL 15 MINUTE <= (SELECT max(first_seen) FROM v_flight)""")
def r03(t: Tables):
    df = live(t, "v_flight").select("icao24", F.col("first_seen").alias("ts"))
    return finish(t, flows.stream_segments(df, gap="6 hours"), "segments")


# Points that the last watermark has passed, with the minute that an alert may be held back.
_CLOSED = "ceil(epoch(ts) / 60) * 60 + 900 <= (SELECT epoch(max(last_contact)) FROM v_track)"


@query("r04_stream_events", ["v_track"], f"""
    SELECT 'go-around' AS kind, airport, icao24, ts, low_ts AS since FROM {GO_AROUNDS} g WHERE {_CLOSED}
    UNION ALL SELECT 'hold', airport, icao24, ts, since FROM (SELECT airport, icao24, make_timestamp(CAST(sec * 1000000 AS BIGINT)) AS ts,
      make_timestamp(CAST(first_sec * 1000000 AS BIGINT)) AS since FROM {HOLD_HITS} h WHERE holding) h WHERE {_CLOSED}""")
def r04(t: Tables):
    points = tracks.track_points(live(t, "v_track"), airports(t))
    return finish(t, ev.stream_events(points), "alerts", ev.STATE_STORE)


@query("r05_merge_late", ["v_bronze"], """
    SELECT strftime(first_seen, '%Y-%m-%d') AS date, count(*) AS n, count(DISTINCT icao24) AS aircraft FROM
      (SELECT icao24, date_trunc('day', ingested_at) AS first_seen FROM v_bronze GROUP BY icao24, origin_country, level, date_trunc('day', ingested_at)) d GROUP BY 1""")
def r05(t: Tables):
    root = scratch_dir(t.spark, "late")
    rows = with_hash(t.v_bronze).select("icao24", "origin_country", "level", "ingested_at", "payload_hash")
    # Two deliveries: the second holds rows for days that the first has closed.
    late = F.pmod(F.xxhash64("ingested_at"), F.lit(5)) == 0
    rows.filter(~late).write.parquet(f"{root}/in/part=1")
    rows.filter(late).write.parquet(f"{root}/in/part=2")
    schema = rows.schema

    def bring(batch: DataFrame, batch_id: int) -> None:
        flows.merge_late(batch, f"{root}/silver", "ingested_at", schema)

    for part in (1, 2, 2):
        src = flows.stream_landing(t.spark, f"{root}/in/part={part}", schema)
        # The second delivery is replayed under a new checkpoint and must change nothing.
        flows.run_to_end(flows.start(src, scratch_dir(t.spark, "late-checkpoint"), each_batch=bring))
    silver = t.spark.read.schema(StructType([*schema.fields, StructField("date", StringType())])).parquet(f"{root}/silver")
    return silver.groupBy("date").agg(F.count("*").alias("n"), F.count_distinct("icao24").alias("aircraft"))


@query("r06_restart", ["v_flight"], "SELECT departure_airport AS airport, count(*) AS n, count(DISTINCT first_seen) AS moments FROM v_flight GROUP BY 1")
def r06(t: Tables):
    root = scratch_dir(t.spark, "restart")
    rows = t.v_flight.select("departure_airport", "first_seen")
    cut = F.lit("2024-01-15").cast("timestamp")
    for part in (F.col("first_seen") < cut, F.col("first_seen") >= cut):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        # Every start resumes from the checkpoint of the one before.
        src = flows.stream_landing(t.spark, f"{root}/in", rows.schema, files_per_trigger=1)
        flows.run_to_end(flows.start(src, f"{root}/checkpoint", path=f"{root}/out"))
    out = t.spark.read.schema(rows.schema).parquet(f"{root}/out")
    return out.groupBy(F.col("departure_airport").alias("airport")).agg(F.count("*").alias("n"), F.count_distinct("first_seen").alias("moments"))


@query("r06_batch_ledger", ["v_flight"], "SELECT departure_airport AS airport, count(*) AS n, count(DISTINCT first_seen) AS moments FROM v_flight GROUP BY 1")
def r06l(t: Tables):
    # The whole stream is run twice, the second time without its checkpoint: the ledger knows its batches.
    root = scratch_dir(t.spark, "ledger")
    rows = t.v_flight.select("departure_airport", "first_seen", drawn_together("first_seen").alias("ingested_at"))
    for i in range(3):
        rows.filter(F.pmod(F.xxhash64("first_seen"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for again in range(2):
        src = flows.stream_landing(t.spark, f"{root}/in", rows.schema, files_per_trigger=1)
        flows.run_to_end(flows.start(src, f"{root}/checkpoint-{again}", each_batch=lake.batch_writer(root, "flights", "feed")))
    out = lake.read_layer(t.spark, root, "flights", schema=rows.schema)
    return out.groupBy(F.col("departure_airport").alias("airport")).agg(F.count("*").alias("n"), F.count_distinct("first_seen").alias("moments"))


@query("r07_backfill", ["v_flight"], """
    SELECT strftime(first_seen, '%Y-%m-%d') AS date, departure_airport AS airport, count(*) AS n FROM v_flight
    WHERE first_seen >= TIMESTAMP '2024-01-05 00:00:00' AND first_seen < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL""")
def r07(t: Tables):
    path = scratch_dir(t.spark, "backfill")

    def job(begin: datetime, end: datetime) -> DataFrame:
        days = t.v_flight.filter((F.col("first_seen") >= F.lit(begin)) & (F.col("first_seen") < F.lit(end)))
        return days.groupBy(F.date_trunc("day", "first_seen").alias("ts"), F.col("departure_airport").alias("airport")).agg(F.count("*").alias("n"))

    # Overlapping runs and a repeat leave the same table as one run.
    for a, b in ((5, 12), (10, 15), (10, 15)):
        flows.backfill(job, path, "ts", datetime(2024, 1, a), datetime(2024, 1, b))
    return t.spark.read.schema("ts timestamp, airport string, n bigint, date string").parquet(path).select("date", "airport", "n")
