"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Correctness settings come first; the adaptive ones let Spark split hot shuffle
# partitions even where that costs one more exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A union of bucketed tables taken as partitioned alike gave partial groups as final (seen with Spark 4.1).
    "spark.sql.unionOutputPartitioning": "false",
    # Sets and structs per group stay in a hash map longer before sorting sets in.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}

# Only a new session can take these. Recording the Python call site of every column
# nearly doubles the time to build a plan.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "tarmac", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for what is started inside; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate tables, checkpoints and staging.

    On a cluster it lies below ``spark.checkpoint.dir``, which every executor can
    reach. A machine-local folder is used only by a local session without one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        root = _local_scratch.setdefault(app, "") or tempfile.mkdtemp(prefix="tarmac-")
        _local_scratch[app] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a small reduced result to the scratch folder and read it back.

    For results that several later steps read: they then start from files instead of
    repeating the work, and a lost executor costs a re-read. Runs a job when called.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
