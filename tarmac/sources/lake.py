"""Layers on storage: append, read, replace, compact, backfill.

A bronze table is what its *ledger* says. Files are written first, where nobody looks for them, and
count from the moment a manifest that names them is renamed into the ledger, which either
happens or does not. There is one folder of manifests for each ingestion day:

* ``<batch>.json`` names the files that a batch has brought for the day. The rename fails if the
  name is taken, so a batch that is run again after a crash counts once.
* ``v<n>.json`` is a version of the day: all its files, and the batches folded into it. The
  highest one holds, together with the batches that it does not name. ``compact`` writes these.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.functions.timing import partition_keys
from tarmac.schemas import SCHEMAS, conform

_PARTS = (StructField("date", StringType()), StructField("hour", StringType()))
_LEDGER, _BATCH = "_ledger", "__batch"


@dataclass(frozen=True)
class WriteResult:
    rows: int
    bytes: int


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below ``path``, bytes) of all Parquet files there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    top, found, out = len(p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getPath()) + 1, fs.listFiles(p, True), []
    while found.hasNext():
        st = found.next()
        if st.getPath().getName().endswith(".parquet"):
            out.append((st.getPath().toUri().getPath()[top:], int(st.getLen())))
    return sorted(out)


def _get(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Put a small file in place as a whole; False if it is there already and must not be replaced."""
    jvm, (fs, final) = spark._jvm, _fs(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    ctx = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE if replace else jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        ctx.rename(staged, final, how)
    except Py4JJavaError as e:
        fs.delete(staged, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def _day_state(spark: SparkSession, target: str, day: str) -> tuple[int, list[str], dict[str, int]]:
    """The day's version (0 without one), the batches seen, and its live files with their bytes."""
    folder = f"{target}/{_LEDGER}/date={day}"
    names = [n for n in _names(spark, folder) if n.endswith(".json")]
    versions = [int(m[1]) for n in names if (m := re.fullmatch(r"v(\d+)\.json", n))]
    version, files, folded = max(versions, default=0), {}, set()
    if version:
        held = json.loads(_get(spark, f"{folder}/v{version}.json"))
        files, folded = dict(held["files"]), set(held["folded"])
    batches = [n for n in names if not re.fullmatch(r"v\d+\.json", n)]
    for n in batches:
        if n not in folded:
            files.update(json.loads(_get(spark, f"{folder}/{n}"))["files"])
    return version, batches, files


def _write_files(df: DataFrame, target: str, token: str, ingested: str | None) -> dict[str, list[tuple[str, int]]]:
    """Write rows with ``date`` and ``hour`` below a folder of their own; the files by day."""
    order = [c for c in (ingested,) if c and c in df.columns]
    df.sortWithinPartitions("date", "hour", *order).write.partitionBy("date", "hour").option("compression", "zstd").parquet(f"{target}/{_BATCH}={token}")
    days: dict[str, list[tuple[str, int]]] = {}
    for path, size in _files(df.sparkSession, f"{target}/{_BATCH}={token}"):
        days.setdefault(re.match(r"date=([^/]+)/", path)[1], []).append((f"{_BATCH}={token}/{path}", size))
    return days


def append_bronze(df: DataFrame, root: str, source: str, ingested: str = "ingested_at", batch: str | None = None) -> WriteResult:
    """Append a batch under the date and hour of its ingestion time.

    Existing files are never touched and an empty batch leaves none. Rows are in time order
    inside each file, and are counted by the write itself. A ``batch`` that is in the ledger
    already is not brought again, and one that was cut off while it was entered is completed.
    """
    spark, target = df.sparkSession, f"{root}/{source}"
    if batch is not None and not re.fullmatch(r"(?!v\d+$)[\w.=-]{1,200}", batch):
        raise ValueError(f"not a name for a batch: {batch!r}")
    done = f"{target}/{_LEDGER}/_done/{batch}"
    if batch is not None and exists(spark, done):
        return WriteResult(0, 0)
    pinned = conform(df, source) if source in SCHEMAS else df
    day, hour = partition_keys(F.col(ingested))
    counted, token = Observation(), uuid.uuid4().hex
    # Adaptive execution sizes the pieces: a hot hour is split, quiet ones share a task.
    rows = pinned.withColumn("date", day).withColumn("hour", hour).observe(counted, F.count(F.lit(1)).alias("rows"))
    days = _write_files(rows.hint("rebalance", "date", "hour"), target, token, ingested)
    fs, own = _fs(spark, f"{target}/{_BATCH}={token}")
    size = 0
    for d, files in sorted(days.items()):
        if _put(spark, f"{target}/{_LEDGER}/date={d}/{batch or token}.json", json.dumps({"files": files})):
            size += sum(n for _, n in files)
        else:  # entered before the batch was cut off
            fs.delete(_fs(spark, f"{target}/{_BATCH}={token}/date={d}")[1], True)
    if batch is not None:
        _put(spark, done, "")
    if not size:
        fs.delete(own, True)
        return WriteResult(0, 0)
    return WriteResult(rows=int(counted.get["rows"]), bytes=size)


def batch_writer(root: str, source: str, name: str, ingested: str = "ingested_at"):
    """A function for ``foreachBatch`` that brings each micro-batch of the stream ``name`` exactly once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_bronze(batch, root, source, ingested, batch=f"{name}-{batch_id}")

    return write


def read_layer(
    spark: SparkSession, root: str, source: str, start: datetime | None = None,
    end: datetime | None = None, ingested: str = "ingested_at", schema: StructType | None = None,
) -> DataFrame:
    """Rows ingested in [start, end) with their partition columns as text.

    The ledgers of the days in the range are read once, now; the frame keeps to those files whatever is
    appended or compacted later. The bounds also become partition filters.
    """
    target, full = f"{root}/{source}", StructType([*(schema or SCHEMAS[source]).fields, *_PARTS])
    days = [n[5:] for n in _names(spark, f"{target}/{_LEDGER}") if n.startswith("date=")]
    first, last = (None if x is None else x.strftime("%Y-%m-%d") for x in (start, end))
    days = [d for d in days if (first is None or d >= first) and (last is None or d <= last)]
    df = _read_files(spark, target, full, [f for d in days for f in _day_state(spark, target, d)[2]])
    if start is not None:
        df = df.filter((F.col("date") >= first) & (F.col(ingested) >= F.lit(start)))
    if end is not None:
        df = df.filter((F.col("date") <= last) & (F.col(ingested) < F.lit(end)))
    return df


def _read_files(spark: SparkSession, target: str, full: StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("basePath", target)
    return reader.parquet(*[f"{target}/{f}" for f in files]).select(*full.names)


def union_layers(*frames: DataFrame) -> DataFrame:
    """Batches of one pinned schema; a missing or extra column is an error."""
    out = frames[0]
    for f in frames[1:]:
        if set(f.columns) != set(out.columns):
            raise ValueError(f"columns differ: {sorted(set(f.columns) ^ set(out.columns))}")
        out = out.unionByName(f, allowMissingColumns=False)
    return out


_POINTER = "_current"


def replace_reference(df: DataFrame, path: str) -> str:
    """Replace a lookup table wholesale; readers see the old or the new one, never part.

    The snapshot goes to a new directory and a one-row pointer is then renamed into
    place. An empty snapshot is refused and the old one stays.
    """
    spark = df.sparkSession
    if df.isEmpty():
        raise ValueError("refusing to write an empty reference table")
    version = f"{path}/v-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(version)
    _put(spark, f"{path}/{_POINTER}", version.rsplit("/", 1)[-1], replace=True)
    return version


def read_reference(spark: SparkSession, path: str, name: str = "aircraft") -> DataFrame:
    version = _get(spark, f"{path}/{_POINTER}")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{version}")


def register_views(spark: SparkSession, root: str, sources: list[str]) -> None:
    """Temp views over the layers, plus ``<source>_by_day`` with the row count per day."""
    for s in sources:
        read_layer(spark, root, s).createOrReplaceTempView(s)
        spark.sql(
            f"CREATE OR REPLACE TEMP VIEW {s}_by_day AS "
            f"SELECT date, count(*) AS n_rows FROM {s} GROUP BY date"
        )


def content_fingerprint(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-free sum of row hashes: equal tables give equal pairs."""
    h = F.xxhash64(*[F.to_json(F.struct(c)) for c in sorted(df.columns)]).cast("decimal(38,0)")
    r = df.agg(F.count("*").alias("n"), F.sum(h).alias("h")).first()
    return int(r["n"]), str(r["h"])


def _bins(files: dict[str, int], small: int, target: int) -> list[list[str]]:
    """Files below ``small`` bytes of one hour put together, largest first, up to ``target`` bytes; bins of one are left out."""
    bins: dict[str, list[tuple[int, list[str]]]] = {}
    for path, size in sorted(files.items(), key=lambda x: (-x[1], x[0])):
        if size >= small:
            continue
        own = bins.setdefault(path.split("/", 1)[1].rsplit("/", 1)[0], [])
        fits = [i for i, (used, _) in enumerate(own) if used + size <= target]
        if fits:
            used, held = own[fits[0]]
            own[fits[0]] = (used + size, [*held, path])
        else:
            own.append((size, [path]))
    return [held for own in bins.values() for _, held in own if len(held) > 1]


def compact(
    spark: SparkSession, root: str, source: str, day: str, schema: StructType | None = None,
    now: datetime | None = None, small_bytes: int = 64 << 20, target_bytes: int = 128 << 20,
) -> dict[str, int]:
    """Fold the small files of a closed day into few, leaving the rows as they are.

    Files of ``small_bytes`` and more are not read. Small ones are put together by size, each bin
    is written as one file, compared with its rows before by count and row hashes, and the new list of
    files becomes the day's next version. Readers have the old list or the new one; the old files stay for those
    that read them, until ``clean``. Of two at once, one wins and the other raises.
    """
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"not a day: {day!r}")
    # Partitions are UTC days, so "closed" is judged by the UTC clock, wherever the driver runs.
    moment = now or datetime.now(timezone.utc)
    today = (moment.astimezone(timezone.utc) if moment.tzinfo else moment).date()
    if day >= today.isoformat():
        raise ValueError(f"{day} is still being written")
    full, target = StructType([*(schema or SCHEMAS[source]).fields, *_PARTS]), f"{root}/{source}"
    version, batches, files = _day_state(spark, target, day)
    bins = _bins(files, small_bytes, target_bytes)
    done = {"rows": 0, "files_before": len(files), "files_after": len(files), "bytes_rewritten": 0}
    if not bins:
        return done
    old = [f for held in bins for f in held]
    token = f"{day}-{uuid.uuid4().hex}"
    before = _read_files(spark, target, full, old)
    # One row for each file; every bin goes to one task, and holds target_bytes at most. Files of one batch share names between hours.
    place = spark.createDataFrame([(f, i) for i, held in enumerate(bins) for f in held], "__file string, __bin int")
    reader = spark.read.schema(full).option("basePath", target).parquet(*[f"{target}/{f}" for f in old])
    own = F.regexp_extract("_metadata.file_path", f"({_BATCH}=[^/]+/[^/]+/[^/]+/[^/]+)$", 1)
    binned = reader.select(*full.names, own.alias("__file")).join(F.broadcast(place), "__file").repartition(len(bins), "__bin")
    added = _write_files(binned.select(*full.names), target, token, "ingested_at").get(day, [])
    want, got = content_fingerprint(before), content_fingerprint(_read_files(spark, target, full, [f for f, _ in added]))
    fs, own = _fs(spark, f"{target}/{_BATCH}={token}")
    if want != got:
        fs.delete(own, True)
        raise RuntimeError(f"compaction of {source} {day} would change its rows: {want} != {got}")
    gone = set(old)
    live = [*[(f, n) for f, n in files.items() if f not in gone], *added]
    if not _put(spark, f"{target}/{_LEDGER}/date={day}/v{version + 1}.json", json.dumps({"files": live, "folded": batches})):
        fs.delete(own, True)
        raise RuntimeError(f"{source} {day} has been compacted by another run meanwhile")
    return {"rows": want[0], "files_before": len(files), "files_after": len(live), "bytes_rewritten": sum(n for _, n in added)}


def clean(spark: SparkSession, root: str, source: str, day: str) -> int:
    """Delete the files that the day's latest version has replaced; how many. For when no reader of older versions is left."""
    target = f"{root}/{source}"
    # Batches that are being written are not in the ledger yet; only what a manifest names is deleted.
    gone = _ever(spark, target, day) - set(_day_state(spark, target, day)[2])
    fs, _ = _fs(spark, target)
    return sum(bool(fs.delete(_fs(spark, f"{target}/{f}")[1], False)) for f in sorted(gone))


def _ever(spark: SparkSession, target: str, day: str) -> set[str]:
    """All files that any manifest of the day has named."""
    folder = f"{target}/{_LEDGER}/date={day}"
    return {f for n in _names(spark, folder) if n.endswith(".json") for f, _ in json.loads(_get(spark, f"{folder}/{n}"))["files"]}


def drop_before(spark: SparkSession, root: str, source: str, day: str) -> list[str]:
    """Retention: remove the closed days older than ``day``, first from the ledger; returns their dates."""
    target = f"{root}/{source}"
    days = [n[5:] for n in _names(spark, f"{target}/{_LEDGER}") if n.startswith("date=") and n[5:] < day]
    for d in days:
        named = _ever(spark, target, d)
        fs, folder = _fs(spark, f"{target}/{_LEDGER}/date={d}")
        fs.delete(folder, True)
        for f in named:
            fs.delete(_fs(spark, f"{target}/{f}")[1], False)
    return days


def overwrite_days(df: DataFrame, path: str, ts: str, day: str = "date") -> None:
    """Write rows partitioned by event day, replacing just the days present."""
    (
        df.withColumn(day, F.date_format(ts, "yyyy-MM-dd"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(day).parquet(path)
    )
