"""Exact deduplication of a growing corpus as a stream with keyed state.

Files of the corpus arrive as a stream. Rows of one Arrow batch with equal bytes become one
*sighting*, so a text that a third of all rows share costs a row for each batch of rows. Sightings are
dealt by digest to a stateful operator whose state lies in RocksDB, on disk and in the
checkpoint, and never expires. For each digest it retains the digest, a stable identifier (the
largest document id so far) and a content locator (the file and row where that document lies). A
sighting whose digest is known is a *hit*: it goes out with the locator that it has to equal. Hits of one
micro-batch are chained, each to the one before, so no locator has to be compared with many.

``check`` compares the full bytes of all hits with those at their locators, in one pass over the
corpus however many hits there are. A digest with an unequal pair is *disputed*, and its rows
are grouped by their bytes instead. ``outcome`` joins the documents with their digest's
largest id.

The file sink and the checkpoint make each micro-batch count once: a run that is killed goes on
where it stopped when ``advance`` is called again, and new files are taken in by calling it again. Files of the
corpus must stay as they are, since locators point into them.

Null texts are empty. Of equal texts the row with the largest id stays; a row without an id only
if none has one; of rows with the same id (or none) the first by file and row. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tarmac.llm.text import prepare, text_column
from tarmac.session import scratch_dir


@dataclass(frozen=True)
class Settings:
    """``shards`` (keys of the state) and ``digest_bytes`` hold for the life of a state; a micro-batch takes ``batch_bytes`` of files."""

    shards: int = 4096
    digest_bytes: int = 32
    batch_bytes: int = 256 << 20


STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Every partition of the state is a store of its own, and would set megabytes aside for its logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SIGHTING = "digest binary, doc_id bigint, n bigint, file string, row bigint"
SEEN = f"{SIGHTING}, known_file string, known_row bigint"


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes along when it starts; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass(frozen=True)
class Corpus:
    """Parquet files with documents, and the folder of what is known about them."""

    spark: SparkSession
    path: str
    state: str
    doc_id: str = "doc_id"
    text: str = "text"
    settings: Settings = Settings()

    def _columns(self, df: DataFrame) -> DataFrame:
        return df.select(
            F.col(self.doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(self.text), F.lit("")).cast("binary").alias("text"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))

    def _read(self, reader: Any) -> DataFrame:
        # Only these columns, so that no column of the corpus can hide the files' own.
        fields = self.spark.read.parquet(self.path).schema
        reader, path = reader.schema(type(fields)([fields[self.doc_id], fields[self.text]])), self.path.rstrip("/")
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
            # A stream reads folders: the file is picked out of its own.
            path, name = path.rsplit("/", 1)
            reader = reader.option("pathGlobFilter", name)
        return self._columns(reader.parquet(path))

    def documents(self) -> DataFrame:
        return self._read(self.spark.read)

    def advance(self) -> None:
        """Take in all files that have come since the last call."""
        stream = self._read(self.spark.readStream.option("maxBytesPerTrigger", str(self.settings.batch_bytes)))
        seen = sightings(stream, self.settings).groupBy("shard").transformWithStateInPandas(
            statefulProcessor=Index(), outputStructType=SEEN, outputMode="Append", timeMode="None")
        with _set(self.spark, STORE):
            query = (
                seen.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{self.state}/checkpoint")
                .option("path", f"{self.state}/sightings").trigger(availableNow=True).start()
            )
        query.awaitTermination()

    def seen(self) -> DataFrame:
        return self.spark.read.schema(SEEN).parquet(f"{self.state}/sightings")

    def check(self) -> DataFrame:
        """Disputed digests: those with a hit whose bytes differ from the bytes at its locator."""
        hits = self.seen().where("known_file IS NOT NULL")
        sides = hits.select(
            "digest", F.struct("file", "row").alias("hit"),
            F.explode(F.array(F.struct("file", "row"), F.struct(F.col("known_file").alias("file"), F.col("known_row").alias("row")))).alias("at"),
        ).select("digest", "hit", "at.file", "at.row")
        pairs = self.documents().select("file", "row", "text").join(sides, ["file", "row"]).groupBy("digest", "hit").agg(
            F.count("*").alias("n"), F.min("text").alias("one"), F.max("text").alias("other"))
        disputed = f"{self.state}/disputed"
        pairs.where("n <> 2 OR one <> other").select("digest").distinct().write.mode("overwrite").parquet(disputed)
        return self.spark.read.schema("digest binary").parquet(disputed)

    def outcome(self, disputed: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 of every document taken in."""
        size = self.settings.digest_bytes
        docs = self.documents().withColumn("text_sha256", F.sha2("text", 256))
        docs = docs.withColumn("digest", F.substring(F.unhex("text_sha256"), 1, size))
        ids = ["doc_id", "file", "row", "text_sha256"]
        classes = self.seen().groupBy("digest").agg(F.sum("n").alias("group_size"), F.min(_first()).alias("first"))
        if disputed.isEmpty():
            return _decided(docs.select(*ids, "digest").join(classes, "digest"))
        apart = docs.join(disputed, "digest", "left_semi")
        by_bytes = apart.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.min(_first()).alias("first"))
        return _decided(docs.select(*ids, "digest").join(disputed, "digest", "left_anti").join(classes, "digest")).unionByName(
            _decided(apart.join(by_bytes, ["digest", "text"])))


def _first() -> Column:
    """The smallest of these belongs to the row that stays."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("falling"), "file", "row")


def _decided(rows: DataFrame) -> DataFrame:
    kept = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return rows.select("doc_id", F.bitwise_not("first.falling").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def sightings(rows: DataFrame, settings: Settings) -> DataFrame:
    """Rows of one Arrow batch with equal bytes as one row: the first one with the largest id, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[bytes, int] = {}
            best: list[int] = []
            many: list[int] = []
            ids = batch.column("doc_id").to_pylist()
            for i, text in enumerate(text_column(batch, "text").to_pylist()):
                k = texts.setdefault(text, len(texts))
                if k == len(best):
                    best.append(i)
                    many.append(1)
                    continue
                many[k] += 1
                if ids[i] is not None and (ids[best[k]] is None or ids[i] > ids[best[k]]):
                    best[k] = i
            digests = [sha256(t).digest()[: settings.digest_bytes] for t in texts]
            pick = pa.array(best, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([int.from_bytes(d[:4], "little") % settings.shards for d in digests], pa.int32()), pa.array(digests, pa.binary()),
                batch.column("doc_id").take(pick), pa.array(many, pa.int64()), batch.column("file").take(pick), batch.column("row").take(pick),
            ], names=["shard", "digest", "doc_id", "n", "file", "row"])

    return rows.mapInArrow(run, f"shard int, {SIGHTING}")


class Index(StatefulProcessor):
    """Keyed by shard; a map from digest to (largest id, file, row) that never expires."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "digest binary", "doc_id bigint, file string, row bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before: dict[bytes, tuple[str, int]] = {}
        largest: dict[bytes, tuple[int | None, str, int]] = {}
        for pdf in rows:
            links = []
            ids = pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None)
            for digest, doc_id, file, row in zip(pdf["digest"], ids, pdf["file"], pdf["row"], strict=True):
                digest, doc_id, row = bytes(digest), None if doc_id is None else int(doc_id), int(row)
                if digest not in before:
                    held = self.known.getValue((digest,))
                    if held is not None:
                        largest[digest] = tuple(held)
                        before[digest] = (held[1], held[2])
                links.append(before.get(digest, (None, None)))
                before[digest] = (file, row)
                have = largest.get(digest)
                if have is None or (doc_id is not None and (have[0] is None or doc_id > have[0])):
                    largest[digest] = (doc_id, file, row)
                    have = None
            out = pdf[["digest", "doc_id", "n", "file", "row"]].copy()
            out["doc_id"] = ids.astype("Int64")
            out["known_file"] = [f for f, _ in links]
            out["known_row"] = pd.array([r for _, r in links], dtype="Int64")
            yield out
        for digest, value in largest.items():
            self.known.updateValue((digest,), value)

    def close(self) -> None:
        pass


def deduplicate(spark: SparkSession, path: str, state: str | None = None, settings: Settings = Settings(), **columns: str) -> DataFrame:
    """Take in the files below ``path``, check the hits, and return what becomes of every document."""
    prepare(spark)
    corpus = Corpus(spark, path, state or scratch_dir(spark, "streamdedup"), settings=settings, **columns)
    corpus.advance()
    return corpus.outcome(corpus.check())


#: What SQL says of the query.
SQL = """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
