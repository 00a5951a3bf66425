"""Line deduplication over levelled sorted runs of line hashes.

A store of *runs* remembers every line key that has been admitted. A run is a table bucketed and
sorted by key, so joins against it merge without shuffling it. A new batch of lines is reduced
to its keys, merge-anti-joined with the runs (what is left is new and gets this batch's keeper),
and added as a run of level 0. When a level has ``fanout`` runs, they are merged into one run
of the next level, so a batch meets few runs and every key is rewritten once for each level.

A line's key is the line without white space at both ends, A-Z lower-cased; keys shorter than
``least_chars`` code points are not considered. A row counts as one document, however often it
holds a line. Rows of one id count each, and all rows with the keeper's id keep the line. Null
or empty texts are one empty line. Rows without an id keep all lines and are not counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarmac.llm.text import shuffle_width, prepare, text_column
from tarmac.session import scratch_dir, settle

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
LEAST_CHARS, LEAST_DOCS = 20, 3


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """A hash of the line's key, or None if the key is too short."""
    line = line.strip(b" \t\n\v\f\r")
    if len(line) < least_chars or (len(line) < 4 * least_chars and len(line.decode("utf-8", "replace")) < least_chars):
        return None
    return md5(line.translate(LOWER), usedforsecurity=False).digest()


@dataclass
class Runs:
    """Levelled runs of (line_key, n_docs, keeper). Each key has a keeper in one run, the first that held it."""

    spark: SparkSession
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.root = scratch_dir(self.spark, self.name)
        self.width, self.made = shuffle_width(self.spark), 0

    def admit(self, batch: DataFrame) -> DataFrame:
        """Add a batch of (line_key, doc_id), distinct within a document; returns its keys that were new.

        The keeper of a new key is the largest id of its batch.
        """
        keys = batch.groupBy("line_key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        keys = settle(keys, "batch_keys")
        fresh = keys
        for run in self._tables():
            fresh = fresh.join(run.where("keeper IS NOT NULL"), "line_key", "left_anti")
        fresh = settle(fresh, "new_keys") if self.levels else fresh
        known = keys.select("line_key", "n_docs").join(fresh.select("line_key", "keeper"), "line_key", "left") if self.levels else fresh
        self._write(known, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._merged([self.spark.table(t) for t in self.levels[level]])
            self._write(merged, level + 1)
            for table in self.levels[level]:
                self.spark.sql(f"DROP TABLE {table}")
            self.levels[level] = []
            level += 1
        return fresh

    def totals(self) -> DataFrame:
        """Every key with its number of documents and its keeper."""
        return self._merged(self._tables())

    def _tables(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        # Dealt out anew on purpose: the runs' buckets are no partitioning of their union.
        return every.repartition("line_key").groupBy("line_key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def _write(self, keys: DataFrame, level: int) -> None:
        table, self.made = f"{self.name}_{self.made}", self.made + 1
        (
            keys.select("line_key", "n_docs", "keeper").repartition(self.width, "line_key").write
            .bucketBy(self.width, "line_key").sortBy("line_key").option("path", f"{self.root}/{self.made}").saveAsTable(table)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)


def document_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, line_key) of each row's distinct long enough lines."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for i, value in zip(batch.column(0).to_pylist(), text_column(batch, "text").to_pylist(), strict=True):
                own = {k for line in value.split(b"\n") if (k := line_key(line, least_chars))}
                keys += own
                ids += [i] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "line_key"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    return rows.mapInArrow(run, "doc_id bigint, line_key binary")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = 4) -> DataFrame:
    """For each document the keys of the lines that it loses: doc_id, lost.

    The rows are admitted in batches by descending ranges of ids, so that the first batch with a
    key holds its keeper, the largest id.
    """
    spark = docs.sparkSession
    lines = document_lines(docs, doc_id, text, least_chars)
    share = ", ".join(str(i / batches) for i in range(1, batches))
    cuts = docs.select(F.col(doc_id).cast("long").alias("doc_id")).agg(F.expr(f"percentile_approx(doc_id, array({share}))").alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    batch = sum((F.when(F.col("doc_id") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    path = scratch_dir(spark, "lines")
    lines.withColumn("batch", batch.cast("int")).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id bigint, line_key binary, batch int").parquet(path)
    runs = Runs(spark)
    for b in range(len(cuts), -1, -1):
        runs.admit(lines.where(F.col("batch") == b))
    often = runs.totals().where(F.col("n_docs") >= least_docs)
    return lines.join(often, "line_key").where("doc_id < keeper").groupBy("doc_id").agg(F.collect_list("line_key").alias("lost"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """The rows with repeated lines dropped, and two more columns: n_lines (before) and n_dropped.

    Columns of these names are replaced. Null texts stay null. A text whose lines all go is empty.
    """
    least = settings.get("least_chars", LEAST_CHARS)
    docs = docs.drop("n_lines", "n_dropped")
    lost = repeated_lines(docs, doc_id, text, **settings).select(F.col("doc_id").alias("__id"), F.col("lost").alias("__lost"))
    joined = docs.join(lost, F.col(doc_id).cast("long") == F.col("__id"), "left").drop("__id")
    schema = StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    place, width, names = docs.columns.index(text), len(docs.columns), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for value, gone in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(width).to_pylist(), strict=True):
                lines = (value or b"").split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if line_key(x, least) not in gone]
                    value = b"\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(value)
            columns = batch.columns[:width]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=names)

    return joined.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and a digest of the text that stays."""
    kept: Column = F.sha2(F.coalesce("text", F.lit("")), 256)
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


#: The same in SQL.
SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs),
keyed AS (SELECT doc_id, line, place,
  translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
often AS (SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.doc_id, k.line, k.place, o.keeper IS NOT NULL AND k.doc_id <> o.keeper AS gone FROM keyed k LEFT JOIN often o USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
