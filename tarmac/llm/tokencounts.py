"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive: a batch of signed rows (insert +1,
delete -1, a revised count as one of each) is summed to one row for each group and written as a
delta under the batch's name. A delta counts once its writer has marked it complete, and a name
that is complete is not written again, so a batch may be sent any number of times (by one writer at a
time). Totals are the sum of all deltas; ``compact`` folds them into one table that lists the names in it.

Null sources and languages are groups of their own. Null texts have no tokens; texts are counted
whole, however long. Groups whose rows were all deleted stay with zeros. Repeated rows each
count. Other columns of the documents are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.text import BLOCK_BYTES, blocks, gathered, prepare, spans, text_column
from tarmac.llm.wordpieces import word_encoder
from tarmac.session import scratch_dir, settle

GROUP = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


@dataclass
class Rollup:
    """Deltas below one folder that all tasks share."""

    spark: SparkSession
    root: str

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of (source, lang, tokenizer, sign, n_tokens); False if it is there already."""
        folder = quote(batch, safe="")
        if not batch or len(folder) > 200:
            raise ValueError(f"not a name for a batch: {batch[:80]!r}")
        if batch in self.batches():
            return False
        summed = changes.groupBy(*GROUP).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        # A half-written delta of an earlier try has no mark and is replaced.
        summed.write.mode("overwrite").parquet(f"{self.root}/deltas/{folder}")
        return True

    def batches(self) -> set[str]:
        """Names of the complete batches, folded ones too."""
        return self._deltas() | self._fold()[1]

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all complete batches, each once."""
        held, inside = self._fold()
        paths = [f"{self.root}/folded/{held}/totals"] * bool(held) + [f"{self.root}/deltas/{quote(b, safe='')}" for b in sorted(self._deltas() - inside)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        # Names are percent-encoded in paths, and a path with a percent sign is read as it stands.
        rows = self.spark.read.schema(SCHEMA).parquet(*paths)
        return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def compact(self) -> None:
        """Fold all complete batches into one table beside the list of their names. The deltas stay until their owner removes them."""
        names = sorted(self.batches())
        if names:
            folder = f"{self.root}/folded/{len(names):08d}-{uuid.uuid4().hex[:12]}"
            self.spark.createDataFrame([(n,) for n in names], "batch string").repartition(1).write.parquet(f"{folder}/names")
            # The totals come last: a fold without them is none.
            self.totals().repartition(1).write.parquet(f"{folder}/totals")

    def _deltas(self) -> set[str]:
        return {unquote(name) for name in self._complete("deltas")}

    def _fold(self) -> tuple[str | None, set[str]]:
        """The fold with the most batches, and their names."""
        held = max(self._complete("folded", "totals"), default=None)
        if held is None:
            return None, set()
        return held, {r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.root}/folded/{held}/names").collect()}

    def _complete(self, kind: str, part: str = "") -> set[str]:
        """Folders that are marked as written to their end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return set()
        found = [s.getPath() for s in files.listStatus(path)]
        return {p.getName() for p in found if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, f"{part}/_SUCCESS".lstrip("/")))}


def change(rows: DataFrame, tokenizer: str, sign: int | Column, n_tokens: Column) -> DataFrame:
    """Signed rows; a sign of -3 takes three equal rows away."""
    sign = sign if isinstance(sign, Column) else F.lit(sign)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), sign.cast("long").alias("sign"), n_tokens.cast("long").alias("n_tokens"))


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, text_hash, n_words and n_pieces: each text by white space and by the tokenizer."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in gathered(batches, "text"):
            column = text_column(batch, "text")
            for lo, hi in blocks(column, 8 * BLOCK_BYTES):
                part, texts = batch.slice(lo, hi - lo), column.slice(lo, hi - lo)
                pieces = np.diff(encoder.encode_column(texts)[1])
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(np.diff(spans(texts)[3])), pa.array(pieces)], names=[*kept.schema.names, "n_words", "n_pieces"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id bigint, source string, lang string, text_hash string, n_words bigint, n_pieces bigint")


def maintained(docs: DataFrame, tokenizer: str, version: str = "word_bpe_49k") -> DataFrame:
    """Totals after a life of the table: all documents are inserted with their words counted; a tokenizer
    version is added; its counts are revised to include an end token; exact copies (all but the
    smallest id, and of rows of one id and text all but one) are deleted; batches are sent twice.
    """
    spark = docs.sparkSession
    rows = settle(counted(docs, tokenizer), "counts")
    held = Rollup(spark, scratch_dir(spark, f"rollup-{uuid.uuid4().hex[:6]}"))
    # Copies are counted by source and language first, so a text that many rows share is a few rows from there on.
    per = rows.groupBy("text_hash", "source", "lang", "n_words", "n_pieces").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    order = F.struct(F.col("first").isNull().alias("none"), "first", "source", "lang")
    own = F.struct("source", "lang").eqNullSafe(F.struct("kept.source", "kept.lang"))
    surplus = F.col("n") - own.cast("long")
    gone = per.join(per.groupBy("text_hash").agg(F.min(order).alias("kept")), "text_hash").withColumn("again", surplus).where("again > 0")
    revised = F.col("n_pieces") + 1
    batches = {
        "insert": change(rows, "words", 1, F.col("n_words")),
        "add-version": change(rows, version, 1, F.col("n_pieces")),
        "revise": change(rows, version, -1, F.col("n_pieces")).unionByName(change(rows, version, 1, revised)),
        "delete-copies": change(gone, "words", -F.col("again"), F.col("n_words")).unionByName(change(gone, version, -F.col("again"), revised)),
    }
    for name, changes in batches.items():
        held.commit(name, changes)
        if name == "add-version":
            held.compact()
    held.commit("revise", batches["revise"])
    return held.totals()
