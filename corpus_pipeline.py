"""The corpus pipeline: documents are classified, deduplicated by line and as a whole, redacted and packed.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but
the last return the columns of documents; texts that a stage changes get a new ``n_chars``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import linededup, ngramjoin, packing, quality, secrets
from tarmac.llm.queries import QUERIES as OPERATOR_QUERIES
from tarmac.llm.queries import SQL as OPERATOR_SQL
from tarmac.session import scratch_dir


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now; null for a null text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; documents stay, if need be empty."""
    return _counted(linededup.dedup_lines(docs)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return ngramjoin.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _counted(secrets.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in the sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("pattern_packing", packing_stage),
]

#: SQL can express neither the sampled classifier nor the banded join; tests hold the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
SQL = {**OPERATOR_SQL, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
