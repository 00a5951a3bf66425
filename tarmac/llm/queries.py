"""The registered queries of the operators, each over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, collocations, fingerprints, langmodel, linededup, neighbours, ngramjoin, packing, quality, secrets, streamdedup, tokencounts, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_register
def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(_documents(spark, sf_dir))


@_register
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, key and whether it is drawn; the others are those that the classifier rejects."""
    return quality.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_register
def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(_documents(spark, sf_dir))


SQL["op3_line_runs"] = linededup.SQL


@_register
def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_register
def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.maintained(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_register
def op6_maximum_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmodel.score(_documents(spark, sf_dir))


@_register
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(_documents(spark, sf_dir)).drop("tie")


@_register
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(_documents(spark, sf_dir))


@_register
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@_register
def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@_register
def op11_bit_sliced_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_register
def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_documents(spark, sf_dir))


SQL["op12_phrase_automata"] = collocations.SQL


@_register
def op13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamdedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


SQL["op13_stream_dedup"] = streamdedup.SQL
