"""The pipeline's rows against the same stages in plain Python; the registered queries."""

from __future__ import annotations

import os

import odd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from compare import compare, connect
from tarmac.llm import queries, quality

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    numbers = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(numbers) == sorted(f"op{i}" for i in range(1, 11))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.SQL[name]) is None


@needs_tables
def test_stages_keep_their_promises(spark):
    from test_joins import expected as joined
    from test_lines import expected as lined
    from test_secrets import plain

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    stages = dict(pipeline.STAGES)
    chosen = {r["doc_id"] for r in quality.resample(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("kept").collect()}
    one = stages["quality_classifier"](spark, docs, SF).cache()
    assert {r[0] for r in rows(one)} == chosen and set(rows(one)) <= set(rows(docs))
    two = stages["line_dedup"](spark, one, SF).cache()
    want = {(i, h) for i, _, _, h in lined(rows(one))}
    assert {tuple(r) for r in two.select("doc_id", F.sha2("text", 256)).collect()} == want and two.columns == docs.columns
    assert two.where("n_chars <> char_length(text)").count() == 0
    three = stages["near_duplicates"](spark, two, SF).cache()
    classes, n = joined(rows(two))
    assert sorted(r[0] for r in rows(three)) == sorted({c for _, c, _ in classes}) and three.count() == n
    four = stages["secret_scan"](spark, three, SF).cache()
    assert four.count() == n and not any(plain(r[1]) for r in rows(four))
    five = stages["pattern_packing"](spark, four, SF)
    assert {r["doc_id"] for r in five.collect()} == {r[0] for r in rows(four)}


@needs_tables
def test_rejected_documents_can_be_audited(spark):
    got = queries.QUERIES["op2_importance_resampling"](spark, SF).select("kept", "log_weight").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and {r["kept"] for r in got} == {True, False}
    assert all(r["log_weight"] is not None for r in got)


def test_odd_documents_pass_every_stage(spark, tmp_path):
    odd.clashing(odd.frame(spark), "node", "n_lines").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() > 10
    none = str(tmp_path / "none")
    odd.frame(spark, []).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert pipeline.run(spark, none).count() == 0


