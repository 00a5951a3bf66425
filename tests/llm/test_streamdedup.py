"""Streaming deduplication against groups of equal texts."""

from __future__ import annotations

import shutil
from collections import defaultdict
from hashlib import sha256

import pytest

import odd
from tarmac.llm import streamdedup


def expected(rows):
    """(doc_id, keep_id, group_size, kept, digest) for rows (id, text) with different ids or equal rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = 1
        for i in ids:
            out.append((i, keep, len(ids), i == keep and stays == 1, sha256(t.encode()).hexdigest()))
            stays -= i == keep
    return sorted(out, key=repr)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(n, texts=40):
    # A third of all rows share one text.
    return [(i * 7 % 1009, "the same" if i % 3 == 0 else f"text {i % texts}") for i in range(n)]


def test_one_run(spark, tmp_path):
    rows = rows_of(600)
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7).write.parquet(f"{tmp_path}/docs")
    got = streamdedup.deduplicate(spark, f"{tmp_path}/docs")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert listed(got) == expected(rows)


def test_state_lasts_over_batches_and_restarts(spark, tmp_path):
    rows = rows_of(500)
    docs, state = f"{tmp_path}/docs", f"{tmp_path}/state"
    few = streamdedup.Settings(shards=5, batch_bytes=1000)
    for part in range(3):
        own = [r for i, r in enumerate(rows) if i % 3 == part]
        spark.createDataFrame(own, "doc_id bigint, text string").repartition(2).write.mode("append").parquet(docs)
        got = streamdedup.deduplicate(spark, docs, state, few)
    assert listed(got) == expected(rows)
    corpus = streamdedup.Corpus(spark, docs, state, settings=few)
    seen = corpus.seen()
    assert seen.where("known_file IS NULL").count() == seen.select("digest").distinct().count()
    # No locator is compared with more than a few hits: one of its own, one in its batch, one for each later batch.
    assert max(r["count"] for r in seen.where("known_file IS NOT NULL").groupBy("known_file", "known_row").count().collect()) <= 7
    corpus.advance()  # nothing new
    assert corpus.seen().count() == seen.count()


def test_equal_digests_of_different_texts(spark, tmp_path):
    rows = rows_of(300, texts=90)
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_path}/docs")
    short = streamdedup.Settings(shards=3, digest_bytes=1, batch_bytes=1000)
    corpus = streamdedup.Corpus(spark, f"{tmp_path}/docs", f"{tmp_path}/state", settings=short)
    corpus.advance()
    disputed = corpus.check()
    assert disputed.count() > 0
    assert listed(corpus.outcome(disputed)) == expected(rows)


def test_a_lost_run_goes_on(spark, tmp_path, monkeypatch):
    rows = rows_of(200)
    docs, state = f"{tmp_path}/docs", f"{tmp_path}/state"
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(docs)
    few = streamdedup.Settings(shards=4, batch_bytes=1)
    corpus = streamdedup.Corpus(spark, docs, state, settings=few)
    corpus.advance()
    # As if the last micro-batch had been cut off before it was committed.
    commits = sorted((tmp_path / "state/checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) == 4
    commits[-1].unlink()
    (tmp_path / f"state/checkpoint/commits/.{commits[-1].name}.crc").unlink(missing_ok=True)
    corpus.advance()
    assert listed(corpus.outcome(corpus.check())) == expected(rows)


def test_odd_rows(spark, tmp_path):
    df = odd.clashing(odd.frame(spark), "digest", "file", "row", "_metadata", "shard", "kept")
    df.write.parquet(f"{tmp_path}/docs")
    got = listed(streamdedup.deduplicate(spark, f"{tmp_path}/docs"))
    rows = [(r[0], r[1]) for r in odd.rows()]
    want = expected([r for r in rows if r[0] is not None])
    assert sorted((r for r in got if r[0] is not None and r[4] != sha256(b"").hexdigest()), key=repr) == [r for r in want if r[4] != sha256(b"").hexdigest()]
    empty = [r for r in got if r[4] == sha256(b"").hexdigest()]
    assert {r[0] for r in empty} == {None, 0, 3} and {r[1:4] for r in empty if r[0] != 3} == {(3, 3, False)}
    lone = [r for r in got if r[0] is None and r[1] is None]
    assert len(lone) == 1 and lone[0][3] is True


def test_no_rows(spark, tmp_path):
    odd.frame(spark, []).write.parquet(f"{tmp_path}/docs")
    assert streamdedup.deduplicate(spark, f"{tmp_path}/docs").count() == 0


def test_a_single_file(spark, tmp_path):
    rows = rows_of(50)
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    part = next((tmp_path / "docs").glob("*.parquet"))
    shutil.copy(part, tmp_path / "documents.parquet")
    assert listed(streamdedup.deduplicate(spark, f"{tmp_path}/documents.parquet")) == expected(rows)


def test_settings_of_the_session_stay(spark):
    key = next(iter(streamdedup.STORE))
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), streamdedup._set(spark, {key: "x"}):
        assert spark.conf.get(key) == "x"
        _ = 1 / 0
    assert spark.conf.get(key, None) == before
