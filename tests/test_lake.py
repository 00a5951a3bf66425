"""Layers on storage: append, replace, compact, late rows, restart, backfill."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.schemas import SCHEMAS
from tarmac.sources import lake
from tarmac.sources.airports import airports_df
from tarmac.streaming import flows


def files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def batch(spark, n, at, airport="JFK"):
    rows = [(f"p{i}", at, f"h{i}", airport, "closure", None, None, None, None, None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMAS["faa_status"])


def test_append(spark, tmp_path):
    root, at = str(tmp_path), datetime(2026, 8, 7, 7, 32, 10)
    assert lake.append_bronze(batch(spark, 0, at), root, "faa_status") == lake.WriteResult(0, 0)
    assert files(root) == []
    first = lake.append_bronze(batch(spark, 3, at), root, "faa_status")
    kept = files(root)
    assert first.rows == 3 and first.bytes > 0 and len(kept) == 1 and "date=2026-08-07/hour=07" in kept[0]
    lake.append_bronze(batch(spark, 3, at), root, "faa_status")
    assert len(files(root)) == 2 and set(kept) < set(files(root))
    rows = lake.read_layer(spark, root, "faa_status")
    assert rows.count() == 6 and rows.select("hour").distinct().first()["hour"] == "07"


def test_range_prunes_partitions(spark, tmp_path):
    root = str(tmp_path)
    for d in (1, 2, 3):
        lake.append_bronze(batch(spark, 2, datetime(2026, 8, d, 5)), root, "faa_status")
    part = lake.read_layer(spark, root, "faa_status", datetime(2026, 8, 2), datetime(2026, 8, 2, 12))
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(ingested_at)" in plan


def test_wrong_columns_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="raw_xml"):
        lake.append_bronze(batch(spark, 1, datetime(2026, 1, 1)).drop("raw_xml"), str(tmp_path), "faa_status")
    with pytest.raises(ValueError, match="differ"):
        lake.union_layers(batch(spark, 1, datetime(2026, 1, 1)), batch(spark, 1, datetime(2026, 1, 1)).drop("reason"))


def test_reference_replacement(spark, tmp_path):
    path = str(tmp_path / "ref")
    df = spark.createDataFrame([("a", "r", "t", "m", "n", "o", "p", 2000)], SCHEMAS["aircraft"])
    lake.replace_reference(df, path)
    with pytest.raises(ValueError, match="empty"):
        lake.replace_reference(df.limit(0), path)
    assert lake.read_reference(spark, path).count() == 1
    lake.replace_reference(df.unionByName(df.withColumn("icao24", F.lit("b"))), path)
    assert lake.read_reference(spark, path).count() == 2


def test_compaction(spark, tmp_path):
    root, at = str(tmp_path), datetime(2026, 8, 7, 7, 32)
    for i in range(4):
        lake.append_bronze(batch(spark, 5, at + timedelta(minutes=i)), root, "faa_status")
    lake.append_bronze(batch(spark, 5, at + timedelta(days=1)), root, "faa_status")
    reader = lake.read_layer(spark, root, "faa_status")
    before = lake.content_fingerprint(reader)
    done = lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9))
    assert (done["rows"], done["files_before"], done["files_after"]) == (20, 4, 1) and done["bytes_rewritten"] > 0
    assert lake.content_fingerprint(lake.read_layer(spark, root, "faa_status")) == before
    # A frame made before still reads the files that it was made from; afterwards they can go.
    assert lake.content_fingerprint(reader) == before
    assert lake.clean(spark, root, "faa_status", "2026-08-07") == 4 and len(files(root)) == 2
    assert lake.content_fingerprint(lake.read_layer(spark, root, "faa_status")) == before
    with pytest.raises(ValueError, match="still being written"):
        lake.compact(spark, root, "faa_status", "2026-08-09", now=datetime(2026, 8, 9))
    assert lake.drop_before(spark, root, "faa_status", "2026-08-08") == ["2026-08-07"]
    assert lake.read_layer(spark, root, "faa_status").count() == 5 and len(files(root)) == 1


def test_compaction_leaves_large_files(spark, tmp_path):
    root, at = str(tmp_path), datetime(2026, 8, 7, 7, 32)
    for n in (2000, 3, 3, 3):
        lake.append_bronze(batch(spark, n, at), root, "faa_status")
    large = max(files(root), key=os.path.getsize)
    small = sum(os.path.getsize(f) for f in files(root) if f != large)
    limit = os.path.getsize(large)
    done = lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9), small_bytes=limit)
    assert (done["rows"], done["files_before"], done["files_after"]) == (9, 4, 2) and done["bytes_rewritten"] < small
    live = lake._day_state(spark, f"{root}/faa_status", "2026-08-07")[2]
    assert any(large.endswith(f) for f in live)
    again = lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9), small_bytes=limit)
    assert again == {"rows": 0, "files_before": 2, "files_after": 2, "bytes_rewritten": 0}
    # Rows that arrive for the day later are read beside its version, and folded by the next one.
    lake.append_bronze(batch(spark, 4, at), root, "faa_status")
    assert lake.read_layer(spark, root, "faa_status").count() == 2013
    done = lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9), small_bytes=limit)
    assert (done["rows"], done["files_after"]) == (13, 2) and lake.read_layer(spark, root, "faa_status").count() == 2013


def test_files_of_one_name_in_different_hours(spark, tmp_path):
    root = str(tmp_path)
    for k in range(3):
        hours = [batch(spark, 4, datetime(2026, 8, 7, h, k)) for h in (5, 6, 7)]
        lake.append_bronze(hours[0].unionByName(hours[1]).unionByName(hours[2]).coalesce(1), root, "faa_status")
    done = lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9))
    assert (done["rows"], done["files_before"], done["files_after"]) == (36, 9, 3)
    assert {r["count"] for r in lake.read_layer(spark, root, "faa_status").groupBy("hour").count().collect()} == {12}


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    root, at = str(tmp_path), datetime(2026, 8, 7, 7, 32)
    for _ in range(3):
        lake.append_bronze(batch(spark, 5, at), root, "faa_status")
    inner, calls = lake.content_fingerprint, []

    def meanwhile(df):
        if not calls:
            calls.append(1)
            lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9))
        return inner(df)

    monkeypatch.setattr(lake, "content_fingerprint", meanwhile)
    with pytest.raises(RuntimeError, match="another run"):
        lake.compact(spark, root, "faa_status", "2026-08-07", now=datetime(2026, 8, 9))
    assert lake.read_layer(spark, root, "faa_status").count() == 15


def test_a_batch_counts_once(spark, tmp_path):
    root, at = str(tmp_path), datetime(2026, 8, 7, 23, 59)
    rows = batch(spark, 3, at).unionByName(batch(spark, 4, at + timedelta(hours=1)))
    assert lake.append_bronze(rows, root, "faa_status", batch="feed-0").rows == 7
    assert lake.append_bronze(rows, root, "faa_status", batch="feed-0") == lake.WriteResult(0, 0)
    assert lake.read_layer(spark, root, "faa_status").count() == 7
    # Cut off after the first of its days was entered.
    for entry in ("_done/feed-0", "date=2026-08-08/feed-0.json"):
        fs, path = lake._fs(spark, f"{root}/faa_status/_ledger/{entry}")
        assert fs.delete(path, False)
    assert lake.read_layer(spark, root, "faa_status").count() == 3
    lake.append_bronze(rows, root, "faa_status", batch="feed-0")
    assert lake.read_layer(spark, root, "faa_status").count() == 7
    with pytest.raises(ValueError, match="name for a batch"):
        lake.append_bronze(rows, root, "faa_status", batch="v1")


def test_the_source_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = batch(spark, 50, datetime(2026, 8, 7, 7))
    got = lake.append_bronze(df.mapInArrow(counted, df.schema), str(tmp_path), "faa_status")
    assert got.rows == 50 and read.value == 50


def test_stream_killed_between_write_and_checkpoint(spark, tmp_path):
    root, landing = str(tmp_path / "lake"), str(tmp_path / "in")
    schema = SCHEMAS["faa_status"]
    for i in range(3):
        batch(spark, 4 + i, datetime(2026, 8, 7, 5 + i)).coalesce(1).write.mode("append").parquet(landing)
    write, failed = lake.batch_writer(root, "faa_status", "feed"), []

    def killed(df, batch_id):
        write(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("killed after the write")

    def run():
        src = flows.stream_landing(spark, landing, schema, files_per_trigger=1)
        flows.run_to_end(flows.start(src, str(tmp_path / "checkpoint"), each_batch=killed))

    with pytest.raises(Exception, match="killed after the write"):
        run()
    assert lake.read_layer(spark, root, "faa_status").count() == 9
    run()
    assert failed == [1] and lake.read_layer(spark, root, "faa_status").count() == 15
    assert lake.read_layer(spark, root, "faa_status").groupBy("hour").count().count() == 3


def test_airports(spark):
    from tarmac.operators.quality import check_airports

    good = ("KJFK", "n", 40.0, -73.0, "KJFK", "JFK", 1.0, "UTC")
    bad = [("kjfk", "", 91.0, 181.0, "KJ", "J", 1.0, "UTC"), good, good]
    found = {tuple(r) for r in check_airports(_frame(spark, bad)).collect()}
    assert {p for i, p in found if i == "kjfk"} == {"icao", "name", "lat", "lon", "metar_station", "faa_code"}
    assert ("KJFK", "duplicate") in found
    with pytest.raises(ValueError, match="KJFK:duplicate"):
        airports_df(spark, bad)
    with pytest.raises(ValueError, match="no airports"):
        airports_df(spark, [])


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMAS["airports"])


SIGHT = "icao24 string, ts timestamp, payload_hash string"


def test_late_rows_reopen_their_day_only(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "silver"), datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    schema = spark.createDataFrame([], SIGHT).schema
    one = spark.createDataFrame([("a", d1, "h1"), ("a", d2, "h2")], SIGHT)
    flows.merge_late(one, path, "ts", schema)
    untouched = [f for f in files(path) if "2026-01-02" in f]
    late = spark.createDataFrame([("b", d1, "h3"), ("a", d1, "h1")], SIGHT)
    for _ in range(2):  # the replay of a batch changes nothing
        flows.merge_late(late, path, "ts", schema)
    assert spark.read.schema(schema).parquet(path).count() == 3
    assert [f for f in files(path) if "2026-01-02" in f] == untouched


def test_backfill_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(96).select((F.lit("2026-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"), "id")

    def job(a, b):
        return df

    flows.backfill(job, path, "ts", datetime(2026, 1, 1), datetime(2026, 1, 4))
    want = lake.content_fingerprint(spark.read.schema("ts timestamp, id bigint, date string").parquet(path))
    flows.backfill(job, path, "ts", datetime(2026, 1, 2), datetime(2026, 1, 4))
    assert lake.content_fingerprint(spark.read.schema("ts timestamp, id bigint, date string").parquet(path)) == want
    assert want[0] == 72
    with pytest.raises(ValueError, match="midnight"):
        flows.backfill(job, path, "ts", datetime(2026, 1, 1, 1), datetime(2026, 1, 4))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tarmac.session import scratch_dir

    class Fake:
        class conf:
            @staticmethod
            def get(k, d):
                return d

        class sparkContext:
            master = "spark://x"

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_dir(Fake, "x")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_stream_silver_collapses_repeats(spark, tmp_path):
    at = datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", "KJFK", at + timedelta(minutes=i)) for i in range(6)] + [("b", "KEWR", at)], "icao24 string, airport string, ingested_at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    once = flows.stream_silver(flows.stream_landing(spark, str(tmp_path / "in"), df.schema))
    flows.run_to_end(flows.start(once, str(tmp_path / "cp"), path=str(tmp_path / "out")))
    out = spark.read.schema(once.schema).parquet(str(tmp_path / "out"))
    assert out.count() == 2
