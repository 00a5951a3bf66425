"""One landing for all feeds: routing, quarantine, and exactly-once over a crash."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from tarmac.sources import lake
from tarmac.streaming import feeds, flows

AT = datetime(2026, 1, 1, 6)
STATE = ["abc123", "X", "Y", 1767247200, 1767247200, 1.0, 2.0, 3.0, False, 4.0, 5.0, 6.0, None, 7.0, "7700", False, 0]
NOTICE = "<A><Delay_type><Name>Deicing</Name><L><P><ARPT>SEA</ARPT></P></L></Delay_type></A>"


def bodies():
    bad = [*STATE[:6], 999.0, *STATE[7:]]
    return [
        ("states", json.dumps({"time": 1767247200, "states": [STATE, bad]})), ("states", "oops"), ("metar", json.dumps([{"icaoId": "KSEA", "obsTime": 1767247200}, {"obsTime": 1}])),
        ("taf", json.dumps([{"icaoId": "KSEA"}])), ("faa_status", NOTICE), ("faa_status", "<broken"), ("radar", "x"), (None, "y"),
    ]


def land(spark, path, rows):
    data = [(s, f"p{i}", "KSEA", AT, b) for i, (s, b) in enumerate(rows)]
    spark.createDataFrame(data, feeds.landing_schema()).coalesce(1).write.mode("append").parquet(path)


def held(spark, root):
    return {s: lake.read_layer(spark, root, s).count() for s in (*feeds.FEEDS, "quarantine")}


def test_bodies_go_to_their_layers(spark, tmp_path):
    root = str(tmp_path / "lake")
    land(spark, f"{tmp_path}/in", bodies())
    query = feeds.start_feeds(spark, f"{tmp_path}/in", root, f"{tmp_path}/checkpoint")
    flows.run_to_end(query)
    assert held(spark, root) == {"states": 1, "metar": 1, "taf": 1, "faa_status": 1, "quarantine": 6}
    aside = {(r["source"], tuple(r["reasons"])) for r in lake.read_layer(spark, root, "quarantine").collect()}
    assert aside == {("states", ("latitude",)), ("states", ("unreadable",)), ("metar", ("station",)), ("faa_status", ("unreadable",)), ("radar", ("source",)), (None, ("source",))}
    seen = [p["observedMetrics"]["landed"] for p in query.recentProgress if p["observedMetrics"].get("landed")]
    assert [(m["bodies"], m["states"], m["taf"]) for m in seen if m["bodies"]] == [(8, 2, 1)]


def test_a_batch_cut_off_between_its_layers_is_completed(spark, tmp_path, monkeypatch):
    root, write, calls = str(tmp_path / "lake"), lake.append_bronze, []
    for _ in range(2):
        land(spark, f"{tmp_path}/in", bodies())

    def failing(df, root, source, *args, **kw):
        out = write(df, root, source, *args, **kw)
        calls.append(source)
        if len(calls) == 8:  # in the second micro-batch, after its third layer was entered
            raise RuntimeError("killed")
        return out

    monkeypatch.setattr(lake, "append_bronze", failing)

    def run():
        flows.run_to_end(feeds.start_feeds(spark, f"{tmp_path}/in", root, f"{tmp_path}/checkpoint", files_per_trigger=1))

    with pytest.raises(Exception, match="killed"):
        run()
    assert held(spark, root) == {"states": 2, "metar": 2, "taf": 2, "faa_status": 1, "quarantine": 6}
    run()
    assert held(spark, root) == {"states": 2, "metar": 2, "taf": 2, "faa_status": 2, "quarantine": 12}


def test_a_delivery_in_one_file_is_dealt_over_tasks_and_judged_once(spark, tmp_path, monkeypatch):
    root, judged = str(tmp_path / "lake"), []
    write = lake.append_bronze

    def seen(df, root, source, *args, **kw):
        if source == "states":
            relations = df._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation")
            judged.append((df.rdd.getNumPartitions(), relations))
        return write(df, root, source, *args, **kw)

    monkeypatch.setattr(lake, "append_bronze", seen)
    many = [(s, f"p{i}", "KSEA", AT, b) for i, (s, b) in enumerate(bodies()[:1] * 40)]
    landed = spark.createDataFrame(many, feeds.landing_schema()).coalesce(1)
    feeds.route(landed, root, "one")
    # Judged rows are held, and so are the bodies below them.
    assert judged == [(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)]
    assert held(spark, root) == {"states": 40, "metar": 0, "taf": 0, "faa_status": 0, "quarantine": 40}
