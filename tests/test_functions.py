"""Column functions against stated values."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmac.functions import board, geo, text, timing, weather
from tarmac.functions.identity import payload_hash


def one(spark, col, **values):
    """Value of an expression over a single row of string columns."""
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(col.alias("r")).first()["r"]


def many(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_visibility(spark):
    cases = {
        "10+": 10.0, "10": 10.0, "3.5": 3.5, "6+": 6.0, "1/2": 0.5, "1 1/2": 1.5, "1/4": 0.25, "10SM": 10.0,
        "unknown": None, "10+SM": None, "P6SM": None, "3/0": None, "nan": None, "": None, "\t2 ": 2.0, "1  1/2": 1.5,
    }
    assert many(spark, weather.visibility_sm, list(cases)) == list(cases.values())


def test_wind(spark):
    d = weather.wind_dir(F.col("d"))
    v = weather.wind_variable(d, F.col("raw"))
    assert one(spark, F.struct(d, v), d="VRB", raw="X VRB04KT") == (None, True)
    assert one(spark, F.struct(d, v), d=" vrb ", raw="X VRB04KT") == (None, True)
    assert one(spark, F.struct(d, v), d=None, raw="X 27010KT") == (None, False)
    assert one(spark, F.struct(d, v), d="270", raw="X VRB") == (270, False)
    assert many(spark, weather.wind_dir_readable, ["270", "VRB", None, "west", "270.5"]) == [True, True, True, False, False]


def test_ceiling(spark):
    def ceiling(layers):
        df = spark.createDataFrame([(layers,)], "c array<struct<cover:string,base_ft:int>>")
        return df.select(weather.ceiling_ft(F.col("c")).alias("r")).first()["r"]

    assert ceiling([("BKN", 2000), ("OVC", 3500)]) == 2000
    assert ceiling([("FEW", 500), ("SCT", 900)]) is None
    assert ceiling([("VV", None), ("OVX", 100)]) == 100
    assert ceiling([]) is None and ceiling(None) is None


def test_text(spark):
    assert many(spark, text.clean_callsign, ["QXA17K  ", "   ", "\tX\n", None]) == ["QXA17K", None, "X", None]
    assert many(spark, text.clean_text, [" 'Boeing' ", '"A320"', "''", " ", "a'b"]) == ["Boeing", "A320", None, None, "a'b"]
    assert many(spark, text.built_year, ["2011", "2011-05-14", "", "n/a", "0003", "2101", "'1999'"]) == [2011, 2011, None, None, None, None, 1999]
    assert many(spark, text.delay_minutes, ["45 minutes", "1 hour and 15 minutes", "2 hours", "soon", None]) == [45, 75, 120, None, None]
    assert many(spark, text.event_type, ["Ground Stop Programs", "Deicing", "Other", None]) == ["ground_stop", "deicing", None, None]
    assert one(spark, text.first_text(F.col("a"), F.col("b")), a="  ", b=" x ") == "x"
    assert one(spark, text.norm_icao24(F.col("a")), a="3C6444") == "3c6444"
    assert one(spark, text.norm_faa(F.col("a")), a="ewr") == "EWR"


@pytest.mark.parametrize(("built", "year", "age"), [(2011, 2026, 15), (2011, 2030, 19), (None, 2026, None), (2030, 2026, None)])
def test_age(spark, built, year, age):
    df = spark.createDataFrame([(built,)], "b int")
    assert df.select(text.aircraft_age(F.col("b"), year).alias("r")).first()["r"] == age


def test_bounding_box(spark):
    def box(lat, lon, r):
        df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
        return df.select(geo.bounding_box(F.col("lat"), F.col("lon"), r).alias("b")).first()["b"]

    b = box(40.6398, -73.7789, 60)
    assert b["lamax"] - b["lamin"] == pytest.approx(2.0)
    assert b["lomax"] - b["lomin"] == pytest.approx(2 / 0.75886, rel=1e-3)
    assert b["lomin"] < -73.7789 < b["lomax"]
    # 1000 nm is 16.7 degrees of latitude and, at 78.246 N, 81.8 of longitude.
    b = box(78.246, 15.4656, 1000)
    assert b["lamax"] == 90.0 and -180 <= b["lomin"] and b["lomax"] == pytest.approx(97.28, abs=0.01)
    b = box(78.246, 120.0, 1000)
    assert b["lomax"] == 180.0
    with pytest.raises(ValueError, match="radius above zero"):
        geo.bounding_box(F.lit(1.0), F.lit(1.0), 0)


def test_heading_delta(spark):
    df = spark.createDataFrame([(350.0, 10.0), (10.0, 350.0), (0.0, 180.0), (90.0, 90.0)], "a double, b double")
    got = [r["r"] for r in df.select(geo.heading_delta(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [20.0, -20.0, -180.0, 0.0]


def test_hash_classes(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (1, "y", "x"), (None, "1", "x")], "a int, b string, c string")
    h = [r["h"] for r in df.select(payload_hash(["c", "a", "b"]).alias("h")).collect()]
    again = [r["h"] for r in df.select(payload_hash(["a", "b", "c"]).alias("h")).collect()]
    assert h == again and h[0] == h[1] and len(set(h)) == 3 and len(h[0]) == 32
    fewer = df.select(payload_hash(["a", "c"]).alias("h")).first()["h"]
    assert fewer != h[0]  # a null field is not an absent one


def test_times(spark):
    df = spark.sql("SELECT timestamp'2026-08-07 14:32:10' AS ts")
    r = df.select(
        *timing.partition_keys(F.col("ts")), timing.window_key(F.col("ts")).alias("w"),
        timing.day_anchor(F.col("ts"), 6).alias("six"), timing.day_anchor(F.col("ts"), 0, "Asia/Singapore").alias("sgt"),
    ).first()
    assert (r["date"], r["hour"]) == ("2026-08-07", "14")
    assert r["w"] == datetime(2026, 8, 7, 14, 30) and r["six"] == datetime(2026, 8, 7, 6)
    assert r["sgt"] == datetime(2026, 8, 6, 16)
    assert many(spark, timing.epoch_utc, ["1458564120", "true", "x", None]) == [datetime(2016, 3, 21, 12, 42), None, None, None]


def test_notice_times(spark):
    df = spark.createDataFrame(
        [
            ("May 27 at 18:26 UTC.", "May 28 at 16:00 UTC.", "!SEA 11/042 TEL 555-010-0147 2605271826-2705281600"),
            ("Aug 08 at 02:00 UTC.", "18:00", "no group"),
            ("Dec 30 at 01:00 UTC.", "Feb 29 at 01:00 UTC.", None),
        ],
        "s string, e string, r string",
    ).withColumn("a", F.lit("2026-08-08 09:02:20").cast("timestamp"))
    start, end = timing.program_times(F.col("s"), F.col("e"), F.col("r"), F.col("a"))
    got = [tuple(r) for r in df.select(start.alias("x"), end.alias("y")).collect()]
    assert got[0] == (datetime(2026, 5, 27, 18, 26), datetime(2027, 5, 28, 16))
    assert got[1] == (datetime(2026, 8, 8, 2), datetime(2026, 8, 8, 18))
    assert got[2] == (datetime(2026, 12, 30, 1), None)  # no leap day in 2025-2027


def test_board(spark):
    df = spark.createDataFrame([("SQ 12", "Paris", "CDG", "delayed", 0.5)], "n string, c string, k string, s string, p double")
    hit = lambda q: board.board_match(q, F.col("n"), F.col("c"), F.col("k"))
    r = df.select(
        hit("sq12").alias("a"), hit("s q 1 2").alias("b"), hit("par").alias("c"), hit("cdg").alias("d"), hit("").alias("e"), hit("zz").alias("f"),
        board.status_group(F.col("s"), "active").alias("g"), board.status_group(F.col("s"), "done").alias("h"), board.risk_band(F.col("p")).alias("i"),
    ).first()
    assert tuple(r) == (True, True, True, True, True, False, True, False, "medium")
