"""Payload readers on hand-written bodies."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmac.operators import quality
from tarmac.schemas import SCHEMAS
from tarmac.sources import aircraft, faa, ontime, states, weather

AT = datetime(2026, 8, 8, 9, 2, 20)
GOOD = ["a0b1c2", "TST42   ", "Nowhere", 1700000000, 1700000000, -73.5, 40.25, 3048.0, False, 120.5, 270.0, -3.25, None, 3100.5, "4321", False, 0]


def land(spark, *bodies):
    rows = [(f"p{i}", "KJFK", AT, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, SCHEMAS["landing"])


def reasons(spark, *vectors):
    body = json.dumps({"time": 1700000010, "states": list(vectors)})
    judged = quality.validate_states(states.parse_states(land(spark, body)))
    return [sorted(r[quality.REASONS]) for r in judged.collect()]


def changed(i, v):
    return GOOD[:i] + [v] + GOOD[i + 1 :]


def test_state_vector(spark):
    body = json.dumps({"time": 1700000010, "states": [GOOD, [*GOOD, 3], changed(12, [1, 2])]})
    rows = states.parse_states(land(spark, body)).collect()
    r = rows[0]
    assert (r["icao24"], r["callsign"], r["on_ground"], r["squawk"]) == ("a0b1c2", "TST42", False, "4321")
    assert r["last_contact"] == datetime(2023, 11, 14, 22, 13, 20) and r["response_time"] == datetime(2023, 11, 14, 22, 13, 30)
    assert r["payload_hash"] == rows[1]["payload_hash"] != rows[2]["payload_hash"]
    assert rows[2]["sensors"] == [1, 2]


def test_state_rejects(spark):
    got = reasons(
        spark, GOOD, GOOD[:10], ["extra", *GOOD], changed(6, 1234.5), changed(9, -1), changed(10, 361), changed(4, None), changed(8, None), changed(5, "east"), changed(4, True)
    )
    assert got[0] == []
    assert "elements" in got[1] and "icao24" in got[2]
    assert got[3:8] == [["latitude"], ["velocity"], ["track"], ["last_contact"], ["on_ground"]]
    assert got[8] == ["misread"] and "last_contact" in got[9]


def test_same_aircraft_from_two_boxes_is_one_fact(spark):
    body = json.dumps({"time": 1700000010, "states": [GOOD]})
    df = land(spark, body, body).withColumn("airport", F.when(F.col("poll_id") == "p0", "KEWR").otherwise("KJFK"))
    from tarmac.operators.dedupe import dedupe

    one = dedupe(states.parse_states(df).drop("n_elements", "misread")).collect()
    assert len(one) == 1 and one[0]["times_seen"] == 2 and one[0]["seen_from"] == ["KEWR", "KJFK"]


def test_empty_and_broken_states(spark):
    df = land(spark, '{"time": 1, "states": null}', '{"time": 1, "states": []}', "<html>", '{"states": []}')
    assert states.parse_states(df).count() == 0
    assert sorted(r["poll_id"] for r in states.unreadable_states(df).collect()) == ["p2", "p3"]


def test_bronze_schema_is_pinned(spark):
    body = json.dumps({"time": 1700000010, "states": [GOOD]})
    bronze = states.to_bronze(states.parse_states(land(spark, body)))
    assert [f.name for f in bronze.schema.fields] == [f.name for f in SCHEMAS["states"].fields]
    with pytest.raises(ValueError, match="velocity_ms"):
        states.to_bronze(bronze.withColumn("velocity_ms", F.lit("fast")))


# An invented report.
METAR = {
    "icaoId": "KSEA", "obsTime": 1767247200, "rawOb": "METAR KSEA 010600Z VRB03KT 9SM BKN030 OVC060", "temp": 4.5, "dewp": 1.5, "wdir": "VRB",
    "wspd": 3, "visib": "9+", "altim": 1002.7, "fltCat": "MVFR", "elev": 130, "clouds": [{"cover": "BKN", "base": 6000}, {"cover": "OVC", "base": 3000}],
}


def test_metar(spark):
    less = {k: v for k, v in METAR.items() if k not in ("clouds", "temp")}
    bare = {**METAR, "wdir": 250, "visib": 6}
    rows = weather.silver_metar(weather.parse_metar(land(spark, json.dumps([METAR, less]), json.dumps(bare)))).collect()
    assert len(rows) == 3
    a, b, c = rows
    assert (a["station"], a["wind_dir_deg"], a["wind_variable"], a["visibility_sm"], a["ceiling_ft"], a["flight_category"]) == ("KSEA", None, True, 9.0, 3000, "MVFR")
    assert a["obs_time"] == datetime(2026, 1, 1, 6)
    assert b["clouds"] == [] and b["temp_c"] is None and b["ceiling_ft"] is None
    assert (c["wind_dir_deg"], c["visibility_sm"]) == (250, 6.0)
    twice = weather.parse_metar(land(spark, json.dumps([METAR]), json.dumps([METAR])))
    assert twice.select("payload_hash").distinct().count() == 1


def test_metar_rejects(spark):
    df = weather.parse_metar(land(spark, json.dumps([{"icaoId": "KJFK"}, {"obsTime": 1}, {**METAR, "wdir": "west"}, METAR])))
    got = [r[quality.REASONS] for r in quality.validate_weather(df).collect()]
    assert got == [["obs_time"], ["station"], ["misread"], []]
    assert weather.unreadable_list(land(spark, "oops", "[]"), weather.METAR_JSON).count() == 1


def test_taf(spark):
    taf = {
        "icaoId": "KJFK", "validTimeFrom": 1704110400, "validTimeTo": 1704196800, "rawTAF": "x",
        "fcsts": [{"timeFrom": 1704110400, "timeTo": 1704153600, "wdir": "VRB", "wspd": 10, "visib": "1/2", "clouds": [{"cover": "OVC", "base": 400}]}],
    }
    parsed = weather.parse_taf(land(spark, json.dumps([taf, {"icaoId": "KEWR", "fcsts": None}])))
    flat = weather.explode_taf(parsed).orderBy("station").collect()
    assert [(r["station"], r["visibility_sm"], r["ceiling_ft"], r["severity"]) for r in flat] == [("KEWR", None, None, None), ("KJFK", 0.5, 400, 3)]
    assert parsed.select(*[f.name for f in SCHEMAS["taf"].fields]).schema.simpleString() == SCHEMAS["taf"].simpleString()


def notice(*sections):
    return '<?xml version="1.0"?><AIRPORT_STATUS_INFORMATION>' + "".join(f"<Delay_type><Name>{n}</Name>{x}</Delay_type>" for n, x in sections) + "</AIRPORT_STATUS_INFORMATION>"


CLOSURES = "<Airport_Closure_List><Airport><ARPT>{}</ARPT><Reason>r</Reason><Start>Aug 08 at 02:00 UTC.</Start><Reopen>Aug 08 at 05:00 UTC.</Reopen></Airport>{}</Airport_Closure_List>"


def test_faa(spark):
    doc = notice(
        ("Ground Stop Programs", "<Ground_Stop_List><Program><ARPT>ewr</ARPT><Reason>storms</Reason><End_Time>18:00</End_Time></Program></Ground_Stop_List>"),
        ("Airport Closures", CLOSURES.format("PVD", "<Airport><Reason>nameless</Reason></Airport>")),
        ("Airport Closures", CLOSURES.format("LAX", "<Airport><Arpt>HNL</Arpt><Start> </Start><Begin_Time>x</Begin_Time></Airport>")),
        ("Volcano Watch", CLOSURES.format("SAN", "")),
    )
    rows = faa.parse_faa(land(spark, doc)).orderBy("airport").collect()
    assert [(r["airport"], r["event_type"], r["start_text"], r["end_text"]) for r in rows] == [
        ("EWR", "ground_stop", None, "18:00"), ("HNL", "closure", "x", None),
        ("LAX", "closure", "Aug 08 at 02:00 UTC.", "Aug 08 at 05:00 UTC."), ("PVD", "closure", "Aug 08 at 02:00 UTC.", "Aug 08 at 05:00 UTC."),
    ]
    assert rows[1]["raw_xml"].startswith("<Airport><Arpt>HNL") and rows[2]["raw_xml"].count("ARPT>LAX") == 1
    silver = faa.silver_faa(faa.parse_faa(land(spark, doc))).filter("airport = 'EWR'").first()
    assert silver["end_ts"] == datetime(2026, 8, 8, 18)


def test_faa_trouble(spark):
    bomb = '<!DOCTYPE a [<!ENTITY b "c">]>' + notice(("Deicing", ""))
    new = notice(("Deicing", "<Frost_List><Frost><ARPT>JFK</ARPT></Frost></Frost_List>"))
    df = land(spark, notice(), "<broken", bomb, new)
    parsed = faa.parse_faa(df)
    # A wrapper never seen before is read like any other.
    assert [r["airport"] for r in parsed.collect()] == ["JFK"]
    assert sorted(r["poll_id"] for r in faa.unreadable_faa(df).collect()) == ["p1", "p2"]
    assert faa.unseen_records(df, parsed).count() == 0


def write(tmp_path, text):
    p = tmp_path / "aircraft.csv"
    p.write_text(text)
    return str(p)


def test_aircraft(spark, tmp_path):
    got = aircraft.read_aircraft(
        spark, write(tmp_path, "ICAO24, reg,icaoAircraftType,manufacturer,built,firstFlightDate\n3C6444,'D-AIBL',A319,Airbus,,2011-05-14\n ,x,y,z,2000,\nabcdef,,,,2011-05-14,\n")
    ).orderBy("icao24").collect()
    assert [(r["icao24"], r["registration"], r["typecode"], r["manufacturer"], r["built"]) for r in got] == [
        ("3c6444", "D-AIBL", "A319", "Airbus", None), ("abcdef", None, None, None, 2011)
    ]  # the blank `built` of the first row does not fall back to another column


def test_aircraft_trouble(spark, tmp_path):
    with pytest.raises(ValueError, match="icao24"):
        aircraft.read_aircraft(spark, write(tmp_path, "registration,model\nx,y\n"))
    with pytest.raises(ValueError, match="header|icao24"):
        aircraft.read_aircraft(spark, write(tmp_path, ""))


def test_ontime_clock_is_local(spark, airports, tmp_path):
    (tmp_path / "m.csv").write_text(
        "airport,scheduled,actual\nJFK,2026-03-08 01:30:00,2026-03-08 03:15:00\nORD,2026-07-01 12:00:00,2026-07-01 12:20:00\nLAX,2026-07-01 12:00:00,2026-07-01 12:20:00\n"
    )
    got = {r["airport"]: r for r in ontime.read_ontime(spark, str(tmp_path), airports).collect()}
    assert set(got) == {"KJFK", "KORD"}
    # The clocks go forward between the two: 105 clock minutes are 45 real ones.
    assert (got["KJFK"]["actual"] - got["KJFK"]["scheduled"]).total_seconds() == 45 * 60
    assert got["KORD"]["scheduled"] == datetime(2026, 7, 1, 17)


def test_flight_interval(spark):
    df = spark.createDataFrame([("a", AT, "KJFK", AT, "KEWR", "c")], ontime.FLIGHTS)
    assert ontime.flights_by_airport(df, "KEWR", datetime(2026, 8, 8, 9), datetime(2026, 8, 8, 10)).count() == 1
    for bad in [(datetime(2026, 8, 8), datetime(2026, 8, 9)), (datetime(2026, 8, 8, 2), datetime(2026, 8, 8, 1))]:
        with pytest.raises(ValueError):
            ontime.flights_by_airport(df, "KEWR", *bad)
    with pytest.raises(ValueError, match="code"):
        ontime.flights_by_airport(df, "TOOLONG", datetime(2026, 8, 8), datetime(2026, 8, 8))


def test_ontime_is_read_by_header(spark, airports, tmp_path):
    (tmp_path / "a.csv").write_text("actual,extra,airport,scheduled\n2026-07-01 12:20:00,x,ORD,2026-07-01 12:00:00\n")
    got = ontime.read_ontime(spark, str(tmp_path / "a.csv"), airports, local_clock=False).collect()
    assert [(r["airport"], r["scheduled"], r["actual"]) for r in got] == [("KORD", datetime(2026, 7, 1, 12), datetime(2026, 7, 1, 12, 20))]
    (tmp_path / "b.csv").write_text(
        "FlightDate,Dest,Origin,DepDelay,CRSDepTime,Cancelled,Diverted\n"
        "2026-07-01,LAX,JFK,45.00,2350,0.00,0.00\n2026-07-01,LAX,JFK,,0700,1.00,0.00\n2026-07-01,LAX,JFK,5,0700,0,1\n"
        "2026-07-01,LAX,JFK,-5,0005,0,0\n2026-07-01,LAX,JFK,5,2590,0,0\n2026-07-01,LAX,,5,0700,0,0\n2026-07-01,LAX,JFK,,0700,0,0\n"
    )
    rows = ontime.scan_ontime(spark, str(tmp_path / "b.csv"))
    assert sorted(r["reason"] or "" for r in rows.collect()) == ["", "", "actual", "airport", "cancelled", "diverted", "scheduled"]
    got = ontime.read_ontime(spark, str(tmp_path / "b.csv"), airports, local_clock=False).orderBy("scheduled").collect()
    assert [(r["scheduled"], r["actual"]) for r in got] == [
        (datetime(2026, 7, 1, 0, 5), datetime(2026, 7, 1)), (datetime(2026, 7, 1, 23, 50), datetime(2026, 7, 2, 0, 35))]
    (tmp_path / "c.csv").write_text("Origin,Dest\nJFK,LAX\n")
    with pytest.raises(ValueError, match="lacks day, clock, delay"):
        ontime.read_ontime(spark, str(tmp_path / "c.csv"), airports)


def test_faa_records_of_any_wrapper(spark):
    doc = notice(
        ("Ground Stop Programs", "<Ground_Stop_List><Ground_Stop><ARPT>EWR</ARPT><Reason>a</Reason></Ground_Stop></Ground_Stop_List>"),
        ("Airport Closures", "<New_List><Wrap><Item><Reason>b</Reason><Empty/><ARPT>JFK</ARPT><Arrival_Departure><Min>1</Min></Arrival_Departure><Start>x</Start></Item></Wrap></New_List>"),
    )
    got = faa.parse_faa(land(spark, doc)).orderBy("airport").collect()
    assert [(r["airport"], r["reason"], r["start_text"]) for r in got] == [("EWR", "a", None), ("JFK", "b", "x")]
    assert got[0]["raw_xml"].startswith("<Ground_Stop>") and got[1]["raw_xml"].endswith("</Item>")
    assert faa.unseen_records(land(spark, doc), faa.parse_faa(land(spark, doc))).count() == 0
    assert faa.parse_faa(land(spark, "<!doctype x>" + doc)).count() == 0


def test_faa_reads_the_tree_not_the_text(spark):
    hidden = "<!-- <Delay_type><Name>Airport Closures</Name><A><ARPT>ZZZ</ARPT></A></Delay_type> -->"
    doc = notice(("Ground Stop Programs", "<L><P><Detail><Item><ARPTS>no</ARPTS></Item></Detail><ARPT code='x &gt; y'>jfk</ARPT><Reason><![CDATA[a < b]]></Reason></P></L>"))
    doc = doc.replace("<Delay_type>", hidden + '<Delay_type id="1 > 0">') .replace("</AIRPORT", "<Delay_type><Name>Airport Closures</Name><Q><W><Arpt>EWR</Arpt><Start>s<!-- c -->t</Start></W></Q></Delay_type></AIRPORT")
    df = land(spark, doc)
    got = faa.parse_faa(df).orderBy("airport").collect()
    assert [(r["airport"], r["event_type"], r["reason"], r["start_text"]) for r in got] == [("EWR", "closure", None, "st"), ("JFK", "ground_stop", "a < b", None)]
    assert got[1]["raw_xml"].startswith("<P><Detail>") and "a &lt; b" in got[1]["raw_xml"] and got[1]["raw_xml"].endswith("</P>")
    assert faa.unseen_records(df, faa.parse_faa(df)).count() == 0
    assert faa.unreadable_faa(df).count() == 0


def test_faa_names_what_it_did_not_read(spark):
    odd = notice(("Airport Closures", '<L><P><arpt a="1">JFK</arpt></P><n:P xmlns:n="u"><n:ARPT>EWR</n:ARPT></n:P><P><ARPT> </ARPT></P></L>'))
    df = land(spark, odd)
    parsed = faa.parse_faa(df)
    assert parsed.count() == 0
    assert [(r["named"], r["parsed"]) for r in faa.unseen_records(df, parsed).collect()] == [(2, 0)]


def test_faa_odd_bodies(spark):
    deep = "<x>" * 300 + "<ARPT>JFK</ARPT>" + "</x>" * 300
    df = land(spark, None, "", "<a>", notice(("Deicing", deep)), notice())
    assert faa.parse_faa(df).count() == 1 and faa.unreadable_faa(df).count() == 3
    assert faa.parse_faa(df.limit(0)).count() == 0 and faa.unseen_records(df.limit(0), faa.parse_faa(df.limit(0))).count() == 0


def test_notices_become_arrow_in_small_parts(monkeypatch):
    import pyarrow as pa

    from tarmac.sources import faa

    body = "<A><Delay_type><Name>N</Name><L><P><ARPT>SEA</ARPT></P></L></Delay_type></A>"
    bodies, sizes, build = [body, None, "<broken", body] * 50, [], pa.array

    def array(values, *args):
        sizes.append(len(values))
        return build(values, *args)

    whole = faa._read_notices(pa.array(bodies)).to_pylist()
    monkeypatch.setattr(faa, "_AT_ONCE", 1000)
    monkeypatch.setattr(faa.pa, "array", array)
    assert faa._read_notices(build(bodies)).to_pylist() == whole and max(sizes) < 40 and sum(sizes) == 200
    assert [w and w["named"] for w in whole[:4]] == [1, None, None, 1]
