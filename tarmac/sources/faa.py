"""Delay-program notices: XML documents to one row per program and airport.

Each document is parsed once, by an Arrow-batched helper that gives out its sections, the records
in them and the number of airports it names. Everything else is column expressions, so the
readers work on batches and on streams alike.
"""

from __future__ import annotations

from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.identity import payload_hash
from tarmac.functions.text import event_type, first_text, norm_faa
from tarmac.functions.timing import program_times

# Accepted spellings per field, first non-blank wins. Fixed values.
AIRPORT = ("ARPT", "Arpt")
START = ("Start", "Start_Time", "Begin_Time")
END = ("Reopen", "End_Time", "Stop_Time", "End")
AVERAGE = ("Avg", "Avg_Delay", "Arrival_Departure")

SECTION, TITLE = "Delay_type", "Name"
_FIELDS = (*AIRPORT, "Reason", *START, *END, *AVERAGE)
_RECORD = f"struct<section:string,{','.join(f'`f_{i}`:string' for i in range(len(_FIELDS)))},raw_xml:string>"
NOTICE = f"struct<records:array<{_RECORD}>,named:int>"

IDENTITY = ["airport", "event_type", "reason", "start_text", "end_text", "avg_delay_text", "raw_xml"]


def safe_body(body: str | Column) -> Column:
    """The text, or null when it declares a document type (entity expansion)."""
    c = F.col(body) if isinstance(body, str) else body
    return F.when(~F.contains(F.lower(c), F.lit("<!doctype")), c)


def _own_text(element: ElementTree.Element, name: str) -> str | None:
    """Text of the first child of this name, up to that child's own children; null without one."""
    child = element.find(name)
    return None if child is None else child.text


def _fragment(element: ElementTree.Element) -> str:
    """The element written out for itself, without the text that follows it."""
    after, element.tail = element.tail, None
    try:
        return ElementTree.tostring(element, encoding="unicode")
    finally:
        element.tail = after


def read_notice(body: str | None) -> dict | None:
    """Records and the number of named airports of one document; null when it is not well-formed.

    A record is an element, at any depth below a section, with an airport among its children.
    """
    if body is None:
        return None
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError:
        return None
    records = []
    for section in root.iter(SECTION):
        title = _own_text(section, TITLE)
        for element in section.iter():
            if element is not section and any(element.find(n) is not None for n in AIRPORT):
                fields = {f"f_{i}": _own_text(element, n) for i, n in enumerate(_FIELDS)}
                records.append({"section": title, **fields, "raw_xml": _fragment(element)})
    wanted = {n.lower() for n in AIRPORT}
    # Under any namespace and spelling, wherever it stands: what a reader of the text would call an airport.
    named = sum(e.tag.rsplit("}", 1)[-1].lower() in wanted and bool((e.text or "").strip()) for e in root.iter())
    return {"records": records, "named": named}


#: Characters of the bodies whose records are Python objects at once; a longer body is read by itself.
_AT_ONCE = 1 << 18


def _read_notices(bodies: pa.Array) -> pa.Array:
    record = pa.struct([(n, pa.string()) for n in ("section", *(f"f_{i}" for i in range(len(_FIELDS))), "raw_xml")])
    kind = pa.struct([("records", pa.list_(record)), ("named", pa.int32())])
    done, held, size = [], [], 0
    for body in bodies:
        text = body.as_py()
        held.append(read_notice(text))
        size += len(text or "")
        if size >= _AT_ONCE:
            done.append(pa.array(held, kind))
            held, size = [], 0
    return pa.concat_arrays([*done, pa.array(held, kind)])


def notice_tree(body: str | Column) -> Column:
    """Struct of the document's records and ``named``; its fields are null for an unreadable or unsafe one.

    Called non-deterministic, since the planner would else read every document once more for a
    filter that it infers from the exploded records.
    """
    return F.arrow_udf(_read_notices, NOTICE).asNondeterministic()(safe_body(body))


def parse_faa(landed: DataFrame, body: str = "body") -> DataFrame:
    """Events of known sections with an airport; the record's own XML stays attached."""
    rows = landed.select("poll_id", "ingested_at", notice_tree(body).alias("__n")).select(
        "poll_id", "ingested_at", F.explode("__n.records").alias("__r"))
    r = F.col("__r")
    text = {n: r[f"f_{i}"] for i, n in enumerate(_FIELDS)}
    events = rows.select(
        "poll_id", "ingested_at",
        norm_faa(first_text(*[text[n] for n in AIRPORT])).alias("airport"), event_type(r["section"]).alias("event_type"),
        first_text(text["Reason"]).alias("reason"),
        first_text(*[text[n] for n in START]).alias("start_text"),
        first_text(*[text[n] for n in END]).alias("end_text"),
        first_text(*[text[n] for n in AVERAGE]).alias("avg_delay_text"),
        r["raw_xml"].alias("raw_xml"),
    )
    kept = events.filter(F.col("airport").isNotNull() & F.col("event_type").isNotNull())
    return kept.withColumn("payload_hash", payload_hash(IDENTITY))


def unreadable_faa(landed: DataFrame, body: str = "body") -> DataFrame:
    """Documents that are broken or carry a document type; they fail the batch gate."""
    return landed.withColumn("__n", notice_tree(body)["named"]).filter(F.col("__n").isNull()).drop("__n")


def unseen_records(landed: DataFrame, parsed: DataFrame, body: str = "body") -> DataFrame:
    """Polls whose documents name more airports than were parsed: a new section, spelling or wrapper appeared."""
    read = landed.select("poll_id", notice_tree(body)["named"].alias("__n"))
    named = read.groupBy("poll_id").agg(F.sum("__n").cast("int").alias("named"))
    got = parsed.groupBy("poll_id").agg(F.count("*").alias("parsed"))
    return (
        named.join(got, "poll_id", "left").na.fill(0, ["parsed"])
        .filter(F.col("named") > F.col("parsed"))
    )


def silver_faa(events: DataFrame, anchor: str = "ingested_at") -> DataFrame:
    """Typed start and end; the notice group beats the year-less texts."""
    start, end = program_times(F.col("start_text"), F.col("end_text"), F.col("reason"), F.col(anchor))
    return events.withColumn("start_ts", start).withColumn("end_ts", end)
