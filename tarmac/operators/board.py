"""Traveller board and operations feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.board import board_match, status_group, time_window

FIND_LIMIT = 12
RECENT_LIMIT = 9


def visible(
    board: DataFrame, now: Column, *, status: str = "active", window: str = "all",
    airlines: tuple[str, ...] = (), query: str = "", tz: str = "UTC",
) -> DataFrame:
    keep = status_group(F.col("status"), status) & time_window(F.col("scheduled"), window, now, tz)
    if airlines:
        keep = keep & F.col("airline_code").isin(*airlines)
    return board.filter(
        keep & board_match(query, F.col("flight_number"), F.col("city"), F.col("city_code"))
    )


def facets(board: DataFrame) -> DataFrame:
    return board.select("airline_code", "airline_name").distinct().orderBy("airline_name", "airline_code")


def find_flight(board: DataFrame, query: str, n: int = FIND_LIMIT) -> DataFrame:
    """First ``n`` flights whose number contains the query; nothing below two characters."""
    q = "".join(query.split()).upper()
    if len(q) < 2:
        return board.limit(0)
    number = F.upper(F.regexp_replace("flight_number", r"\s", ""))
    return board.filter(F.contains(number, F.lit(q))).orderBy("scheduled", "flight_number", "airport").limit(n)


def recent(events: DataFrame, n: int = RECENT_LIMIT) -> DataFrame:
    return events.orderBy(F.col("ts").desc(), "kind", "airport", "detail").limit(n)


def event_feed(
    go_arounds: DataFrame, holds: DataFrame, programs: DataFrame, predictions: DataFrame,
    cascade_p: float = 0.8,
) -> DataFrame:
    """(ts, kind, airport, detail). A cascade is a prediction at or above ``cascade_p``."""

    def rows(df: DataFrame, kind: str, ts: str, detail: Column) -> DataFrame:
        return df.select(
            F.col(ts).alias("ts"), F.lit(kind).alias("kind"), "airport", detail.alias("detail")
        )

    return (
        rows(go_arounds, "go-around", "ts", F.col("icao24"))
        .unionByName(rows(holds, "hold", "start_ts", F.col("icao24")))
        .unionByName(rows(programs, "program", "start_ts", F.col("event_type")))
        .unionByName(
            rows(
                predictions.filter(F.col("p_delay") >= cascade_p), "cascade", "ts",
                F.col("model_version"),
            )
        )
    )
