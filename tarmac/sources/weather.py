"""Aviation weather reports and forecasts: JSON lists to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import weather as wx
from tarmac.functions.identity import payload_hash
from tarmac.functions.text import empty_if_null
from tarmac.functions.timing import epoch_utc

_CLOUD = "array<struct<cover:string,base:int>>"
_CLOUD_OUT = "array<struct<cover:string,base_ft:int>>"

METAR_JSON = (
    "array<struct<icaoId:string,obsTime:string,rawOb:string,temp:string,dewp:string,"
    "wdir:string,wspd:string,wgst:string,visib:string,altim:string,wxString:string,"
    f"fltCat:string,clouds:{_CLOUD}>>"
)
TAF_JSON = (
    "array<struct<icaoId:string,validTimeFrom:string,validTimeTo:string,rawTAF:string,"
    "fcsts:array<struct<timeFrom:string,timeTo:string,fcstChange:string,wdir:string,"
    f"wspd:string,wgst:string,visib:string,wxString:string,clouds:{_CLOUD}>>>>"
)

METAR_IDENTITY = [
    "station", "obs_time", "raw_text", "temp_c", "dewpoint_c", "wind_dir_deg", "wind_variable",
    "wind_speed_kt", "wind_gust_kt", "visibility_sm", "altimeter_hpa", "wx_string",
    "flight_category", "clouds",
]
TAF_IDENTITY = ["station", "valid_from", "valid_to", "raw_text", "periods"]


def _clouds(c: Column) -> Column:
    renamed = F.transform(
        c, lambda x: F.struct(x["cover"].alias("cover"), x["base"].alias("base_ft"))
    )
    return empty_if_null(renamed, _CLOUD_OUT)


def _unread(raw: Column, typed: Column) -> Column:
    return raw.isNotNull() & typed.isNull()


def parse_metar(landed: DataFrame, body: str = "body") -> DataFrame:
    """One row per observation; a bare object counts as a list of one.

    Unknown keys are ignored and absent ones are null. ``misread`` marks rows with a
    number or direction that could not be read; unreadable visibility does not.
    """
    m = F.col("__m")
    rows = landed.withColumn("__m", F.explode(F.from_json(body, METAR_JSON)))
    numbers = {"temp": "temp_c", "dewp": "dewpoint_c", "wspd": "wind_speed_kt", "wgst": "wind_gust_kt", "altim": "altimeter_hpa"}
    misread = ~wx.wind_dir_readable(m["wdir"]) | _unread(m["obsTime"], epoch_utc(m["obsTime"]))
    for raw in numbers:
        misread = misread | _unread(m[raw], m[raw].try_cast("double"))
    direction = wx.wind_dir(m["wdir"])
    typed = rows.select(
        "poll_id", "ingested_at",
        m["icaoId"].alias("station"), epoch_utc(m["obsTime"]).alias("obs_time"),
        m["rawOb"].alias("raw_text"),
        *[m[raw].try_cast("double").alias(name) for raw, name in numbers.items()],
        direction.alias("wind_dir_deg"),
        wx.wind_variable(direction, m["rawOb"]).alias("wind_variable"),
        wx.visibility_sm(m["visib"]).alias("visibility_sm"),
        m["wxString"].alias("wx_string"), m["fltCat"].alias("flight_category"),
        _clouds(m["clouds"]).alias("clouds"), misread.alias("misread"),
    )
    return typed.withColumn("payload_hash", payload_hash(METAR_IDENTITY))


def silver_metar(metar: DataFrame) -> DataFrame:
    """Typed layer of observations: the ceiling is derived here, never stored earlier."""
    return metar.withColumn("ceiling_ft", wx.ceiling_ft(F.col("clouds")))


def parse_taf(landed: DataFrame, body: str = "body") -> DataFrame:
    """One row per forecast with its periods nested."""
    f = F.col("__t")

    def period(p: Column) -> Column:
        return F.struct(
            epoch_utc(p["timeFrom"]).alias("time_from"), epoch_utc(p["timeTo"]).alias("time_to"),
            p["fcstChange"].alias("change_indicator"), wx.wind_dir(p["wdir"]).alias("wind_dir_deg"),
            p["wspd"].try_cast("double").alias("wind_speed_kt"),
            p["wgst"].try_cast("double").alias("wind_gust_kt"),
            wx.visibility_sm(p["visib"]).alias("visibility_sm"), p["wxString"].alias("wx_string"),
            _clouds(p["clouds"]).alias("clouds"),
        )

    none = (
        "array<struct<time_from:timestamp,time_to:timestamp,change_indicator:string,"
        "wind_dir_deg:int,wind_speed_kt:double,wind_gust_kt:double,visibility_sm:double,"
        f"wx_string:string,clouds:{_CLOUD_OUT}>>"
    )
    typed = landed.withColumn("__t", F.explode(F.from_json(body, TAF_JSON))).select(
        "poll_id", "ingested_at",
        f["icaoId"].alias("station"), epoch_utc(f["validTimeFrom"]).alias("valid_from"),
        epoch_utc(f["validTimeTo"]).alias("valid_to"), f["rawTAF"].alias("raw_text"),
        empty_if_null(F.transform(f["fcsts"], period), none).alias("periods"),
    )
    return typed.withColumn("payload_hash", payload_hash(TAF_IDENTITY))


def explode_taf(taf: DataFrame) -> DataFrame:
    """One row per forecast period; a forecast without periods keeps one empty row."""
    keep = [c for c in taf.columns if c != "periods"]
    flat = taf.select(*keep, F.inline_outer("periods"))
    return flat.withColumn("ceiling_ft", wx.ceiling_ft(F.col("clouds"))).withColumn(
        "severity", wx.severity(F.col("visibility_sm"), F.col("ceiling_ft"))
    )


def unreadable_list(landed: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Bodies that are not JSON, or not a list of the expected objects."""
    return landed.filter(F.from_json(body, schema).isNull())
