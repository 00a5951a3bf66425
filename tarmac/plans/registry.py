"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from tarmac.plans.views import Tables, duck_sql
from tarmac.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and rounded doubles, so that two engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, DoubleType):
            c = F.round(c, DIGITS) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def duck(views: Sequence[str], body: str, doubles: Sequence[str] = ()) -> str:
    """The checking SQL: the views as CTEs, then the body with its doubles rounded."""
    ctes = ",\n".join(f"{v} AS ({duck_sql(v)})" for v in views)
    head = f"WITH {ctes}\n" if ctes else ""
    if doubles:
        parts = ", ".join(f"(round({d}, {DIGITS}) + 0e0) AS {d}" for d in doubles)
        return f"{head}SELECT * REPLACE ({parts}) FROM ({body}) final_rows"
    return f"{head}SELECT * FROM ({body}) final_rows"


def query(
    name: str, views: Sequence[str] = (), sql: str | None = None, doubles: Sequence[str] = ()
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``fn(tables)`` under a name, with the body of its checking SQL."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return comparable(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = duck(views, sql, doubles)
        return fn

    return register
