"""The airport dimension."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.quality import check_airports
from tarmac.schemas import SCHEMAS

# Published reference points, elevations and zones. Fixed values.
AIRPORTS = (
    ("KJFK", "John F. Kennedy International", 40.6398, -73.7789, "KJFK", "JFK", 13.0, "America/New_York"),
    ("KEWR", "Newark Liberty International", 40.6925, -74.1687, "KEWR", "EWR", 18.0, "America/New_York"),
    ("KORD", "Chicago O'Hare International", 41.9786, -87.9048, "KORD", "ORD", 672.0, "America/Chicago"),
)


def inline(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Literal rows as part of the plan itself (an Arrow local relation)."""
    schema = SCHEMAS["airports"]
    columns = list(zip(*rows, strict=True))
    table = pa.table(
        {
            f.name: pa.array(list(c), pa.float64() if f.dataType.simpleString() == "double" else pa.string())
            for f, c in zip(schema.fields, columns, strict=True)
        }
    )
    return spark.createDataFrame(table)


def airports_df(spark: SparkSession, rows=AIRPORTS) -> DataFrame:
    """The dimension, checked: an empty or faulty one stops the job."""
    if not rows:
        raise ValueError("no airports given")
    df = inline(spark, rows)
    if rows is not AIRPORTS:
        require_valid(df)
    return df


def require_valid(df: DataFrame) -> DataFrame:
    """Fail when any constraint is violated or the dimension is empty."""
    if df.isEmpty():
        raise ValueError("the airport dimension is empty")
    problems = check_airports(df).orderBy("icao", "problem").limit(20).collect()
    if problems:
        raise ValueError("bad airports: " + ", ".join(f"{r['icao']}:{r['problem']}" for r in problems))
    return df
