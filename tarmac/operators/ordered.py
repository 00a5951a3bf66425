"""Ordered computations per key that never put one whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a hot key to a single task.
Here the timeline of each key is cut into buckets. Rows are shuffled by (key,
bucket); what a bucket must know about earlier ones is either

* a *halo*: rows of the last ``lookback`` seconds copied into the next bucket, used
  where the rule itself looks back a bounded time, or
* a *carry*: one summary row per (key, bucket), scanned in bucket order and joined
  back on the same (key, bucket) partitioning, used where it does not.

The summary of a bucket is read off its last row once the bucket is windowed, so rows and
summaries start from the same shuffle and the input is evaluated once.

Both give the same answer as the unbucketed window. Rows without a key or a bucket are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

BUCKET = "__bucket"
HOME = "__home"


def time_bucket(ts: str | Column, seconds: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(c) / F.lit(seconds)).cast("bigint")


def bucket_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def with_halo(
    df: DataFrame, ts: str, *, width_s: int, lookback_s: int = 0, lookahead_s: int = 0
) -> DataFrame:
    """Copy each row into every bucket whose rows may need to see it."""
    sec = F.unix_micros(F.col(ts)) / F.lit(1_000_000)
    home = F.floor(sec / F.lit(width_s)).cast("bigint")
    first = F.floor((sec - F.lit(lookahead_s)) / F.lit(width_s)).cast("bigint")
    last = F.floor((sec + F.lit(lookback_s)) / F.lit(width_s)).cast("bigint")
    return df.withColumn(HOME, home).withColumn(BUCKET, F.explode(F.sequence(first, last)))


def owned(df: DataFrame) -> DataFrame:
    """Drop the halo copies once the windows have been computed."""
    return df.filter(F.col(BUCKET) == F.col(HOME)).drop(BUCKET, HOME)


def _carry_window(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(BUCKET)


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column) -> tuple[DataFrame, WindowSpec]:
    """Rows dealt out by (key, bucket), and the window over a bucket.

    Rows that agree in the order columns are told apart by a hash of the whole row. It is taken
    after the shuffle, which so carries all columns for rows and summaries alike: the
    planner sees one shuffle and runs it, and what lies below, once.
    """
    whole = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    known = F.col(BUCKET).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    # Rows without a key or a place in time would be lost in the join; said here, both sides say the same.
    base = df.withColumn(BUCKET, bucket).filter(known).repartition(*keys, BUCKET).withColumn("__tie", F.xxhash64(*whole))
    return base, bucket_window(keys, [*order, "__tie"])


def _ends(rows: DataFrame, w: WindowSpec, *columns: str | Column) -> DataFrame:
    """The last row of every bucket."""
    return rows.withColumn("__more", F.lead(F.lit(1)).over(w)).filter(F.col("__more").isNull()).select(*columns)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    *, bucket: Column, name: str = "prev",
) -> DataFrame:
    """Struct ``name`` with the values of the preceding row of the same key."""
    base, w = _dealt(df, keys, order, bucket)
    row = F.struct(*values)
    here = base.withColumn("__lag", F.lag(row).over(w))
    carry = _ends(base, w, *keys, BUCKET, row.alias("__last")).select(
        *keys, BUCKET, F.lag("__last").over(_carry_window(keys)).alias("__carry"))
    return (
        here.join(carry, [*keys, BUCKET])
        .withColumn(name, F.coalesce("__lag", "__carry"))
        .select(*df.columns, name)
    )


def running_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], exprs: dict[str, Column],
    *, bucket: Column, inclusive: bool = True,
) -> DataFrame:
    """Last non-null value of each expression up to (or strictly before) the row."""
    base, w = _dealt(df, keys, order, bucket)
    frame = so_far(w) if inclusive else before(w)
    here = base.withColumns(
        {f"__h_{n}": F.last(e, ignorenulls=True).over(frame) for n, e in exprs.items()}
    )
    wb = before(_carry_window(keys))
    whole = base.withColumns({f"__e_{n}": F.last(e, ignorenulls=True).over(so_far(w)) for n, e in exprs.items()})
    carry = _ends(whole, w, *keys, BUCKET, *[f"__e_{n}" for n in exprs]).select(
        *keys, BUCKET,
        *[F.last(f"__e_{n}", ignorenulls=True).over(wb).alias(f"__c_{n}") for n in exprs],
    )
    return (
        here.join(carry, [*keys, BUCKET])
        .withColumns({n: F.coalesce(f"__h_{n}", f"__c_{n}") for n in exprs})
        .select(*[c for c in df.columns if c not in exprs], *exprs)
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], exprs: dict[str, Column],
    *, bucket: Column,
) -> DataFrame:
    """Inclusive running sum of each expression over the rows of a key.

    ``keys`` may be empty: the carry then has one row per bucket of the whole input.
    """
    base, w = _dealt(df, keys, order, bucket)
    here = base.withColumns({f"__h_{n}": F.sum(e).over(so_far(w)) for n, e in exprs.items()})
    wb = before(_carry_window(keys))
    # At the last row the running sum is the bucket's.
    carry = _ends(here, w, *keys, BUCKET, *[f"__h_{n}" for n in exprs]).select(
        *keys, BUCKET, *[F.sum(f"__h_{n}").over(wb).alias(f"__c_{n}") for n in exprs])
    return (
        here.join(carry, [*keys, BUCKET])
        .withColumns(
            {
                n: F.coalesce(F.col(f"__h_{n}"), F.lit(0)) + F.coalesce(F.col(f"__c_{n}"), F.lit(0))
                for n in exprs
            }
        )
        .select(*[c for c in df.columns if c not in exprs], *exprs)
    )


def islands(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    is_break: Callable[[Column, Column], Column],
    *, bucket: Column, carry: Sequence[str] = (), name: str = "island_start",
) -> DataFrame:
    """Label each row with the order struct of the first row of its island.

    A new island starts where ``is_break(previous row, row)`` holds; both arguments
    are structs of the order and carry columns.
    """
    base, w = _dealt(df, keys, order, bucket)
    at = F.struct(*order)
    here = base.withColumn("__row", F.struct(*order, *carry))
    here = here.withColumn("__prev", F.lag("__row").over(w))
    here = here.withColumn(
        "__break",
        F.when(F.col("__prev").isNotNull() & is_break(F.col("__prev"), F.col("__row")), at),
    )
    rows = here.withColumn("__local", F.last("__break", ignorenulls=True).over(so_far(w)))

    # At the last row of a bucket: its first row, itself, and the last break inside.
    summary = _ends(
        rows.withColumn("__first", F.first("__row").over(so_far(w))), w,
        *keys, BUCKET, "__first", F.col("__row").alias("__final"), F.col("__local").alias("__inner"),
    )
    wb = _carry_window(keys)
    before_bucket = F.col("__prior")
    first = F.col("__first")
    first_at = F.struct(*[first[c].alias(c) for c in order])
    starts = (
        summary.withColumn("__prior", F.lag("__final").over(wb))
        .withColumn(
            "__own",
            F.when(before_bucket.isNull() | is_break(before_bucket, first), first_at),
        )
        .withColumn("__end", F.coalesce("__inner", "__own"))
        .withColumn("__open", F.last("__end", ignorenulls=True).over(before(wb)))
        .select(*keys, BUCKET, F.coalesce("__own", "__open").alias("__begin"))
    )
    return (
        rows.join(starts, [*keys, BUCKET])
        .withColumn(name, F.coalesce("__local", "__begin"))
        .select(*[c for c in df.columns if c != name], name)
    )


def gap_breaks(ts: str, gap_s: float) -> Callable[[Column, Column], Column]:
    """Break where the time since the previous row is strictly more than the gap."""
    limit = int(gap_s * 1_000_000)
    return lambda prev, cur: (F.unix_micros(cur[ts]) - F.unix_micros(prev[ts])) > limit
