"""Daily sketches that are kept and united: distributions, distinct keys, and even value ranges.

A day's rows are read once and leave one small row for each feature or subject; any longer period, and any
comparison of periods, is answered from those rows. Distributions are KLL sketches: a rank from
one of size k is off by at most about ``rank_error(k)`` of all rows (with 99 % confidence), and by nothing
while it has seen no more than k values. Distinct keys are theta sketches: exact up to 2**lg keys, and
within about 2 / sqrt(2**lg) of the number beyond (95 %).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes for stored sketches: ranks within about 0.05 %, distinct counts within about 1.6 %.
KLL_SIZE, THETA_LG = 4096, 14


def rank_error(k: int) -> float:
    """Normalised rank error of a KLL sketch of size k, after the sketch library's published fit."""
    return 2.296 / k**0.9723


def _number(name: str) -> Column:
    """The column as a double; not-a-number counts as missing."""
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def feature_sketches(df: DataFrame, ts: str, features: Sequence[str], k: int = KLL_SIZE, keys: Sequence[str] = ()) -> DataFrame:
    """(*keys, day, feature, n_rows, n_known, sketch): one pass over the rows, partial sketches before the shuffle."""
    each = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.count("*").alias("n_rows"), F.count(_number(f)).alias("n_known"), F.kll_sketch_agg_double(_number(f), F.lit(k)).alias("sketch"))
        for f in features
    ])
    daily = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(each.alias("each"))
    return daily.select(*keys, "day", F.inline("each"))


def united_features(sketches: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """(*keys, n_rows, n_known, sketch) over all days given; the sketch is null where no value is known."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_known").alias("n_known"),
        F.kll_merge_agg_double(F.when(F.col("n_known") > 0, F.col("sketch"))).alias("sketch"),
    ).withColumn("sketch", F.when(F.col("n_known") > 0, F.col("sketch")))


def _quantiles(sketch: str, n: int) -> Column:
    """The n-quantiles of a sketch, the largest value last."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / n) for i in range(1, n + 1)]))


def _share_up_to(quantiles: str, value: Column) -> Column:
    """The share of values up to this one, to one part in as many as there are quantiles."""
    return F.size(F.filter(quantiles, lambda q: q <= value)) / F.size(quantiles)


def sketch_drift(
    reference: DataFrame, live: DataFrame, bins: int = 10, grid: int = 1000, floor: float = 1e-4, keys: Sequence[str] = ("feature",)
) -> DataFrame:
    """PSI, KS distance and change of null rate per feature, from stored sketches of both periods.

    Bins are the reference quantiles. The sketches are read at ``grid`` quantiles, a multiple of ten times
    the bins, so a share is off by 1 / ``grid`` and the rank error at most. The KS distance is
    taken at the hundredths of either side: up to a hundredth below that over all values.
    """
    if grid % bins or grid % 100:
        raise ValueError("the grid must be a multiple of the bins and of a hundred")
    names = ["n_rows", "n_known", "sketch"]
    ref = united_features(reference, keys).withColumnsRenamed({c: f"r_{c}" for c in names})
    now = united_features(live, keys).withColumnsRenamed({c: f"l_{c}" for c in names})
    both = ref.join(now, list(keys), "outer")
    known = F.col("r_sketch").isNotNull() & F.col("l_sketch").isNotNull()
    both = both.withColumns({q: F.when(known, _quantiles(f"{q[0]}_sketch", grid)) for q in ("r_q", "l_q")})

    def every(q: str, step: int) -> Column:
        return F.filter(q, lambda _, i: (i + 1) % step == 0)

    def shares(q: str) -> Column:
        """Of the values in each bin: differences of the shares up to the cuts."""
        upto = F.transform(F.slice(every("r_q", grid // bins), 1, bins - 1), lambda cut: _share_up_to(q, cut))
        return F.zip_with(F.concat(upto, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), upto), lambda a, b: F.greatest(a - b, F.lit(floor)))

    points = F.concat(every("r_q", grid // 100), every("l_q", grid // 100))
    gaps = F.transform(points, lambda v: F.abs(_share_up_to("r_q", v) - _share_up_to("l_q", v)))
    terms = F.zip_with(shares("r_q"), shares("l_q"), lambda a, b: (b - a) * F.ln(b / a))
    nulls = lambda side: 1 - F.try_divide(f"{side}_n_known", f"{side}_n_rows")
    return both.select(
        *keys, F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("psi"), F.array_max(gaps).alias("ks"),
        (nulls("l") - nulls("r")).alias("null_shift"),
    )


def subject_sketches(df: DataFrame, ts: str, subjects: Sequence[str], lg: int = THETA_LG) -> DataFrame:
    """(day, n_rows, one theta sketch for each subject): distinct values of a day, ready to be united."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n_rows"), *[F.theta_sketch_agg(F.col(s).cast("string"), F.lit(lg)).alias(s) for s in subjects])


def profile_over(daily: DataFrame, period: Column, subjects: Sequence[str], lg: int = THETA_LG) -> DataFrame:
    """(period, days, n_rows, n_<subject>) for any grouping of days, without their rows."""
    return daily.groupBy(period.alias("period")).agg(
        F.count("*").alias("days"), F.sum("n_rows").alias("n_rows"),
        *[F.theta_sketch_estimate(F.theta_union_agg(s, F.lit(lg))).alias(f"n_{s}") for s in subjects])


def seen_in_both(daily: DataFrame, first: Column, second: Column, subject: str, lg: int = THETA_LG) -> DataFrame:
    """(n_first, n_second, n_both): distinct subjects of two sets of days and of both."""
    one, two = (F.theta_union_agg(F.when(c, F.col(subject)), F.lit(lg)) for c in (first, second))
    return daily.agg(one.alias("a"), two.alias("b")).select(
        F.theta_sketch_estimate("a").alias("n_first"), F.theta_sketch_estimate("b").alias("n_second"),
        F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("n_both"))


def with_even_range(df: DataFrame, column: str, name: str, keys: Sequence[str] = (), ranges: int = 256, k: int = 1024) -> DataFrame:
    """Adds the number, from 0, of the range that a value lies in: a key's ranges hold about equally many rows.

    Splitters are quantiles of one sketch for each key, of which there must be few (models, not
    aircraft), since every task gets them all. Equal values share a range; missing ones are in range 0.
    """
    sketch = df.groupBy(*keys).agg(F.count(_number(column)).alias("n"), F.kll_sketch_agg_double(_number(column), F.lit(k)).alias("s"))
    cuts = F.when(F.col("n") > 0, F.slice(_quantiles("s", ranges), 1, ranges - 1)).otherwise(F.array().cast("array<double>"))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    # One small row for each key; without keys it is one row.
    splitters = sketch.select(*[F.col(c).alias(f"__of_{c}") for c in keys], cuts.alias("__cuts"))
    placed = df.join(F.broadcast(splitters), same)
    # Binary search: the largest number of splitters that lie below the value.
    steps = F.array(*[F.lit(1 << b) for b in range((ranges - 1).bit_length() - 1, -1, -1)])
    below = lambda at, step: F.coalesce(F.try_element_at("__cuts", at + step) < F.col(column), F.lit(False))
    number = F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))
    return placed.withColumn(name, number.cast("bigint")).select(*df.columns, name)
