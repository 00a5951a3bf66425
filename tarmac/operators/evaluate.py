"""Model quality, gates and drift as distributed aggregations.

Scores are first reduced to one row per distinct value, then cumulated over ranges of
scores; no step orders all predictions in one task. ``drift`` is exact and shuffles distinct
values; ``sketches.sketch_drift`` compares periods from stored daily sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.config import DEFAULT, Thresholds
from tarmac.operators.ordered import islands, running_sum, time_bucket, with_previous
from tarmac.operators.sketches import with_even_range
from tarmac.session import settle

def curve(scored: DataFrame, keys: Sequence[str] = ("model_version",), p: str = "p_delay", y: str = "target", ranges: int = 256) -> DataFrame:
    """Cumulative hits and precision at every distinct score, ties taken together.

    Scores are cumulated over ``ranges`` of about equally many distinct ones, wherever they crowd.
    """
    known = scored.filter(F.col(p).isNotNull() & F.col(y).isNotNull())
    per = (
        known.groupBy(*keys, F.col(p).alias("p"))
        .agg(F.count("*").alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos"))
        .withColumn("rank", -F.col("p"))
    )
    # High scores come first, so the ranges are numbered downwards.
    cum = running_sum(
        with_even_range(per, "p", "__range", keys, ranges), list(keys), ["rank"], {"seen": F.col("n"), "tp": F.col("pos")}, bucket=-F.col("__range")
    ).drop("__range")
    return cum.withColumn("precision", F.col("tp") / F.col("seen"))


def evaluate(
    scored: DataFrame, keys: Sequence[str] = ("model_version",), p: str = "p_delay",
    y: str = "target", precision_floor: float = DEFAULT.precision_floor,
) -> DataFrame:
    """Average precision, recall at the precision floor and Brier score per model."""
    c = curve(scored, keys, p, y)
    ranked = c.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.sum("pos")).alias("pr_auc"),
        F.try_divide(
            F.coalesce(F.max(F.when(F.col("precision") >= precision_floor, F.col("tp"))), F.lit(0)),
            F.sum("pos"),
        ).alias("recall_at_precision"),
        F.sum("n").alias("n_scored"),
        F.sum("pos").alias("n_positive"),
        (
            F.sum(
                F.col("pos") * (1 - F.col("p")) * (1 - F.col("p"))
                + (F.col("n") - F.col("pos")) * F.col("p") * F.col("p")
            )
            / F.sum("n")
        ).alias("brier"),
    )
    return ranked


def calibration(
    scored: DataFrame, bins: int = 10, keys: Sequence[str] = ("model_version",),
    p: str = "p_delay", y: str = "target",
) -> DataFrame:
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return (
        scored.filter(F.col(p).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys, b.alias("bin"))
        .agg(
            F.count("*").alias("n"), F.avg(p).alias("mean_predicted"),
            F.avg(F.col(y).cast("double")).alias("observed_rate"),
        )
    )


def lead_time(
    scored: DataFrame, threshold: float, p: str = "p_delay", y: str = "target", ts: str = "ts",
    keys: Sequence[str] = ("model_version", "airport"), bucket_s: int = 3600,
) -> DataFrame:
    """Per delay onset: minutes the alarm had already stood (null when it had not)."""
    known = scored.filter(F.col(p).isNotNull() & F.col(y).isNotNull())
    known = known.withColumn("alarm", F.col(p) >= threshold)
    bucket = time_bucket(ts, bucket_s)
    runs = islands(
        known, list(keys), [ts], lambda a, b: a["alarm"] != b["alarm"],
        bucket=bucket, carry=["alarm"], name="__run",
    )
    seen = with_previous(runs, list(keys), [ts], [y], bucket=bucket)
    onset = (F.col(y) == 1) & F.coalesce(F.col("prev")[y] == 0, F.lit(True))
    stood = (F.unix_micros(ts) - F.unix_micros(F.col("__run")[ts])) / F.lit(60_000_000)
    return seen.filter(onset).select(
        *keys, F.col(ts).alias("onset_ts"), F.when(F.col("alarm"), stood).alias("lead_minutes")
    )


def on_common_rows(scored: DataFrame, rows: Sequence[str] = ("airport", "ts"), models: int = 2) -> DataFrame:
    """Rows that every one of the models has scored."""
    full = (
        scored.filter(F.col("p_delay").isNotNull()).groupBy(*rows)
        .agg(F.count_distinct("model_version").alias("m")).filter(F.col("m") == models).drop("m")
    )
    return scored.join(full, list(rows), "left_semi")


def gate(metrics: DataFrame, candidate: str, current: str, tolerance: float = DEFAULT.pr_auc_tolerance) -> DataFrame:
    """One decision row: the candidate passes unless PR-AUC falls by more than the tolerance."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col("model_version") == name, F.col("pr_auc")))

    return metrics.agg(of(candidate).alias("candidate_pr_auc"), of(current).alias("current_pr_auc")).select(
        F.lit(candidate).alias("candidate"), F.lit(current).alias("current"),
        "candidate_pr_auc", "current_pr_auc",
        F.coalesce(
            F.col("candidate_pr_auc") >= F.col("current_pr_auc") * (1 - tolerance),
            F.col("candidate_pr_auc").isNotNull(),
        ).alias("passed"),
    )


def majority_baseline(train: DataFrame, y: str = "target") -> DataFrame:
    """The commoner class (the smaller one on a tie) and its share."""
    per = train.filter(F.col(y).isNotNull()).groupBy(F.col(y).cast("int").alias("c")).count()
    return per.agg(
        F.max_by("c", F.struct("count", -F.col("c"))).alias("majority_class"),
        (F.max("count") / F.sum("count")).alias("share"),
    )


def value_bucket(c: Column, per_octave: int = 256) -> Column:
    """Monotone bucket of any double: even in ratio, so heavy tails spread too."""
    size = F.log2(F.abs(c) + F.lit(1.0)) * per_octave
    return F.floor(F.signum(c) * size).cast("bigint")


def long_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value) rows, nulls kept."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    )
    return df.select(F.explode(pairs).alias("f")).select("f.*")


def quantile_cuts(values: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Exact quantiles per feature: least value whose share of rows reaches each q."""
    known = values.filter(F.col("value").isNotNull())
    return _cuts_of(known.groupBy("feature", "value").agg(F.count("*").alias("n")), qs)


def _cuts_of(per: DataFrame, qs: Sequence[float]) -> DataFrame:
    cum = running_sum(per, ["feature"], ["value"], {"upto": F.col("n")}, bucket=value_bucket(F.col("value")))
    totals = per.groupBy("feature").agg(F.sum("n").alias("total"))
    # One row per feature name the caller listed.
    reach = cum.join(F.broadcast(totals), "feature")
    return reach.groupBy("feature").agg(
        F.array(*[F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("value"))) for q in qs]).alias("cuts")
    )


def drift(
    reference: DataFrame, live: DataFrame, features: Sequence[str], bins: int = 10, floor: float = 1e-4
) -> DataFrame:
    """PSI, KS distance and change of null rate per feature.

    Bins are the reference quantiles. The list of features is the bound on what is
    broadcast here.
    """
    ref, now = long_features(reference, features), long_features(live, features)
    both = ref.withColumn("live", F.lit(0)).unionByName(now.withColumn("live", F.lit(1)))
    # Both inputs are read once; everything below starts from the distinct values.
    values = settle(
        both.groupBy("feature", "value").agg(
            F.count_if(F.col("live") == 0).alias("r"), F.count_if(F.col("live") == 1).alias("l")
        ),
        "drift-values",
    )
    null = F.col("value").isNull()
    sizes = values.groupBy("feature").agg(
        F.sum("r").alias("ref_rows"), F.sum("l").alias("live_rows"),
        F.sum(F.when(null, F.col("r")).otherwise(0)).alias("ref_nulls"),
        F.sum(F.when(null, F.col("l")).otherwise(0)).alias("live_nulls"),
    )
    ref_n = F.col("ref_rows") - F.col("ref_nulls")
    live_n = F.col("live_rows") - F.col("live_nulls")
    per = values.filter(~null)
    seen = per.filter("r > 0").select("feature", "value", F.col("r").alias("n"))
    cuts = _cuts_of(seen, [i / bins for i in range(1, bins)])
    binned = (
        per.join(F.broadcast(cuts), "feature")
        .withColumn("bin", F.size(F.filter("cuts", lambda x: F.col("value") > x)))
        .groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("l").alias("l"))
        .join(F.broadcast(sizes), "feature")
    )
    a = F.greatest(F.try_divide("r", ref_n), F.lit(floor))
    b = F.greatest(F.try_divide("l", live_n), F.lit(floor))
    psi = binned.groupBy("feature").agg(F.sum((b - a) * F.ln(b / a)).alias("psi"))

    cum = running_sum(
        per, ["feature"], ["value"], {"cr": F.col("r"), "cl": F.col("l")}, bucket=value_bucket(F.col("value"))
    ).join(F.broadcast(sizes), "feature")
    ks = cum.groupBy("feature").agg(
        F.max(F.abs(F.try_divide("cr", ref_n) - F.try_divide("cl", live_n))).alias("ks")
    )
    return (
        sizes.join(psi, "feature", "left").join(ks, "feature", "left")
        .select(
            "feature", "psi", "ks",
            (F.try_divide("live_nulls", "live_rows") - F.try_divide("ref_nulls", "ref_rows")).alias("null_shift"),
        )
    )


def drift_alerts(report: DataFrame, psi: float = 0.2, ks: float = 0.2, null_shift: float = 0.1) -> DataFrame:
    return report.filter(
        (F.col("psi") > psi) | (F.col("ks") > ks) | (F.abs("null_shift") > null_shift)
    )


def realised(
    predictions: DataFrame, outcomes: DataFrame, floor_pr_auc: float = 0.0, t: Thresholds = DEFAULT
) -> DataFrame:
    """Metrics of past predictions once their outcomes are known."""
    from tarmac.operators.joins import backfill_truth

    known = backfill_truth(predictions, outcomes, t.window_s)
    return evaluate(known, precision_floor=t.precision_floor).withColumn(
        "below_floor", F.col("pr_auc") < floor_pr_auc
    )
