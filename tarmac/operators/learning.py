"""Training, scoring and leakage checks with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.joins import latest_by
from tarmac.operators.ordered import running_sum
from tarmac.session import scratch_dir, settle


def split(
    df: DataFrame, val_from: Column, test_from: Column, ts: str = "window_start", embargo_s: int = 3600
) -> DataFrame:
    """Adds ``part``: train, val or test by time, never at random.

    Rows within one horizon before a cut see outcomes from beyond it and are marked
    ``embargo``.
    """
    sec = F.unix_seconds(ts)
    val, test = F.unix_seconds(val_from), F.unix_seconds(test_from)
    part = (
        F.when(sec >= test, "test")
        .when(sec >= test - embargo_s, "embargo")
        .when(sec >= val, "val")
        .when(sec >= val - embargo_s, "embargo")
        .otherwise("train")
    )
    return df.withColumn("part", part)


def train(df: DataFrame, features: Sequence[str], kind: str = "logistic", y: str = "target", seed: int = 7) -> PipelineModel:
    """The fitted pipeline, without its training summary.

    Every stage reads the rows again, so they are written once, with the columns that count.
    A summary holds the session, and is sent to the tasks with its model; a session in which
    anything was observed can't be (seen with Spark 4.1). A stored model has none.
    """
    names = list(features)
    filled = [f"{c}__f" for c in names]
    numeric = settle(df.filter(F.col(y).isNotNull()).select(
        F.col(y).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in names]
    ), "training")
    stages = [
        Imputer(inputCols=names, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
    ]
    if kind == "logistic":
        stages.append(LogisticRegression(maxIter=50, regParam=1e-4))
    elif kind == "trees":
        stages.append(GBTClassifier(maxIter=20, maxDepth=4, seed=seed))
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    model = Pipeline(stages=stages).fit(numeric)
    if not getattr(model.stages[-1], "hasSummary", False):
        return model
    path = scratch_dir(df.sparkSession, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def apply_model(model: PipelineModel, df: DataFrame, features: Sequence[str], version: str) -> DataFrame:
    numeric = df.withColumns({c: F.col(c).cast("double") for c in features})
    return (
        model.transform(numeric)
        .withColumn("p_delay", vector_to_array("probability")[1])
        .withColumn("model_version", F.lit(version))
    )


def score(
    model: PipelineModel, gold: DataFrame, features: Sequence[str], version: str
) -> DataFrame:
    """predictions(airport, ts, p_delay, model_version) for the latest row per airport."""
    newest = latest_by(gold, ["airport"], ["window_start"])
    return apply_model(model, newest, features, version).select(
        "airport", F.col("window_start").alias("ts"), "p_delay", "model_version"
    )


def weights(model: PipelineModel) -> list[float]:
    """Linear coefficients, or the global importances of a tree model."""
    last = model.stages[-1]
    vector = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    return [float(x) for x in vector.toArray()]


def top_features(scored: DataFrame, features: Sequence[str], w: Sequence[float], k: int = 3, keys: Sequence[str] = ("airport", "ts")) -> DataFrame:
    """The k largest contributions (weight x standardised value) per prediction.

    ``scored`` carries the assembled ``features`` vector. Ranking happens inside the
    row, so nothing is shuffled.
    """
    vec = vector_to_array("features")
    parts = F.array(
        *[
            F.struct(
                (-F.abs(vec[i] * float(w[i]))).alias("neg"), F.lit(name).alias("feature"),
                (vec[i] * float(w[i])).alias("contribution"),
            )
            for i, name in enumerate(features)
        ]
    )
    ranked = F.slice(F.array_sort(parts), 1, k)
    return scored.select(*keys, F.posexplode(ranked).alias("rank", "c")).select(
        *keys, (F.col("rank") + 1).alias("rank"), "c.feature", "c.contribution"
    )


def shuffled_labels(df: DataFrame, y: str = "target", seed: int = 11) -> DataFrame:
    """The same labels in another order: a control on which no model may pass the gate.

    Every row is ranked among all rows by one hash, every label by another, and equal ranks
    meet, so a row keeps its label as often as chance has it, at any number of rows. Ranks are
    running counts over ranges of the hash, so no task orders all rows. This control shows
    that the measure is fair; a leak is found by ``leaked_features``.
    """
    cols = [c for c in df.columns if c != y]
    base = df.withColumn("__row", F.xxhash64(*[F.col(c).cast("string") for c in cols], F.lit(seed)))

    def ranked(rows: DataFrame) -> DataFrame:
        return running_sum(rows, [], ["__h"], {"__k": F.lit(1)}, bucket=F.shiftright("__h", 52))

    left = ranked(base.withColumn("__h", F.col("__row")))
    right = ranked(base.select(F.xxhash64("__row", F.lit(seed + 1)).alias("__h"), F.col(y).alias("__y"))).select("__k", "__y")
    return left.join(right, "__k").select(*cols, F.col("__y").alias(y))


def late_features(df: DataFrame, feature_times: Sequence[str], window: str = "window_start", window_s: int = 900) -> DataFrame:
    """Rows in which some input is newer than the end of its window; must be empty."""
    end = F.unix_micros(window) + window_s * 1_000_000
    late = F.lit(False)
    for c in feature_times:
        late = late | F.coalesce(F.unix_micros(c) > end, F.lit(False))
    return df.filter(late)


def leaked_features(df: DataFrame, features: Sequence[str], y: str = "target", limit: float = 0.95) -> DataFrame:
    """(feature, correlation) of features that all but give the label away; one pass over the rows."""
    rows = df.filter(F.col(y).isNotNull())
    one = rows.agg(*[F.corr(F.col(f).cast("double"), F.col(y).cast("double")).alias(f) for f in features])
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("correlation")) for f in features])
    return one.select(F.explode(parts).alias("c")).select("c.*").filter(F.abs("correlation") >= limit)
