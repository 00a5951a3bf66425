from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tarmac.operators import learning


def test_scores_after_observation(spark):
    rows = spark.range(200).select((F.col("id") % 10).alias("a"), (F.col("id") % 10 > 4).cast("int").alias("target"), F.lit("KJFK").alias("airport"), F.timestamp_seconds("id").alias("window_start"))
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("n")).count()
    model = learning.train(rows, ["a"])
    held = learning.apply_model(model, rows, ["a"], "v").select("a", "p_delay").distinct().collect()
    assert counted.get["n"] == 200 and all((r["p_delay"] > 0.5) == (r["a"] > 4) for r in held)
    (one,) = learning.score(model, rows, ["a"], "v").collect()
    assert one["p_delay"] > 0.5 and len(learning.weights(model)) == 1
