"""Queries over evaluation, gates, drift and learning (A15-A18, M1-M5, K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import evaluate, features, joins, learning, sketches
from tarmac.plans.aggregates import TARGETS, WINDOWS, gold_counts
from tarmac.plans.joining import airports, delays, intervals
from tarmac.plans.registry import query
from tarmac.plans.views import Tables
from tarmac.session import settle

# Cumulative counts over all scores in one ordered pass; ties are peers of a RANGE frame.
_CURVE = """(SELECT DISTINCT model_version, p_delay, sum(target) OVER w AS tp, count(*) OVER w AS seen, sum(target) OVER (PARTITION BY model_version, p_delay) AS pos
    FROM SRC WHERE target IS NOT NULL AND p_delay IS NOT NULL WINDOW w AS (PARTITION BY model_version ORDER BY p_delay DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def metrics_sql(src: str = "v_scored") -> str:
    c = _CURVE.replace("SRC", src)
    return f"""(SELECT c.model_version, sum(c.pos * c.tp / c.seen) / sum(c.pos) AS pr_auc,
        coalesce(max(c.tp) FILTER (WHERE c.tp / c.seen >= 8e-1), 0) / sum(c.pos) AS recall_at_precision,
        any_value(b.n) AS n_scored, any_value(b.pos) AS n_positive, any_value(b.brier) AS brier
      FROM {c} c JOIN (SELECT model_version, count(*) AS n, CAST(sum(target) AS BIGINT) AS pos, avg(pow(p_delay - target, 2)) AS brier
        FROM {src} WHERE target IS NOT NULL AND p_delay IS NOT NULL GROUP BY 1) b USING (model_version) GROUP BY c.model_version)"""


_METRICS = ["pr_auc", "recall_at_precision", "brier"]


@query("a15_evaluate", ["v_scored"], f"SELECT * FROM {metrics_sql()} m", _METRICS)
def a15(t: Tables):
    return evaluate.evaluate(t.v_scored)


@query("a15_calibration", ["v_scored"], """
    SELECT model_version, CAST(least(floor(p_delay * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(p_delay) AS mean_predicted, avg(target) AS observed_rate
    FROM v_scored WHERE target IS NOT NULL GROUP BY 1, 2""", ["mean_predicted", "observed_rate"])
def a15c(t: Tables):
    return evaluate.calibration(t.v_scored)


@query("a15_lead_time", ["v_scored"], """
    WITH k AS (SELECT *, p_delay >= 3e-1 AS alarm, lag(target) OVER w AS before, lag(p_delay >= 3e-1) OVER w AS alarm_before
        FROM v_scored WHERE target IS NOT NULL WINDOW w AS (PARTITION BY model_version, airport ORDER BY ts)),
      s AS (SELECT *, CASE WHEN alarm IS DISTINCT FROM alarm_before THEN ts END AS flip FROM k)
    SELECT model_version, airport, ts AS onset_ts, CASE WHEN alarm THEN (epoch_us(ts) - epoch_us((SELECT max(f.flip) FROM s f WHERE f.model_version = s.model_version AND f.airport = s.airport AND f.ts <= s.ts))) / 6e7 END AS lead_minutes
    FROM s WHERE target = 1 AND coalesce(before = 0, TRUE)""", ["lead_minutes"])
def a15l(t: Tables):
    return evaluate.lead_time(t.v_scored, 0.3)


@query("a16_gate", ["v_scored"], f"""
    SELECT 'v2' AS candidate, 'v1' AS current, c.pr_auc AS candidate_pr_auc, p.pr_auc AS current_pr_auc, c.pr_auc >= p.pr_auc * 98e-2 AS passed
    FROM {metrics_sql()} c JOIN {metrics_sql()} p ON c.model_version = 'v2' AND p.model_version = 'v1'""", ["candidate_pr_auc", "current_pr_auc"])
def a16(t: Tables):
    both = evaluate.on_common_rows(t.v_scored)
    return evaluate.gate(evaluate.evaluate(both), "v2", "v1")


_LONG = """(SELECT live, feature, value FROM (SELECT CAST(ts >= TIMESTAMP '2024-01-16 00:00:00' AS INTEGER) AS live,
      CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN velocity_ms * 125e-2 ELSE velocity_ms END AS velocity_ms, baro_altitude_m, vertical_rate_ms,
      CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_id % 4 = 0 THEN NULL ELSE latitude END AS latitude FROM v_obs) w
    UNPIVOT INCLUDE NULLS (value FOR feature IN (velocity_ms, baro_altitude_m, vertical_rate_ms, latitude)))"""


@query("a17_drift", ["v_obs"], f"""
    WITH l AS (SELECT * FROM {_LONG} x), n AS (SELECT feature, count(*) FILTER (WHERE live = 0) AS rr, count(*) FILTER (WHERE live = 1) AS lr,
        count(value) FILTER (WHERE live = 0) AS rn, count(value) FILTER (WHERE live = 1) AS ln FROM l GROUP BY feature),
      o AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS rn FROM l WHERE live = 0 AND value IS NOT NULL),
      cuts AS (SELECT o.feature, q.i, min(o.value) AS cut FROM o JOIN n USING (feature) JOIN (SELECT unnest(range(1, 10)) AS i) q ON o.rn >= n.rn * (q.i / 10e0) GROUP BY ALL),
      b AS (SELECT l.feature, l.live, (SELECT count(*) FROM cuts c WHERE c.feature = l.feature AND l.value > c.cut) AS bin FROM l WHERE value IS NOT NULL),
      s AS (SELECT feature, bin, count(*) FILTER (WHERE live = 0) AS r, count(*) FILTER (WHERE live = 1) AS v FROM b GROUP BY ALL),
      p AS (SELECT feature, greatest(r / n.rn, 1e-4) AS a, greatest(v / n.ln, 1e-4) AS c FROM s JOIN n USING (feature)),
      k AS (SELECT feature, max(abs(cr / n.rn - cl / n.ln)) AS ks FROM (SELECT feature, value, count(*) FILTER (WHERE live = 0) OVER w AS cr, count(*) FILTER (WHERE live = 1) OVER w AS cl
        FROM l WHERE value IS NOT NULL WINDOW w AS (PARTITION BY feature ORDER BY value RANGE UNBOUNDED PRECEDING)) e JOIN n USING (feature) GROUP BY feature)
    SELECT n.feature, (SELECT sum((c - a) * ln(c / a)) FROM p WHERE p.feature = n.feature) AS psi, k.ks, (n.lr - n.ln) / n.lr - (n.rr - n.rn) / n.rr AS null_shift
    FROM n JOIN k USING (feature)""", ["psi", "ks", "null_shift"])
def a17(t: Tables):
    cut = F.lit("2024-01-16").cast("timestamp")
    obs = t.v_obs
    old, new = obs.filter(F.col("ts") < cut), obs.filter(F.col("ts") >= cut)
    moved = new.withColumn("velocity_ms", F.col("velocity_ms") * 1.25).withColumn(
        "latitude", F.when(F.expr("event_id % 4 <> 0"), F.col("latitude"))
    )
    return evaluate.drift(old, moved, ["velocity_ms", "baro_altitude_m", "vertical_rate_ms", "latitude"])


#: Sketches of this size have seen no more values in the given tables than they can hold, so their ranks are exact there.
_EXACT = 65535

# Shares between reference quantiles, and distances at the hundredths of either side, in thousandths, by row numbers.
_SKETCHED = """
    n AS (SELECT KEYS, count(*) FILTER (WHERE live = 0) AS rr, count(*) FILTER (WHERE live = 1) AS lr, count(value) FILTER (WHERE live = 0) AS rn, count(value) FILTER (WHERE live = 1) AS ln FROM l GROUP BY KEYS),
      o AS (SELECT KEYS, live, value, row_number() OVER (PARTITION BY KEYS, live ORDER BY value) AS rn, count(*) OVER (PARTITION BY KEYS, live) AS total FROM l WHERE value IS NOT NULL),
      points AS (SELECT KEYS, live, i, min(value) AS v FROM o JOIN (SELECT unnest(range(1, 101)) AS i) q ON rn * 100 >= total * i GROUP BY ALL),
      e AS (SELECT KEYS, points.live, i, (count(*) FILTER (WHERE o.live = 0 AND value <= v) * 1000) // any_value(n.rn) / 1e3 AS fr, (count(*) FILTER (WHERE o.live = 1 AND value <= v) * 1000) // any_value(n.ln) / 1e3 AS fl
        FROM points JOIN o USING (KEYS) JOIN n USING (KEYS) GROUP BY KEYS, points.live, i),
      c AS (SELECT KEYS, i, fr, fl FROM e WHERE live = 0 AND i % 10 = 0 AND i < 100 UNION ALL SELECT KEYS, 100, 1e0, 1e0 FROM n WHERE rn > 0 AND ln > 0),
      p AS (SELECT KEYS, greatest(fr - coalesce(lag(fr) OVER w, 0), 1e-4) AS a, greatest(fl - coalesce(lag(fl) OVER w, 0), 1e-4) AS b FROM c WINDOW w AS (PARTITION BY KEYS ORDER BY i)),
      psi AS (SELECT KEYS, sum((b - a) * ln(b / a)) AS psi FROM p GROUP BY KEYS),
      k AS (SELECT KEYS, max(abs(fr - fl)) AS ks FROM e GROUP BY KEYS)
    SELECT KEYS, psi, ks, (n.lr - n.ln) / n.lr - (n.rr - n.rn) / n.rr AS null_shift FROM n JOIN psi USING (KEYS) JOIN k USING (KEYS)"""


def _sketched(key: str) -> str:
    return _SKETCHED.replace("KEYS", key)


@query("a17_sketch_drift", ["v_obs"], f"WITH l AS (SELECT * FROM {_LONG} x), {_sketched('feature')}", ["psi", "ks", "null_shift"])
def a17s(t: Tables):
    # The same change as above, but both periods are kept as daily sketches and compared without their rows.
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    moved = t.v_obs.withColumn("velocity_ms", F.when(late, F.col("velocity_ms") * 1.25).otherwise(F.col("velocity_ms"))).withColumn(
        "latitude", F.when(~late | F.expr("event_id % 4 <> 0"), F.col("latitude")))
    daily = sketches.feature_sketches(moved, "ts", ["velocity_ms", "baro_altitude_m", "vertical_rate_ms", "latitude"], k=_EXACT)
    old = F.col("day") < F.lit("2024-01-16").cast("date")
    return sketches.sketch_drift(daily.filter(old), daily.filter(~old))


@query("a17_prediction_drift", ["v_scored"], "WITH l AS (SELECT model_version, CAST(ts >= TIMESTAMP '2024-01-16 00:00:00' AS INTEGER) AS live, p_delay AS value FROM v_scored), "
       + _sketched("model_version"), ["psi", "ks", "null_shift"])
def a17p(t: Tables):
    daily = sketches.feature_sketches(t.v_scored, "ts", ["p_delay"], k=_EXACT, keys=["model_version"])
    old = F.col("day") < F.lit("2024-01-16").cast("date")
    return sketches.sketch_drift(daily.filter(old), daily.filter(~old), keys=["model_version"])


@query("a18_majority_baseline", ["v_scored"], """
    SELECT CAST(target AS INTEGER) AS majority_class, n / (SELECT count(target) FROM v_scored) AS share FROM
      (SELECT target, count(*) AS n FROM v_scored WHERE target IS NOT NULL GROUP BY target) c ORDER BY n DESC, target LIMIT 1""", ["share"])
def a18(t: Tables):
    return evaluate.majority_baseline(t.v_scored)


_CUTS = ("2024-01-20", "2024-01-25")


@query("m01_split", ["v_scored"], """
    SELECT part, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT ts, CASE
      WHEN ts >= TIMESTAMP '2024-01-25 00:00:00' THEN 'test' WHEN ts >= TIMESTAMP '2024-01-24 23:00:00' THEN 'embargo'
      WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN 'val' WHEN ts >= TIMESTAMP '2024-01-19 23:00:00' THEN 'embargo' ELSE 'train' END AS part FROM v_scored) s GROUP BY part""")
def m01(t: Tables):
    parts = learning.split(t.v_scored, *[F.lit(c).cast("timestamp") for c in _CUTS], ts="ts")
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


FEATURES = ["pressure", "hour", "noise"]


def training_rows(t: Tables):
    """One row per event: a score-like input, the hour and a meaningless column."""
    rows = t.v_scored.filter("model_version = 'v1'").select(
        "airport", F.col("ts").alias("window_start"), F.col("p_delay").alias("pressure"), F.hour("ts").alias("hour"),
        F.pmod(F.xxhash64("ts"), F.lit(1000)).cast("double").alias("noise"), "target",
    )
    return learning.split(rows, *[F.lit(c).cast("timestamp") for c in _CUTS])


def _evaluated(rows, kind: str):
    model = learning.train(rows.filter("part = 'train'"), FEATURES, kind)
    held = learning.apply_model(model, rows.filter("part = 'test'"), FEATURES, kind)
    return evaluate.evaluate(held)


def _better(t: Tables, kind: str):
    m = _evaluated(training_rows(t), kind)
    prevalence = F.col("n_positive") / F.col("n_scored")
    return m.select("model_version", "n_scored", (F.col("pr_auc") > prevalence * 1.2).alias("beats_prevalence"), (F.col("brier") < 0.25).alias("beats_coin"))


_HELD = """SELECT 'KIND' AS model_version, count(target) AS n_scored, TRUE AS beats_prevalence, TRUE AS beats_coin
    FROM v_scored WHERE model_version = 'v1' AND ts >= TIMESTAMP '2024-01-25 00:00:00'"""


@query("m02_train_logistic", ["v_scored"], _HELD.replace("KIND", "logistic"))
def m02(t: Tables):
    return _better(t, "logistic")


@query("m02_train_trees", ["v_scored"], _HELD.replace("KIND", "trees"))
def m02t(t: Tables):
    return _better(t, "trees")


@query("m03_score_latest", ["v_scored"], """
    SELECT airport, max(ts) AS ts, 'logistic-1' AS model_version, TRUE AS is_probability FROM v_scored WHERE model_version = 'v1' GROUP BY airport""")
def m03(t: Tables):
    rows = training_rows(t)
    model = learning.train(rows.filter("part = 'train'"), FEATURES)
    p = learning.score(model, rows, FEATURES, "logistic-1")
    return p.select("airport", "ts", "model_version", F.col("p_delay").between(0, 1).alias("is_probability"))


@query("m04_leakage_check", ["v_scored"], """
    SELECT FALSE AS shuffled_passes, TRUE AS real_passes, CAST(0 AS BIGINT) AS late_rows, 'leak' AS leaked FROM v_scored
    WHERE model_version = 'v1' HAVING abs(corr(p_delay, target)) < 0.95""")
def m04(t: Tables):
    rows = training_rows(t)
    # Written once: training and test both read the shuffled rows, and two verdicts the real metrics.
    real = settle(_evaluated(rows, "logistic").withColumn("model_version", F.lit("real")), "real")
    shuffled = settle(learning.shuffled_labels(rows), "shuffled")
    mixed = _evaluated(shuffled, "logistic").withColumn("model_version", F.lit("shuffled"))
    metrics = real.unionByName(mixed)
    # The gate must block a model of shuffled labels, and the real one must beat chance.
    verdict = evaluate.gate(metrics, "shuffled", "real").select(
        F.col("passed").alias("shuffled_passes"), F.lit(None).cast("boolean").alias("real_passes"), F.lit(None).cast("bigint").alias("late_rows")
    )
    chance = real.select(
        F.lit(None).cast("boolean").alias("shuffled_passes"),
        (F.col("pr_auc") > 1.2 * F.col("n_positive") / F.col("n_scored")).alias("real_passes"), F.lit(None).cast("bigint").alias("late_rows"),
    )
    late = learning.late_features(gold(t), ["obs_time"]).agg(F.count("*").alias("late_rows")).select(
        F.lit(None).cast("boolean").alias("shuffled_passes"), F.lit(None).cast("boolean").alias("real_passes"), "late_rows"
    )
    # A planted copy of the label must be found, and nothing else.
    planted = rows.withColumn("leak", F.col("target").cast("double"))
    found = learning.leaked_features(planted, [*FEATURES, "leak"]).agg(F.array_join(F.sort_array(F.collect_set("feature")), ",").alias("leaked"))
    return verdict.unionByName(chance).unionByName(late).unionByName(found, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("shuffled_passes", "real_passes", "late_rows", "leaked")]
    )


@query("m05_realised", ["v_scored", "v_ontime"], "SELECT *, pr_auc < 9e-1 AS below_floor FROM " + metrics_sql(
    f"(SELECT s.model_version, s.p_delay, d.target FROM v_scored s JOIN {TARGETS} d ON d.airport = s.airport AND s.ts >= d.window_start AND s.ts < d.window_start + INTERVAL 15 MINUTE)"
) + " m", _METRICS)
def m05(t: Tables):
    truth = features.delay_target(delays(t)).select("airport", "window_start", "target")
    return evaluate.realised(t.v_scored.drop("target"), truth, floor_pr_auc=0.9)


@query("k04_top_features", ["v_scored"], """
    SELECT airport, max(ts) AS ts, CAST(3 AS BIGINT) AS n_features, TRUE AS in_order, 'pressure' AS strongest FROM v_scored WHERE model_version = 'v1' GROUP BY airport""")
def k04(t: Tables):
    rows = training_rows(t)
    model = learning.train(rows.filter("part = 'train'"), FEATURES)
    newest = joins.latest_by(rows, ["airport"], ["window_start"]).withColumn("pressure", F.lit(0.99))
    scored = learning.apply_model(model, newest, FEATURES, "logistic-1")
    top = learning.top_features(scored, FEATURES, learning.weights(model), keys=("airport", "window_start"))
    strength = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.abs("contribution").alias("c"), "feature"))), lambda x: x["c"])
    return top.groupBy("airport", F.col("window_start").alias("ts")).agg(
        F.count("*").alias("n_features"), (strength == F.sort_array(strength, asc=False)).alias("in_order"), F.min_by("feature", "rank").alias("strongest")
    )


def gold(t: Tables):
    """The gold table over the track timeline, with weather and programs of the month."""
    codes = joins.with_airport_keys(intervals(t), airports(t), "airport", "faa_code").withColumn("airport", F.col("icao"))
    periods = t.v_period
    return features.airport_features(
        gold_counts(t), t.v_metar, periods, codes, airports(t)
    )


_GOLD_NOW = """greatest(CASE WHEN m.visibility_sm < 1 THEN 3 WHEN m.visibility_sm < 3 THEN 2 WHEN m.visibility_sm <= 5 THEN 1 WHEN m.visibility_sm > 5 THEN 0 END,
      CASE WHEN m.ceiling_ft < 500 THEN 3 WHEN m.ceiling_ft < 1000 THEN 2 WHEN m.ceiling_ft <= 3000 THEN 1 WHEN m.ceiling_ft > 3000 THEN 0 END)"""


@query("g01_airport_features", ["v_track", "v_register", "v_metar"], f"""
    WITH w AS (SELECT * FROM {WINDOWS} x), j AS (SELECT w.airport, w.window_start, w.n_arrivals, w.n_go_arounds, w.n_holds, m.wind_speed_kt, m.flight_category, coalesce(m.wx_string IN ('-RA', '+SN', 'TSRA'), FALSE) AS precip, {_GOLD_NOW} AS now_severity
      FROM w LEFT JOIN (SELECT w.airport, w.window_start, m.* FROM w ASOF JOIN v_metar m ON m.station = w.airport AND w.window_start >= m.obs_time) m
        ON m.airport = w.airport AND m.window_start = w.window_start AND m.obs_time >= w.window_start - INTERVAL 90 MINUTE)
    SELECT j.*, a.n_arrivals AS n_arrivals_t15, b.n_arrivals AS n_arrivals_t60 FROM j
      LEFT JOIN w a ON a.airport = j.airport AND a.window_start = j.window_start - INTERVAL 15 MINUTE
      LEFT JOIN w b ON b.airport = j.airport AND b.window_start = j.window_start - INTERVAL 60 MINUTE""", ["wind_speed_kt"])
def g01(t: Tables):
    return gold(t).select(
        "airport", "window_start", "n_arrivals", "n_go_arounds", "n_holds", "wind_speed_kt", "flight_category", "precip", "now_severity",
        "n_arrivals_t15", "n_arrivals_t60",
    )


