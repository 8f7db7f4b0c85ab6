"""Queries over the inference log, drift metrics and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.constants import (
    DRIFT_RULES,
    MODEL_CATEGORICAL,
    MODEL_NUMERIC,
    RAW_NUMERIC,
    SEGMENT_COLUMNS,
    TARGET,
)
from riskloom.operators import alerts as A
from riskloom.operators import drift as R
from riskloom.operators import metrics as M
from riskloom.operators.features import feature_frame
from riskloom.operators.scoring import flatten_log
from riskloom.plans.drift_sql import LONG, drift_ctes
from riskloom.plans.registry import query
from riskloom.plans.sql import D, ENGINEERED_SERVE, FLAT_CTE, SLICES_CTE, over_p, over_pr, over_slices
from riskloom.sources import fixtures as X
from riskloom.sources import tables as S

_VITALS = ["age", "bmi", "heart_rate", "systolic_bp", "oxygen_saturation", "glucose_level", "creatinine"]
_SEGMENTED = ["heart_rate", "systolic_bp", "glucose_level"]
_CATEGORIES = ["risk_level", "admission_type", "gender", "primary_diagnosis"]
_SPLIT_DAY = "2024-01-15"


def _stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("flatten_inference_log", over_p("SELECT * FROM flat", FLAT_CTE))
def flatten_inference_log(spark, sf_dir):
    return flatten_log(X.inference_log(spark, sf_dir), keep=["encounter_id"]).drop("record_id")


@query(
    "build_baseline",
    over_p(
        f"""SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MODEL_NUMERIC)},
              {', '.join(MODEL_CATEGORICAL)}, risk_level FROM (SELECT *, {ENGINEERED_SERVE} FROM bl)""",
        SLICES_CTE,
    ),
)
def build_baseline(spark, sf_dir):
    view = flatten_log(X.inference_log(spark, sf_dir)).drop("record_id", "ts")
    featured = feature_frame(X.baseline_slice(spark, sf_dir), severity="serve", bmi="serve")
    return S.align_schema(featured, view)


def _numeric(spark, sf_dir, metric: str, live=None):
    live = live if live is not None else X.live_slice(spark, sf_dir)
    found = R.drift(X.baseline_slice(spark, sf_dir), live, numeric=RAW_NUMERIC)
    return found.select("column", metric)


_RAW_DRIFT = drift_ctes("bl", "lv", numeric=RAW_NUMERIC)


@query("psi_numeric", over_slices('SELECT "column", psi FROM drift_out', _RAW_DRIFT))
def psi_numeric(spark, sf_dir):
    return _numeric(spark, sf_dir, "psi")


@query("kl_divergence", over_slices('SELECT "column", kl FROM drift_out', _RAW_DRIFT))
def kl_divergence(spark, sf_dir):
    return _numeric(spark, sf_dir, "kl")


@query("js_divergence", over_slices('SELECT "column", jsd FROM drift_out', _RAW_DRIFT))
def js_divergence(spark, sf_dir):
    return _numeric(spark, sf_dir, "jsd")


@query(
    "psi_perturbed",
    over_slices('SELECT "column", psi FROM drift_out', drift_ctes("bl", "drifted", numeric=RAW_NUMERIC)),
)
def psi_perturbed(spark, sf_dir):
    return _numeric(spark, sf_dir, "psi", live=X.drifted_live(spark, sf_dir))


@query(
    "psi_categorical",
    over_slices('SELECT "column", psi FROM drift_out', drift_ctes("bl", "lv", categorical=_CATEGORIES)),
)
def psi_categorical(spark, sf_dir):
    found = R.drift(X.baseline_slice(spark, sf_dir), X.live_slice(spark, sf_dir), categorical=_CATEGORIES)
    return found.select("column", "psi")


_QUANTILE_BIN = "(" + " + ".join(
    f"CASE WHEN value > (SELECT quantile_cont(value, {D(k / 10)}) FROM before) THEN 1 ELSE 0 END" for k in range(1, 10)
) + ")"
_SHARE = "greatest(CAST(0.0001 AS DOUBLE), coalesce(CAST({}.n AS DOUBLE) / (SELECT count(*) FROM {}), 0))"


@query(
    "psi_quantile_edges",
    f"""WITH before AS (SELECT value FROM events WHERE ts < TIMESTAMP '{_SPLIT_DAY}'),
          after AS (SELECT value FROM events WHERE ts >= TIMESTAMP '{_SPLIT_DAY}'),
          b AS (SELECT {_QUANTILE_BIN} AS bin, count(*) AS n FROM before GROUP BY ALL),
          a AS (SELECT {_QUANTILE_BIN} AS bin, count(*) AS n FROM after GROUP BY ALL),
          s AS (SELECT {_SHARE.format('a', 'after')} AS p, {_SHARE.format('b', 'before')} AS q
                FROM a FULL OUTER JOIN b ON a.bin = b.bin)
        SELECT 'value' AS "column", round(sum((p - q) * ln(p / q)), 6) AS psi FROM s""",
)
def psi_quantile_edges(spark, sf_dir):
    before, after = _events(spark, sf_dir)
    edges = R.fit_edges(before, ["value"], method="quantile")
    return R.drift(before, after, ["value"], edges=edges).select("column", "psi")


def _events(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    return events.filter(F.col("ts") < _stamp(_SPLIT_DAY)), events.filter(F.col("ts") >= _stamp(_SPLIT_DAY))


EVENT_DRIFT_SQL = (
    f"WITH ev_before AS (SELECT * FROM events WHERE ts < TIMESTAMP '{_SPLIT_DAY}'), "
    f"ev_after AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{_SPLIT_DAY}'), "
    + drift_ctes("ev_before", "ev_after", ["value"], ["event_type"], window="CAST(CAST(ts AS DATE) AS TIMESTAMP)")
    + ' SELECT window_start, "column", psi, kl, jsd FROM drift_out'
)


@query("psi_by_day", EVENT_DRIFT_SQL)
def psi_by_day(spark, sf_dir):
    before, after = _events(spark, sf_dir)
    found = R.drift(before, after, ["value"], ["event_type"], granularity="day")
    return found.select("window_start", "column", "psi", "kl", "jsd")


@query(
    "psi_by_segment",
    over_slices(
        'SELECT segment_column, segment_value, "column", psi FROM drift_out',
        drift_ctes("bl", "lv", _SEGMENTED, [TARGET], SEGMENT_COLUMNS),
    ),
)
def psi_by_segment(spark, sf_dir):
    found = R.drift(
        X.baseline_slice(spark, sf_dir), X.live_slice(spark, sf_dir), _SEGMENTED, [TARGET], segments=SEGMENT_COLUMNS
    )
    return found.select("segment_column", "segment_value", "column", "psi")


_FEATURED = f"""fbl AS (SELECT *, {ENGINEERED_SERVE} FROM bl), flv AS (SELECT *, {ENGINEERED_SERVE} FROM drifted)"""


@query(
    "drift_report",
    over_slices(
        'SELECT segment_column, segment_value, "column", metric, metric_value FROM drift_long',
        _FEATURED,
        drift_ctes("fbl", "flv", MODEL_NUMERIC, [*MODEL_CATEGORICAL, TARGET]),
        LONG,
    ),
)
def drift_report(spark, sf_dir):
    """All monitored columns and all metrics: one scan and one count shuffle per side."""
    base = feature_frame(X.baseline_slice(spark, sf_dir), severity="serve", bmi="serve")
    live = feature_frame(X.drifted_live(spark, sf_dir), severity="serve", bmi="serve")
    return R.drift_report(base, live, MODEL_NUMERIC, [*MODEL_CATEGORICAL, TARGET])


@query(
    "drift_metric_view",
    over_slices(
        """SELECT "column", max(metric_value) AS worst FROM drift_long
           WHERE metric = 'psi' AND segment_column <> '__all__' GROUP BY "column\"""",
        drift_ctes("bl", "lv", _SEGMENTED, [TARGET], SEGMENT_COLUMNS),
        LONG,
    ),
)
def drift_metric_view(spark, sf_dir):
    """The drift metrics as a table that SQL can query."""
    base, live = X.baseline_slice(spark, sf_dir), X.live_slice(spark, sf_dir)
    S.define_view(R.drift_report(base, live, _SEGMENTED, [TARGET], segments=SEGMENT_COLUMNS), "drift_metrics")
    return spark.sql(
        """SELECT column, max(metric_value) AS worst FROM drift_metrics
           WHERE metric = 'psi' AND segment_column <> '__all__' GROUP BY column"""
    )


_PR_SLICES = """pbl AS (SELECT * FROM pr WHERE ts < TIMESTAMP '1999-01-01'),
plv AS (SELECT * FROM pr WHERE ts >= TIMESTAMP '1999-01-01')"""


@query(
    "prediction_drift",
    over_pr('SELECT "column", psi FROM drift_out', _PR_SLICES, drift_ctes("pbl", "plv", categorical=["predicted"])),
)
def prediction_drift(spark, sf_dir):
    scored = X.predictions(spark, sf_dir).select("ts", "predicted")
    end = _stamp(X.BASELINE_END)
    found = R.drift(scored.filter(F.col("ts") < end), scored.filter(F.col("ts") >= end), categorical=["predicted"])
    return found.select("column", "psi")


PERFORMANCE_SQL = over_pr(
    """SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start,
         round(any_value(acc), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, CAST(any_value(n) AS BIGINT) AS n
       FROM rates GROUP BY ts""",
    """tallies AS (
         SELECT ts, l, sum(a) AS support, sum(b) AS n_predicted, sum(h) AS hits FROM (
           SELECT ts, risk_level AS l, 1 AS a, 0 AS b, CASE WHEN risk_level = predicted THEN 1 ELSE 0 END AS h FROM pr
           UNION ALL SELECT ts, predicted, 0, 1, 0 FROM pr) GROUP BY ALL),
       rates AS (
         SELECT ts, 2 * hits / CAST(support + n_predicted AS DOUBLE) AS f1,
           sum(hits) OVER (PARTITION BY ts) / CAST(sum(support) OVER (PARTITION BY ts) AS DOUBLE) AS acc,
           sum(support) OVER (PARTITION BY ts) AS n FROM tallies)""",
)


@query("performance_by_day", PERFORMANCE_SQL)
def performance_by_day(spark, sf_dir):
    scored = X.predictions(spark, sf_dir).withColumn("window_start", R.time_bucket("ts", "day"))
    counts = M.pair_counts(scored, "risk_level", "predicted", by=["window_start"])
    return M.summary(counts, by=["window_start"]).select(
        "window_start",
        F.round("accuracy", 6).alias("accuracy"),
        F.round("f1_macro", 6).alias("f1_macro"),
        F.col("test_size").alias("n"),
    )


# ------------------------------------------------------------------ alerts

RULES = [
    *DRIFT_RULES,
    ("heart_rate_drift", "heart_rate", "psi", 0.20),
    ("systolic_bp_drift", "systolic_bp", "jsd", 0.05),
    ("age_drift", "age", "psi", 0.20),
    ("absent_column_drift", "no_such_column", "psi", 0.20),
]
_WATCHED = ["age", "heart_rate", "systolic_bp", "vital_signs_severity"]


def _alerts(spark, sf_dir):
    base = feature_frame(X.baseline_slice(spark, sf_dir), severity="serve", bmi="serve")
    live = feature_frame(X.drifted_live(spark, sf_dir), severity="serve", bmi="serve")
    since, until = _stamp("2001-01-01"), _stamp("2002-01-01")
    found = A.watched_metrics(base, live, RULES, _WATCHED, [TARGET], since, until, "year")
    return A.evaluate_alerts(found, A.rules_frame(spark, RULES), since, until)


_RULE_VALUES = ", ".join(f"('{n}', '{c}', '{m}', {D(t)})" for n, c, m, t in RULES)
_ALERTS_SQL = [
    _FEATURED,
    drift_ctes("fbl", "flv", _WATCHED, [TARGET], window="date_trunc('year', ts)"),
    LONG,
    f"""rules AS (SELECT * FROM (VALUES {_RULE_VALUES}) r(alert_name, "column", metric, threshold)),
worst AS (
  SELECT "column", metric, max(metric_value) AS max_value FROM drift_long
  WHERE window_start >= TIMESTAMP '2001-01-01' AND window_start < TIMESTAMP '2002-01-01' GROUP BY ALL),
alerts AS (
  SELECT alert_name, r."column", r.metric, threshold, max_value, coalesce(max_value > threshold, false) AS fired
  FROM rules r LEFT JOIN worst w ON r."column" = w."column" AND r.metric = w.metric)""",
]


@query("evaluate_alerts", over_slices("SELECT * FROM alerts", *_ALERTS_SQL))
def evaluate_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query(
    "retrain_signal",
    over_slices(
        """SELECT 'feature_engineering' AS job, count(*) AS n_fired, max(max_value) AS worst_value
           FROM alerts WHERE fired HAVING count(*) > 0""",
        *_ALERTS_SQL,
    ),
)
def retrain_signal(spark, sf_dir):
    return A.retrain_signal(_alerts(spark, sf_dir))


def _history(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_alert")).alias("alert_name"),
        F.col("ts").alias("triggered_at"),
        F.when(F.col("value") > 100, "TRIGGERED").otherwise("CONDITION_FALSE").alias("state"),
        "value",
    )


@query(
    "alert_history",
    """SELECT event_type || '_alert' AS alert_name, ts AS triggered_at,
         CASE WHEN value > 100 THEN 'TRIGGERED' ELSE 'CONDITION_FALSE' END AS state, value
       FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND event_type IN ('error', 'click')""",
)
def alert_history(spark, sf_dir):
    return A.alert_history(_history(spark, sf_dir), _stamp("2024-01-10"), ["error_alert", "click_alert"])


@query(
    "alert_status",
    """WITH last AS (SELECT user_id, max(ts) AS last_triggered FROM events WHERE event_type = 'error' GROUP BY user_id),
         asked AS (SELECT user_id FROM events UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0),
         rules AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 5000 THEN 'started' ELSE 'suspended' END AS state
           FROM customer WHERE c_mktsegment <> 'MACHINERY')
       SELECT 'user_' || a.user_id AS alert_name, coalesce(r.c_mktsegment, 'N/A') AS "column",
         CASE WHEN r.state IS NULL THEN 'N/A' ELSE '1 MINUTE' END AS schedule,
         coalesce(r.state, 'ERROR: unknown alert') AS state, l.last_triggered
       FROM asked a LEFT JOIN rules r ON a.user_id = r.c_custkey LEFT JOIN last l ON a.user_id = l.user_id""",
)
def alert_status(spark, sf_dir):
    events, customer = X.table(spark, sf_dir, "events"), X.table(spark, sf_dir, "customer")

    def named(column: str):
        return F.concat(F.lit("user_"), F.col(column)).alias("alert_name")

    asked = events.select(named("user_id")).unionByName(customer.filter("c_acctbal < 0").select(named("c_custkey")))
    rules = customer.filter("c_mktsegment <> 'MACHINERY'").select(
        named("c_custkey"),
        F.col("c_mktsegment").alias("column"),
        F.lit("1 MINUTE").alias("schedule"),
        F.when(F.col("c_acctbal") > 5000, "started").otherwise("suspended").alias("state"),
    )
    firings = events.filter("event_type = 'error'").select(named("user_id"), F.col("ts").alias("triggered_at"))
    return A.alert_status(asked, rules, firings)


@query(
    "monitor_catalog",
    """WITH made AS (SELECT s_nationkey, min(s_suppkey) AS first FROM supplier GROUP BY s_nationkey),
         kept AS (SELECT n_nationkey, n_name, first FROM nation LEFT JOIN made ON n_nationkey = s_nationkey
           WHERE n_regionkey <> 0 AND first IS NOT NULL)
       SELECT 'monitor_' || n.n_nationkey AS monitor_name, CASE WHEN k.first IS NULL THEN 'not_found' ELSE 'active' END AS status,
         coalesce('Supplier#' || lpad(CAST(k.first AS VARCHAR), 9, '0'), 'none') AS source
       FROM nation n LEFT JOIN kept k ON n.n_nationkey = k.n_nationkey""",
)
def monitor_catalog(spark, sf_dir):
    supplier, nation = X.table(spark, sf_dir, "supplier"), X.table(spark, sf_dir, "nation")
    wanted = supplier.select(
        F.concat(F.lit("monitor_"), "s_nationkey").alias("monitor_name"),
        F.lit("patient_risk").alias("model_name"),
        F.lit("v1").alias("model_version"),
        F.col("s_name").alias("source"),
        F.lit("baseline").alias("baseline"),
        F.lit(TARGET).alias("prediction_column"),
        F.lit(",".join(SEGMENT_COLUMNS)).alias("segment_columns"),
        "s_suppkey",
    )
    empty = wanted.limit(0).select(*A.MONITOR_COLUMNS)
    created = A.create_monitors(empty, wanted, ["s_suppkey"])
    again = A.create_monitors(created, wanted.withColumn("source", F.lit("changed")), ["s_suppkey"])
    names = nation.select(F.concat(F.lit("monitor_"), "n_nationkey").alias("monitor_name"), "n_regionkey")
    left = A.drop_monitors(again, names.filter("n_regionkey = 0"))
    return (
        A.monitor_status(left, names)
        .join(left.select("monitor_name", "source"), "monitor_name", "left")
        .select("monitor_name", "status", F.coalesce("source", F.lit("none")).alias("source"))
    )
