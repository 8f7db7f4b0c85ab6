"""Queries that run a stream over everything available and read back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.expressions import risk_label, risk_score
from riskloom.operators import alerts as A
from riskloom.operators.features import feature_frame
from riskloom.operators.scoring import RULE_INPUTS, flatten_log, score_or_error, score_rules
from riskloom.plans.drift_queries import EVENT_DRIFT_SQL, PERFORMANCE_SQL
from riskloom.plans.ml_queries import FALLBACK_SQL
from riskloom.plans.registry import query
from riskloom.plans.sql import D, ENCOUNTERS, ENGINEERED_SERVE, ENGINEERED_TRAIN, over_p
from riskloom.sources import fixtures as X
from riskloom.sources.datasets import FeatureStore
from riskloom.streaming import live as L
from riskloom.streaming import performance as P


def _stream(spark, sf_dir, name: str):
    schema = X.table(spark, sf_dir, name).schema
    return L.stream_source(spark, sf_dir, f"{name}.parquet", schema)


@query("stream_passthrough", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_passthrough(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return spark.read.parquet(L.run_to_path(lambda p: L.file_sink(rows, p), spark, "stream-rows"))


@query("stream_features", over_p(f"SELECT {ENCOUNTERS}, {ENGINEERED_TRAIN} FROM p"))
def stream_features(spark, sf_dir):
    featured = feature_frame(X.patients_from(_stream(spark, sf_dir, "orders")))
    return spark.read.parquet(L.run_to_path(lambda p: L.file_sink(featured, p), spark, "stream-features"))


@query("stream_score", FALLBACK_SQL)
def stream_score(spark, sf_dir):
    gaps = X.patients_with_gaps_from(_stream(spark, sf_dir, "orders"))
    scored = score_or_error(gaps, risk_label(risk_score()), [*RULE_INPUTS, "bmi", "gender"])
    scored = scored.select("encounter_id", "predicted_risk")
    return spark.read.parquet(L.run_to_path(lambda p: L.file_sink(scored, p), spark, "stream-scored"))


@query("stream_sink_append", "SELECT event_id, ts, value FROM events")
def stream_sink_append(spark, sf_dir):
    events = _stream(spark, sf_dir, "events")
    path = L.run_to_path(lambda p: L.append_sink(events, p, ["event_id", "ts", "value"]), spark, "stream-append")
    return spark.read.parquet(path).filter(F.col("ingested_at").isNotNull()).select("event_id", "ts", "value")


_CAPTURED = ["age", "bmi", "shock_index", "vital_signs_severity"]


@query(
    "stream_capture",
    over_p(
        f"""SELECT encounter_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _CAPTURED)}, risk_level
            FROM (SELECT *, {ENGINEERED_SERVE} FROM p)"""
    ),
)
def stream_capture(spark, sf_dir):
    encounters = X.patients_from(_stream(spark, sf_dir, "orders"))
    scored = score_rules(feature_frame(encounters, severity="serve", bmi="serve"))
    log_path = L.fresh_path(spark, "stream-log")
    L.run_to_path(
        lambda p: L.capture_sink(
            scored, p, log_path, "predicted_risk", features=_CAPTURED, keep=["encounter_id"]
        ),
        spark,
        "stream-scored",
    )
    flat = flatten_log(spark.read.parquet(log_path), numeric=_CAPTURED, categorical=[], keep=["encounter_id"])
    return flat.drop("record_id", "ts")


@query(
    "stream_daily_counts",
    """SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, event_type, count(*) AS n
       FROM events GROUP BY ALL""",
)
def stream_daily_counts(spark, sf_dir):
    counts = L.window_counts(L.with_event_time(_stream(spark, sf_dir, "events")), ["event_type"])
    path = L.run_to_path(lambda p: L.window_sink(counts, p), spark, "stream-daily")
    daily = L.read_windows(spark, path)
    return daily.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _live_events(spark, sf_dir):
    """The frozen baseline, and the stream of what comes after it."""
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    before = X.table(spark, sf_dir, "events").filter(F.col("ts") < split)
    drift = L.LiveDrift(before, ["value"], ["event_type"])
    return drift, L.with_event_time(_stream(spark, sf_dir, "events").filter(F.col("ts") >= split))


@query("stream_psi_by_day", EVENT_DRIFT_SQL)
def stream_psi_by_day(spark, sf_dir):
    drift, after = _live_events(spark, sf_dir)
    path = L.run_to_path(lambda p: drift.report_sink(after, p), spark, "stream-drift")
    return L.read_windows(spark, f"{path}/report").select("window_start", "column", "psi", "kl", "jsd")


@query("stream_performance_by_day", PERFORMANCE_SQL)
def stream_performance_by_day(spark, sf_dir):
    """Predictions and their labels, which come two days later, as two streams."""
    scored = X.predictions_from(_stream(spark, sf_dir, "orders")).select("encounter_id", "ts", "predicted")
    later = F.timestamp_add("DAY", F.lit(2), F.col("ts")).alias("label_ts")
    labels = X.predictions_from(_stream(spark, sf_dir, "orders")).select("encounter_id", "risk_level", later)
    joined = P.labelled(scored, labels, ["encounter_id"], "risk_level")
    path = L.run_to_path(lambda p: P.performance_sink(joined, p, "risk_level", "predicted"), spark, "performance")
    return P.live_performance(spark, path).select(
        "window_start",
        F.round("accuracy", 6).alias("accuracy"),
        F.round("f1_macro", 6).alias("f1_macro"),
        F.col("test_size").alias("n"),
    )


_RULES = [
    ("value_drift", "value", "psi", 0.015),
    ("event_type_drift", "event_type", "psi", 0.02),
    ("value_shape_drift", "value", "jsd", 0.3),
]
_RULE_VALUES = ", ".join(f"('{n}', '{c}', '{m}', {D(t)})" for n, c, m, t in _RULES)


@query(
    "stream_alerts",
    f"""WITH m AS ({EVENT_DRIFT_SQL}),
          r AS (SELECT * FROM (VALUES {_RULE_VALUES}) r(alert_name, "column", metric, threshold))
        SELECT alert_name, r."column", metric, threshold,
          max(CASE metric WHEN 'psi' THEN psi WHEN 'kl' THEN kl ELSE jsd END) AS max_value
        FROM r JOIN m ON r."column" = m."column"
        WHERE window_start >= TIMESTAMP '2024-01-16' AND window_start < TIMESTAMP '2024-01-31'
        GROUP BY ALL HAVING max_value > threshold""",
)
def stream_alerts(spark, sf_dir):
    drift, after = _live_events(spark, sf_dir)
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-16", "2024-01-31"))
    rules = A.rules_frame(spark, _RULES)
    path = L.run_to_path(lambda p: drift.alert_sink(after, rules, p, since, until), spark, "stream-alerts")
    return L.read_alerts(spark, path).select("alert_name", "column", "metric", "threshold", "max_value")


@query("stream_dedup", "SELECT event_id, user_id, value FROM events")
def stream_dedup(spark, sf_dir):
    twice = _stream(spark, sf_dir, "events").unionByName(_stream(spark, sf_dir, "events"))
    kept = L.dedup(L.with_event_time(twice), ["event_id"]).select("event_id", "user_id", "value")
    return spark.read.parquet(L.run_to_path(lambda p: L.file_sink(kept, p), spark, "stream-unique"))


@query("feature_view_refresh", over_p(f"SELECT {ENCOUNTERS}, {ENGINEERED_TRAIN} FROM p"))
def feature_view_refresh(spark, sf_dir):
    store = FeatureStore(spark, L.fresh_path(spark, "feature-store"))
    store.create_entity("patient", ["patient_id"])
    store.create_view("encounter_features", feature_frame(X.baseline_slice(spark, sf_dir)), "patient")
    end = F.lit(X.BASELINE_END).cast("timestamp_ntz")
    arrived = X.patients_from(_stream(spark, sf_dir, "orders")).filter(F.col("ts") >= end)
    L.drain(store.refresh_view("encounter_features", "v1", feature_frame(arrived), refresh=None))
    return store.read_view("encounter_features")
