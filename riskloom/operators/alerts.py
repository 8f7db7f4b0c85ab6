"""Alert rules over drift metrics, their history, and the retrain signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.joins import new_only
from riskloom.operators.selection import latest_per_key
from riskloom.workspace import small_frame

RULE_SCHEMA = "alert_name string, column string, metric string, threshold double"


def rules_frame(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return small_frame(spark, rules, RULE_SCHEMA)


def evaluate_alerts(metrics: DataFrame, rules: DataFrame, since: Column, until: Column) -> DataFrame:
    """Whether each rule fires: the largest overall value in [since, until) exceeds its threshold.

    ``metrics`` is the long drift report with ``window_start``. A rule without any value in the
    range does not fire. Values are reduced to one per (column, metric) before they meet the
    rules.
    """
    recent = metrics.filter(
        (F.col("segment_column") == "__all__") & (F.col("window_start") >= since) & (F.col("window_start") < until)
    )
    worst = recent.groupBy("column", "metric").agg(F.max("metric_value").alias("max_value"))
    return rules.join(worst, ["column", "metric"], "left").select(
        "alert_name",
        "column",
        "metric",
        "threshold",
        "max_value",
        F.coalesce(F.col("max_value") > F.col("threshold"), F.lit(False)).alias("fired"),
    )


def watched_metrics(
    baseline: DataFrame,
    live: DataFrame,
    rules: list[tuple],
    numeric: list[str],
    categorical: list[str],
    since: Column,
    until: Column,
    granularity: str,
    ts: str = "ts",
) -> DataFrame:
    """The long drift report that a list of rules needs: only its columns, only its time range.

    The range is a plain comparison on the event time, so it reaches the scan. It holds every window
    that starts in [since, until) whole; ``evaluate_alerts`` leaves out a window cut by ``since``.
    """
    from riskloom.operators.drift import drift_report

    wanted = {column for _, column, _, _ in rules}
    end = until + F.expr(f"INTERVAL 1 {granularity}")
    recent = live.filter((F.col(ts) >= since) & (F.col(ts) < end))
    return drift_report(
        baseline, recent, [c for c in numeric if c in wanted], [c for c in categorical if c in wanted], granularity=granularity, ts=ts
    )


def alert_history(history: DataFrame, since: Column, names: list[str] | None = None, at: str = "triggered_at") -> DataFrame:
    """Evaluations since a time, newest first, for all alerts or the named ones."""
    kept = history.filter(F.col(at) >= since)
    if names is not None:
        kept = kept.filter(F.col("alert_name").isin(*names))
    return kept.orderBy(F.col(at).desc(), "alert_name")


def alert_status(asked: DataFrame, rules: DataFrame, history: DataFrame) -> DataFrame:
    """State, column, schedule and last firing per asked alert; an unknown name has state ERROR."""
    last = latest_per_key(history.select("alert_name", "triggered_at"), ["alert_name"], ["triggered_at"])
    known = rules.select("alert_name", "column", "schedule", F.col("state").alias("_state"))
    return (
        asked.select("alert_name")
        .distinct()
        .join(known, "alert_name", "left")
        .join(last, "alert_name", "left")
        .select(
            "alert_name",
            F.coalesce("column", F.lit("N/A")).alias("column"),
            F.coalesce("schedule", F.lit("N/A")).alias("schedule"),
            F.when(F.col("_state").isNull(), "ERROR: unknown alert").otherwise(F.col("_state")).alias("state"),
            F.col("triggered_at").alias("last_triggered"),
        )
    )


def new_alerts(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Fired alerts not reported before."""
    return new_only(current.filter("fired"), seen, ["alert_name"])


def retrain_signal(alerts: DataFrame, job: str = "feature_engineering") -> DataFrame:
    """One row naming the job to run again when any rule fired, no row otherwise."""
    fired = F.col("fired")
    return (
        alerts.agg(
            F.bool_or(fired).alias("retrain"),
            F.count_if(fired).alias("n_fired"),
            F.max(F.when(fired, F.col("max_value"))).alias("worst_value"),
        )
        .filter(F.col("retrain"))
        .select(F.lit(job).alias("job"), "n_fired", "worst_value")
    )


MONITOR_COLUMNS = [
    "monitor_name",
    "model_name",
    "model_version",
    "source",
    "baseline",
    "prediction_column",
    "segment_columns",
]


def create_monitors(catalog: DataFrame, wanted: DataFrame, order: list[str]) -> DataFrame:
    """Add monitor definitions by name; one that exists stays, and the first of several new ones wins."""
    rest = [c for c in wanted.columns if c != "monitor_name"]
    first = (
        wanted.groupBy("monitor_name")
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select("monitor_name", "_row.*")
        .select(*catalog.columns)
    )
    return catalog.unionByName(new_only(first, catalog, ["monitor_name"]))


def drop_monitors(catalog: DataFrame, names: DataFrame) -> DataFrame:
    return new_only(catalog, names, ["monitor_name"])


def monitor_status(catalog: DataFrame, asked: DataFrame) -> DataFrame:
    known = catalog.select("monitor_name", F.lit("active").alias("status"))
    return (
        asked.select("monitor_name")
        .distinct()
        .join(known, "monitor_name", "left")
        .select("monitor_name", F.coalesce("status", F.lit("not_found")).alias("status"))
    )
