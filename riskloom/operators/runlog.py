"""Run bookkeeping: step events rolled up to one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_log_rollup(
    events: DataFrame, run: str, step: str, kind: str, at: str, status: str, final_step: str
) -> DataFrame:
    """Start / end / skip events to one row per run.

    The total duration is that of the steps that have ended. A run is FAILED when any step failed, SUCCESS when its final step has ended, else RUNNING;
    it has an end time once it is no longer running. Events are first combined per (run, step),
    before and after the shuffle, so the per-run map holds one entry per distinct step however
    many events a run logs.
    """
    is_start, is_skip = F.col(kind) == "start", F.col(kind) == "skip"
    closing = F.col(kind).isin("end", "skip")
    steps = events.groupBy(F.col(run).alias("run_id"), F.col(step).alias("step")).agg(
        F.min(F.when(is_start | is_skip, F.col(at))).alias("start_time"),
        F.max(F.when(closing, F.col(at))).alias("end_time"),
        F.max_by(
            F.when(is_skip, F.lit("skipped")).otherwise(F.col(status)),
            F.when(closing, F.struct(F.col(at), F.col(status))),
        ).alias("last_status"),
        F.max(F.when((F.col(kind) == "end") & (F.col(status) == "failed"), 1).otherwise(0)).alias("failed"),
    )
    begun, ended_at = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("start_time", "end_time"))
    seconds = (ended_at - begun) / 1e6
    steps = steps.withColumn("status", F.coalesce("last_status", F.lit("running"))).withColumn(
        # a step that has not ended has no duration
        "duration_s",
        F.when(seconds.isNotNull(), F.floor(F.greatest(seconds, F.lit(0.0)) * 100 + 0.5) / 100.0),
    )
    ended = (F.col("step") == final_step) & F.col("end_time").isNotNull()
    entry = F.struct("step", F.struct("start_time", "end_time", "duration_s", "status").alias("info"))
    runs = steps.groupBy("run_id").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("last_end"),
        F.max("failed").alias("failed"),
        F.max(F.when(ended, 1).otherwise(0)).alias("final_ended"),
        F.count("*").alias("n_steps"),
        F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("total_duration_s"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("step_map"),
    )
    status_of_run = (
        F.when(F.col("failed") == 1, "FAILED").when(F.col("final_ended") == 1, "SUCCESS").otherwise("RUNNING")
    )
    return runs.select(
        "run_id",
        "start_time",
        F.when(status_of_run != "RUNNING", F.col("last_end")).alias("end_time"),
        status_of_run.alias("status"),
        "n_steps",
        "total_duration_s",
        F.to_json("step_map").alias("steps"),
    )
