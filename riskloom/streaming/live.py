"""Live tables: sources, stateless and stateful operators, and idempotent sinks.

Every sink may see a micro-batch again after a failure. The file sink keeps its own log; the
``foreachBatch`` sinks write each batch into a folder named after the batch id and overwrite it,
so a repeated batch replaces itself.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import alerts as A
from riskloom.operators import drift as R
from riskloom.operators.scoring import capture_log
from riskloom.sources.paths import exists, is_directory
from riskloom.sources.stored import KeyedTable, PartTable
from riskloom.workspace import fresh_path, small_frame, written

WATERMARK = "1 hour"
REFRESH = "1 minute"


def stream_source(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of ``<folder>/<name>`` as they land: a folder of parquet files, or a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if is_directory(spark, f"{folder}/{name}"):
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def with_event_time(stream: DataFrame, ts: str = "ts", watermark: str | None = WATERMARK) -> DataFrame:
    """Cast a zone-less time to an instant, as watermarks need, and set the watermark."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, watermark) if watermark else timed


def start(writer, checkpoint: str, refresh: str | None = REFRESH):
    """Start a query: every ``refresh`` interval, or once over what is there with ``refresh=None``."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)
    return writer.start()


def drain(query, seconds: int | None = None) -> None:
    """Wait for an available-now query, however long; raise when it failed or exceeded a given limit."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream still running after {seconds} s")


def _batches(path: str) -> Callable[[int], str]:
    return lambda batch_id: f"{path}/batch_id={batch_id}"


def file_sink(stream: DataFrame, path: str):
    """Append-only parquet with Spark's own exactly-once log."""
    return stream.writeStream.format("parquet").option("path", path).outputMode("append")


def append_sink(stream: DataFrame, path: str, columns: list[str] | None = None):
    """Append chosen columns with the time of ingestion, one folder per batch."""
    chosen = stream.select(*columns) if columns else stream
    target = _batches(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("ingested_at", F.current_timestamp()).write.mode("overwrite").parquet(target(batch_id))

    return chosen.writeStream.foreachBatch(write)


def capture_sink(scored: DataFrame, scored_path: str, log_path: str, prediction: str, **log_options):
    """Write every scored batch and, from the same rows, its inference log."""
    scored_target, log_target = _batches(scored_path), _batches(log_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(scored_target(batch_id))
            capture_log(batch, prediction, **log_options).write.mode("overwrite").parquet(log_target(batch_id))
        finally:
            batch.unpersist()

    return scored.writeStream.foreachBatch(write)


def window_counts(stream: DataFrame, keys: list[str], ts: str = "ts", width: str = "1 day") -> DataFrame:
    """Tumbling-window row counts; the stream carries event time and watermark."""
    return (
        stream.groupBy(F.window(ts, width).alias("_w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("_w.start").alias("window_start"), *keys, "n")
    )


def fixed_window(ts: str, granularity: str) -> Column:
    """The window of an event time, as the watermark knows it; a week begins on a Monday."""
    if granularity not in ("minute", "hour", "day", "week"):
        raise ValueError("a live window is a minute, an hour, a day or a week")
    return F.window(ts, f"1 {granularity}", startTime="4 days" if granularity == "week" else None)


def dedup(stream: DataFrame, ids: list[str]) -> DataFrame:
    """One row per record identity, with state kept only as long as the watermark."""
    return stream.dropDuplicatesWithinWatermark(ids)


@contextmanager
def _settled(batch: DataFrame):
    """A batch of an aggregate, computed once and in full.

    State is only saved when every partition has been read, and must not be updated twice by a
    result that uses the batch twice.
    """
    batch = batch.persist()
    try:
        batch.count()
        yield batch
    finally:
        batch.unpersist()


def _merged(table: PartTable, changed: DataFrame, step: int, measure: str = "n") -> DataFrame:
    """The changed windows whole: their stored rows, replaced where ``changed`` has new ones."""
    keys = [c for c in changed.columns if c != measure]
    old = table.read(before=step)
    if old is None:
        return changed
    windows = changed.select("window_start").distinct()
    beside = changed.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return old.join(windows, "window_start", "left_semi").join(beside, same, "left_anti").unionByName(changed)


def window_sink(counts: DataFrame, path: str):
    """Counts per window in update mode: a trigger rewrites the windows it changed, and no others.

    State lasts as long as the watermark; rows later than that are dropped.
    """
    spark = counts.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        table = PartTable(spark, path, "window_start")
        with _settled(batch) as changed:
            if not changed.isEmpty():
                table.replace(_merged(table, changed, batch_id), batch_id)

    return counts.writeStream.outputMode("update").foreachBatch(write)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """All windows that a window sink (or a report sink, below ``report``) has written."""
    found = PartTable(spark, path, "window_start").read()
    if found is None:
        raise LookupError(f"no finished batch below {path}")
    return found


class LiveDrift:
    """Drift of a stream against a frozen baseline.

    Edges and baseline counts are fixed before the stream starts: the edges become literals of
    the streaming plan, the counts a small table. With ``store`` both are kept below that path, and
    a later process that names it goes on with them, whatever its baseline holds by then. The
    stream keeps one count per (window, segment, column, bin) as long as the watermark; finished
    windows are only in the stored tables.
    """

    def __init__(
        self, baseline: DataFrame, numeric=(), categorical=(), segments=(), granularity: str = "day", ts: str = "ts", store: str | None = None
    ):
        self.spark, self.ts, self.granularity = baseline.sparkSession, ts, granularity
        self.categorical, self.segments = list(categorical), list(segments)
        if store and exists(self.spark, f"{store}/edges/_SUCCESS"):
            kept = json.loads(self.spark.read.parquet(f"{store}/edges").head()["edges"])
            self.edges = R.Edges(kept["ranges"], kept["cuts"], kept["bins"])
            self.expected = self.spark.read.parquet(f"{store}/counts")
            return
        self.edges = R.fit_edges(baseline, list(numeric))
        frozen = R.bin_counts(baseline, self.edges, self.categorical, self.segments)
        if not store:
            self.expected = written(self.spark, frozen, "baseline-counts")
            return
        frozen.write.mode("overwrite").parquet(f"{store}/counts")
        text = json.dumps({"ranges": self.edges.ranges, "cuts": self.edges.cuts, "bins": self.edges.bins})
        small_frame(self.spark, [(text,)], "edges string").coalesce(1).write.mode("overwrite").parquet(f"{store}/edges")
        self.expected = self.spark.read.parquet(f"{store}/counts")

    def counts(self, stream: DataFrame) -> DataFrame:
        """The streaming aggregate; the only stateful operator of the query."""
        fine = R.fine_counts(
            stream, self.edges, self.categorical, self.segments, by={"_w": fixed_window(self.ts, self.granularity)}
        )
        return fine.select(F.col("_w.start").alias("window_start"), *[c for c in fine.columns if c != "_w"])

    def metrics(self, counts: DataFrame) -> DataFrame:
        counts = counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
        return R.drift_from_counts(self.expected, counts, by=["window_start"])

    def _report(self, changed: DataFrame, path: str, batch_id: int) -> None:
        """Take the changed counts in and write the metrics of their windows."""
        table = PartTable(self.spark, f"{path}/counts", "window_start")
        table.replace(_merged(table, changed, batch_id), batch_id)
        windows = changed.select("window_start").distinct()
        whole = table.read().join(windows, "window_start", "left_semi")
        PartTable(self.spark, f"{path}/report", "window_start").replace(self.metrics(whole), batch_id)

    def report_sink(self, stream: DataFrame, path: str):
        """Metrics per window below ``path/report``; a trigger rewrites the windows it changed."""

        def write(batch: DataFrame, batch_id: int) -> None:
            with _settled(batch) as changed:
                if not changed.isEmpty():
                    self._report(changed, path, batch_id)

        return self.counts(stream).writeStream.outputMode("update").foreachBatch(write)

    def alert_sink(self, stream: DataFrame, rules: DataFrame, path: str, since: Column, until: Column, every: int = 1):
        """Keep the report, and evaluate the rules on it every ``every`` batches.

        An alert is reported once: below ``path/alerts`` is one keyed table of all that fired.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            with _settled(batch) as changed:
                if not changed.isEmpty():
                    self._report(changed, path, batch_id)
            report = PartTable(self.spark, f"{path}/report", "window_start").read()
            if batch_id % every or report is None:
                return
            table = KeyedTable(self.spark, f"{path}/alerts", ["alert_name"], ["max_value"])
            current, earlier = A.evaluate_alerts(R.to_long(report), rules, since, until), table.read(before=batch_id)
            new = A.new_alerts(current, earlier) if earlier is not None else current.filter("fired")
            if earlier is None or not new.isEmpty():
                table.merge(new, version=batch_id)

        return self.counts(stream).writeStream.outputMode("update").foreachBatch(write)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts an alert sink has reported."""
    found = KeyedTable(spark, f"{path}/alerts", ["alert_name"], ["max_value"]).read()
    if found is None:
        raise LookupError(f"no finished batch below {path}")
    return found


def run_to_path(make_writer: Callable[[str], object], spark: SparkSession, label: str) -> str:
    """Run a sink once over all available input, with its own path and checkpoint."""
    path = fresh_path(spark, label)
    drain(start(make_writer(path), fresh_path(spark, label + "-checkpoint"), refresh=None))
    return path
