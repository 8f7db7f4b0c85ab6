"""Performance of a live model whose labels arrive late.

Predictions wait in state for their labels, bounded by a watermark on either side and the longest time a
label may take. A prediction leaves the state with its label, or without one when none can come any
more; both are counted, so it is known how much of a window the rates stand for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import metrics as M
from riskloom.sources.stored import PartTable
from riskloom.streaming.live import WATERMARK, _settled, fixed_window, read_windows, with_event_time


def labelled(
    predictions: DataFrame,
    labels: DataFrame,
    ids: list[str],
    label: str,
    ts: str = "ts",
    label_ts: str = "label_ts",
    wait: str = "7 days",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Two streams joined: predictions beside the label that came at most ``wait`` after them.

    ``label`` is NULL for a prediction whose label can't come any more. Labels that are NULL label nothing. A
    label that comes later than ``wait`` after its prediction, or behind the watermark, is not used. A prediction with
    several labels is there once for each of them.
    """
    ours = with_event_time(predictions, ts, watermark)
    known = labels.filter(F.col(label).isNotNull()).select(
        *[F.col(c).alias(f"_{c}") for c in ids], F.col(label), F.col(label_ts).alias("_labelled_at")
    )
    theirs = with_event_time(known, "_labelled_at", watermark)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in ids])
    in_time = F.col("_labelled_at").between(F.col(ts), F.col(ts) + F.expr(f"INTERVAL {wait}"))
    return ours.join(theirs, same & in_time, "left_outer").select(*predictions.columns, label)


def performance_sink(joined: DataFrame, path: str, label: str, predicted: str, ts: str = "ts", granularity: str = "day"):
    """Add what each trigger settles to the (window, actual, predicted) counts below ``path``.

    A trigger rewrites the windows it adds to; repeated, it adds to the state before it, so nothing counts twice.
    """
    spark = joined.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        table, start = PartTable(spark, path, "window_start"), fixed_window(ts, granularity)["start"]
        counts = M.pair_counts(batch.withColumn("window_start", start.cast("timestamp_ntz")), label, predicted, by=["window_start"])
        with _settled(counts) as added:
            if added.isEmpty():
                return
            before = table.read(before=batch_id)
            if before is not None:
                windows = added.select("window_start").distinct()
                both = before.join(windows, "window_start", "left_semi").unionByName(added)
                added = both.groupBy("window_start", "actual", "predicted").agg(F.sum("n").alias("n"))
            table.replace(added, batch_id)

    return joined.writeStream.outputMode("append").foreachBatch(write)


def live_performance(spark: SparkSession, path: str) -> DataFrame:
    """Per window the rates over its labelled predictions, as in the batch report, and how many have no label."""
    counts = read_windows(spark, path)
    rates = M.summary(counts.filter("actual IS NOT NULL"), by=["window_start"])
    missing = F.coalesce(F.sum(F.when(F.col("actual").isNull(), F.col("n"))), F.lit(0)).alias("n_unlabelled")
    return counts.groupBy("window_start").agg(missing).join(rates, "window_start", "left")
