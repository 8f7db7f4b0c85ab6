"""Classification metrics.

One shuffle counts (actual, predicted) pairs; everything else is arithmetic over at most k x k
rows per group. ``by`` adds group columns (a time window, a segment) to any of them.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import surrogate_id
from riskloom.workspace import small_frame, written

SCALARS = [
    "accuracy",
    "precision_macro",
    "recall_macro",
    "f1_macro",
    "precision_weighted",
    "recall_weighted",
    "f1_weighted",
]
_EPS = sys.float_info.epsilon
MAX_LABELS = 1_000


def _nll(actual: str, probabilities: dict[str, str]) -> Column:
    """-ln of the probability given to the actual label, clipped away from 0 and 1."""
    chain = F
    for label, column in probabilities.items():
        chain = chain.when(F.col(actual) == label, F.col(column))
    p = chain.otherwise(F.lit(0.0))
    return -F.log(F.greatest(F.lit(_EPS), F.least(F.lit(1.0 - _EPS), p)))


def pair_counts(
    df: DataFrame, actual: str, predicted: str, by: list[str] = (), probabilities: dict | None = None
) -> DataFrame:
    """(by..., actual, predicted, n [, nll]): the base of all metrics."""
    measures = [F.count("*").alias("n")]
    if probabilities:
        measures.append(F.sum(_nll(actual, probabilities)).alias("nll"))
    return df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(*measures)


def confusion_matrix(counts: DataFrame, by: list[str] = (), limit: int = MAX_LABELS) -> DataFrame:
    """Counts for every pair of labels seen on either side, zeros included, in long form.

    A NULL is a label like others. The result has k x k rows per group by nature, so more than
    ``limit`` labels are an error. ``counts`` is read once: its rows become one array per group.
    """
    cells = counts.groupBy(*by).agg(F.collect_list(F.struct("actual", "predicted", F.col("n").cast("bigint").alias("n"))).alias("cells"))
    sides = F.concat(F.transform("cells", lambda c: c["actual"]), F.transform("cells", lambda c: c["predicted"]))
    labels = F.array_distinct(sides)
    labels = F.when(F.size(labels) <= limit, labels).otherwise(F.raise_error(F.lit(f"over {limit} labels")))
    zero = F.lit(0).cast("bigint")
    grid = F.flatten(
        F.transform(
            "labels",
            lambda a: F.transform("labels", lambda p: F.struct(a.alias("actual"), p.alias("predicted"), zero.alias("n"))),
        )
    )
    return (
        cells.withColumn("labels", labels)
        .select(*by, F.inline(F.concat(grid, F.col("cells"))))
        .groupBy(*by, "actual", "predicted")
        .agg(F.sum("n").alias("n"))
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def label_tallies(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by..., label, support, n_predicted, hits) for labels present on either side."""
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), none.alias("n_predicted"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), F.col("n").alias("n_predicted"), none.alias("hits")),
    )
    return (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "n_predicted", "hits")])
    )


def _prf(tallies: DataFrame, keep: list[str]) -> DataFrame:
    hits, predicted, support = F.col("hits"), F.col("n_predicted"), F.col("support")
    return tallies.select(
        *keep,
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, predicted + support).alias("f1"),
        "support",
    )


def per_label_prf(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    return _prf(label_tallies(counts, by), [*by, "label"])


def per_class_prf(counts: DataFrame, labels: list[str]) -> DataFrame:
    """Precision, recall, F1 and support for the given labels; an absent label gives zeros."""
    given = small_frame(counts.sparkSession, [(name,) for name in labels], "label string")
    tallies = given.join(label_tallies(counts), "label", "left").fillna(0)
    return _prf(tallies, ["label"])


def summary(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted precision / recall / F1, and the row count."""
    support = F.col("support").cast("double")
    rates = per_label_prf(counts, by)
    averaged = rates.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[
            _ratio(F.sum(F.col(m) * support), F.sum(support)).alias(f"{m}_weighted")
            for m in ("precision", "recall", "f1")
        ],
        # hits = recall * support, so the share of right answers is the weighted recall
        _ratio(F.sum(F.col("recall") * support), F.sum(support)).alias("accuracy"),
        F.sum("support").alias("test_size"),
    )
    return averaged.select(*by, *SCALARS, "test_size")


def accuracy(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    equal = F.when(F.col(actual) == F.col(predicted), 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(F.avg(equal).alias("accuracy"))


def macro_prf(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    return summary(counts, by).select(*by, "precision_macro", "recall_macro", "f1_macro")


def weighted_prf(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    return summary(counts, by).select(*by, "precision_weighted", "recall_weighted", "f1_weighted")


def log_loss(df: DataFrame, actual: str, probabilities: dict[str, str], by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(_nll(actual, probabilities)).alias("log_loss"))


def support(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("support"))


def share_of_total(df: DataFrame, groups: list[str], digits: int = 1) -> DataFrame:
    """Count and percentage of the whole per group, rounded half up to ``digits``."""
    counted = df.groupBy(*groups).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    percent = F.col("n").cast("double") * 100.0 / total.cast("double")
    scale = float(10**digits)
    return counted.select(*groups, "n", (F.floor(percent * scale + 0.5).cast("double") / scale).alias("pct"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(label, "n", (F.col("n").cast("double") / total.cast("double")).alias("share"))


def group_counts(df: DataFrame, *groups) -> DataFrame:
    return df.groupBy(*groups).agg(F.count("*").alias("n"))


def group_means(df: DataFrame, groups: list[str], digits: dict[str, int]) -> DataFrame:
    """Rounded mean per group; ``digits`` maps column -> decimals."""
    means = []
    for name, places in digits.items():
        scale = float(10**places)
        mean = F.floor(F.avg(F.col(name).cast("double")) * scale + 0.5).cast("double") / scale
        means.append(mean.alias(f"avg_{name}"))
    return df.groupBy(*groups).agg(*means)


def batch_distribution(df: DataFrame, batch: str, predicted: str) -> DataFrame:
    """Prediction counts per batch beside the running row total.

    The counts are range-partitioned by batch and written: running totals are summed inside each
    range, and the totals of the ranges before are carried in (one row per range).
    """
    counts = df.groupBy(batch, predicted).agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange(batch).withColumn("_range", F.spark_partition_id())
    ranged = written(df.sparkSession, ranged, "batch-counts")
    # by value, so all rows of one batch get its total
    so_far = Window.partitionBy("_range").orderBy(batch).rangeBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.sum("n").alias("_size"))
    carried = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_carry"))
    running = (F.sum("n").over(so_far) + F.col("_carry")).alias("running_total")
    return ranged.join(carried, "_range").select(batch, predicted, "n", running)


def metrics_to_long(
    df: DataFrame,
    actual: str,
    predicted: str,
    model_name: str,
    model_version: str,
    evaluated_at: Column,
    probabilities: dict | None = None,
    labels: list[str] | None = None,
) -> DataFrame:
    """The metric log: scalar metrics, per-label metrics and the matrix as JSON, one row each.

    The pair counts are written once (k x k rows), so the predictions are read by one scan.
    """
    counts = written(df.sparkSession, pair_counts(df, actual, predicted, probabilities=probabilities), "pair-counts")
    scalars = summary(counts).withColumn("test_size", F.col("test_size").cast("double"))
    names = [*SCALARS, "test_size"]
    long = [scalars.unpivot([], names, "metric_name", "metric_value")]
    if probabilities:
        long.append(
            counts.agg((F.sum("nll") / F.sum("n")).alias("metric_value")).select(
                F.lit("log_loss").alias("metric_name"), "metric_value"
            )
        )
    per_label = per_class_prf(counts, labels) if labels else per_label_prf(counts)
    per_label = per_label.withColumn("support", F.col("support").cast("double"))
    long.append(
        per_label.unpivot(["label"], ["precision", "recall", "f1", "support"], "m", "metric_value").select(
            F.concat_ws("_", "label", "m").alias("metric_name"), "metric_value"
        )
    )
    rows = reduce(DataFrame.unionByName, long).withColumn("metric_details", F.lit(None).cast("string"))
    cells = confusion_matrix(counts)
    lines = cells.groupBy("actual").agg(
        F.array_sort(F.collect_list(F.struct("predicted", "n"))).getField("n").alias("line")
    )
    matrix = lines.agg(F.array_sort(F.collect_list(F.struct("actual", "line"))).getField("line").alias("m"))
    rows = rows.unionByName(
        matrix.select(
            F.lit("confusion_matrix").alias("metric_name"),
            F.lit(None).cast("double").alias("metric_value"),
            F.to_json("m").alias("metric_details"),
        )
    )
    return rows.select(
        surrogate_id([F.lit(model_name), F.lit(model_version), evaluated_at, "metric_name"], "M").alias("metric_id"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        "metric_name",
        "metric_value",
        "metric_details",
        evaluated_at.alias("evaluated_at"),
    )


def promotion_check(long_metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """One row per threshold plus the row ``overall``.

    A metric that is missing fails with reason ``metric_not_found``.
    """
    spark = long_metrics.sparkSession
    wanted = small_frame(spark, list(thresholds.items()), "metric_name string, threshold double")
    actual = long_metrics.select("metric_name", F.col("metric_value").alias("actual"))
    checks = wanted.join(actual, "metric_name", "left").select(
        "metric_name",
        "threshold",
        "actual",
        F.coalesce(F.col("actual") >= F.col("threshold"), F.lit(False)).alias("passed"),
        F.when(F.col("actual").isNull(), "metric_not_found").alias("reason"),
    )
    overall = checks.agg(F.bool_and("passed").alias("passed")).select(
        F.lit("overall").alias("metric_name"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(None).cast("double").alias("actual"),
        "passed",
        F.lit(None).cast("string").alias("reason"),
    )
    return checks.unionByName(overall)


def best_trial(results: DataFrame, metric: str, mode: str, id_col: str) -> DataFrame:
    """The best row, ties to the smallest id: two rows per task reach the merge at most."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    order = F.col(metric).desc_nulls_last() if mode == "max" else F.col(metric).asc_nulls_last()
    return results.orderBy(order, F.col(id_col).asc()).limit(1)


def best_trial_per_job(results: DataFrame, job: str, metric: str, mode: str, id_col: str) -> DataFrame:
    """The best row of every job, combined before the shuffle."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    rest = [c for c in results.columns if c != job]
    score = F.col(metric) if mode == "max" else -F.col(metric)
    best = F.min_by(F.struct(*rest), F.struct((-score).alias("s"), F.col(id_col).alias("i")))
    return (
        results.filter(F.col(metric).isNotNull())
        .groupBy(job)
        .agg(best.alias("_row"))
        .select(job, "_row.*")
        .select(*results.columns)
    )
