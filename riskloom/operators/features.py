"""Engineered encounter features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.functions import expressions as E


def feature_frame(
    raw: DataFrame, severity: str = "train", bmi: str = "train", strict_ratio: bool = False
) -> DataFrame:
    """All input columns plus the four engineered ones, in a single projection.

    ``severity`` and ``bmi`` pick the training-side or the serving-side rule set. The shock
    index is NULL where the pressure is not positive, or a plain division with ``strict_ratio``.
    """
    severities = {"train": E.severity_train, "serve": E.severity_serve}
    categories = {"train": E.bmi_category_train, "serve": E.bmi_category_serve}
    return raw.select(
        "*",
        E.safe_ratio("heart_rate", "systolic_bp", strict=strict_ratio).alias("shock_index"),
        E.difference("systolic_bp", "diastolic_bp").alias("pulse_pressure"),
        categories[bmi]().alias("bmi_category"),
        severities[severity]().alias("vital_signs_severity"),
    )
