"""Scoring tables and streams, and the inference log."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import MODEL_CATEGORICAL, MODEL_FEATURES, MODEL_NUMERIC
from riskloom.functions.expressions import record_hash, risk_label, risk_score
from riskloom.functions.payload import json_extract, json_pack

ERROR = "ERROR"
RULE_INPUTS = [
    "age",
    "heart_rate",
    "systolic_bp",
    "temperature",
    "oxygen_saturation",
    "respiratory_rate",
    "glucose_level",
    "creatinine",
    "hemoglobin",
    "wbc_count",
    "comorbidity_count",
    "previous_admissions",
]


def class_probabilities(scored: DataFrame) -> Column:
    """Probabilities as an array, in the model's class order.

    A one-vs-rest model has none, only one margin per class: each gives the probability of its class
    against the rest (the logistic loss of the boosters is in twice the margin), and these are
    normalised to a sum of one.
    """
    from pyspark.ml.functions import vector_to_array

    if "probability" in scored.columns:
        return vector_to_array("probability")
    single = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    total = F.aggregate(single, F.lit(0.0), lambda a, p: a + p)
    return F.transform(single, lambda p: F.when(total > 0, p / total).otherwise(1.0 / F.size(single)))


def score_batch(model, df: DataFrame, keep: list[str], output: str = "predicted_risk", probabilities: dict | None = None) -> DataFrame:
    """Model predictions beside the kept columns; probability columns where asked for.

    ``probabilities`` maps label -> position in the model's class order.
    """
    scored = model.transform(df)
    extra = []
    if probabilities:
        vector = class_probabilities(scored)
        extra = [vector.getItem(i).alias(f"p_{label.lower()}") for label, i in probabilities.items()]
    return scored.select(*keep, F.col("predicted_label").alias(output), *extra)


def score_rules(df: DataFrame, output: str = "predicted_risk") -> DataFrame:
    """The rule score as the model: same shape as ``score_batch``, exact result."""
    return df.withColumn(output, risk_label(risk_score()))


def score_or_error(df: DataFrame, prediction: Column, required: list[str], output: str = "predicted_risk") -> DataFrame:
    """Rows that lack a required input get ``ERROR``; the others are scored as usual."""
    unusable = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.withColumn(output, F.when(unusable, F.lit(ERROR)).otherwise(prediction))


def score_with_function(
    df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], inputs: list[str], output: str, kind: str = "string"
) -> DataFrame:
    """Score with a foreign model: ``predict`` gets Arrow batches as pandas frames.

    The batches keep partitioning and row order; nothing is shuffled.
    """

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield predict(batch)

    return df.withColumn(output, run(F.struct(*inputs)))


# ------------------------------------------------------------------ inference log


def capture_log(
    scored: DataFrame,
    prediction: str,
    ts: str = "ts",
    features: list[str] = MODEL_FEATURES,
    prefix: str = "serving",
    function_name: str | Column = "predict",
    keep: list[str] = (),
) -> DataFrame:
    """Request and response as one JSON object per row, under dotted keys below ``prefix``."""
    function_name = F.lit(function_name) if isinstance(function_name, str) else function_name
    fields = {f"{prefix}.request.data.{name.upper()}": F.col(name) for name in features}
    fields[f"{prefix}.response.data.output_feature_0"] = F.col(prediction)
    fields[f"{prefix}.function.name"] = function_name
    return scored.select(*keep, F.col(ts).alias("ts"), json_pack(fields).alias("record_attributes"))


def flatten_log(
    log: DataFrame,
    prefix: str = "serving",
    numeric: list[str] = MODEL_NUMERIC,
    categorical: list[str] = MODEL_CATEGORICAL,
    keep: list[str] = (),
) -> DataFrame:
    """The flat typed view of a log: predict calls only, one column per feature, record id."""
    fields = {name: (f"{prefix}.request.data.{name.upper()}", "double") for name in numeric}
    fields |= {name: (f"{prefix}.request.data.{name.upper()}", "string") for name in categorical}
    fields["risk_level"] = (f"{prefix}.response.data.output_feature_0", "string")
    fields["_function"] = (f"{prefix}.function.name", "string")
    record_id = record_hash("ts", "record_attributes").alias("record_id")
    return (
        json_extract(log, "record_attributes", fields, keep=[*keep, record_id, "ts"])
        .filter("_function = 'predict'")
        .drop("_function")
    )
