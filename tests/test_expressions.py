"""Hand-computed rows at every rule edge."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import expressions as E
from riskloom.functions.whatif import perturb

NORMAL = {
    "age": 40,
    "bmi": 22.0,
    "heart_rate": 70,
    "systolic_bp": 120,
    "diastolic_bp": 80,
    "temperature": 37.0,
    "respiratory_rate": 16,
    "oxygen_saturation": 98.0,
    "glucose_level": 100.0,
    "creatinine": 1.0,
    "hemoglobin": 14.0,
    "wbc_count": 7.0,
    "comorbidity_count": 0,
    "previous_admissions": 0,
}
SCHEMA = ", ".join(f"{k} {'int' if isinstance(v, int) else 'double'}" for k, v in NORMAL.items())


def evaluate(spark, cases, column):
    rows = [tuple({**NORMAL, **case}.values()) for case in cases]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + SCHEMA)
    return [r[0] for r in frame.orderBy("i").select(column.alias("x"), "i").collect()]


@pytest.mark.parametrize(
    "rule, expected",
    [
        (E.bmi_category_train, ["UNDERWEIGHT", "NORMAL", "NORMAL", "OVERWEIGHT", "OBESE", "OBESE", "OBESE"]),
        (E.bmi_category_serve, ["UNDERWEIGHT", "UNDERWEIGHT", "NORMAL", "NORMAL", "OVERWEIGHT", "OBESE", "nan"]),
    ],
)
def test_bmi_edges(spark, rule, expected):
    values = [18.4, 18.5, 24.9, 25.0, 30.0, 35.0, None]
    assert evaluate(spark, [{"bmi": v} for v in values], rule()) == expected


def test_bmi_serve_outside(spark):
    values = [-1.0, 0.0, 35.1, 100.0, 100.1]
    got = evaluate(spark, [{"bmi": v} for v in values], E.bmi_category_serve())
    assert got == ["nan", "nan", "SEVERELY_OBESE", "SEVERELY_OBESE", "nan"]


@pytest.mark.parametrize(
    "name, values, train, serve",
    [
        ("heart_rate", [49, 50, 59, 60, 100, 101, None], [1, 0, 0, 0, 0, 1, 0], [1, 1, 1, 0, 0, 1, 0]),
        ("systolic_bp", [89, 90, 180, 181, None], [2, 0, 0, 2, 0], [2, 0, 0, 1, 0]),
        ("oxygen_saturation", [91.9, 92.0, 93.9, 94.0, 94.9, 95.0, None], [2, 1, 1, 1, 1, 0, 0], [2, 2, 2, 0, 0, 0, 0]),
        ("respiratory_rate", [20, 21, 24, 25, None], [0, 0, 0, 1, 0], [0, 1, 1, 1, 0]),
        ("temperature", [35.9, 36.0, 38.0, 38.1, 38.5, 38.6, None], [1, 0, 0, 0, 0, 1, 0], [0, 0, 0, 1, 1, 1, 0]),
    ],
)
def test_severity_edges(spark, name, values, train, serve):
    cases = [{name: v} for v in values]
    assert evaluate(spark, cases, E.severity_train()) == train
    assert evaluate(spark, cases, E.severity_serve()) == serve


@pytest.mark.parametrize(
    "name, values, points",
    [
        ("age", [64, 65, 74, 75], [0, 1, 1, 2]),
        ("glucose_level", [200.0, 200.1], [0, 1]),
        ("creatinine", [1.5, 1.6, 2.0, 2.1], [0, 1, 1, 2]),
        ("hemoglobin", [9.9, 10.0], [1, 0]),
        ("wbc_count", [3.9, 4.0, 12.0, 12.1], [1, 0, 0, 1]),
        ("comorbidity_count", [1, 2, 3, 4], [0, 1, 1, 2]),
        ("previous_admissions", [0, 1, 2, 3], [0, 1, 1, 2]),
    ],
)
def test_score_edges(spark, name, values, points):
    assert evaluate(spark, [{name: v} for v in values], E.risk_score()) == points


def test_score_bounds_and_labels(spark):
    worst = {
        "age": 80, "heart_rate": 120, "systolic_bp": 200, "temperature": 39.0, "respiratory_rate": 30,
        "oxygen_saturation": 80.0, "glucose_level": 300.0, "creatinine": 3.0, "hemoglobin": 8.0,
        "wbc_count": 15.0, "comorbidity_count": 5, "previous_admissions": 4,
    }
    assert evaluate(spark, [worst], E.risk_score()) == [18]
    scores = spark.createDataFrame([(s,) for s in (0, 2, 3, 5, 6, 8, 9, 18)], "s int")
    labels = [r[0] for r in scores.orderBy("s").select(E.risk_label("s")).collect()]
    assert labels == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]


def test_safe_ratio(spark):
    cases = [{"systolic_bp": v} for v in (140, 0, -5, None)]
    assert evaluate(spark, cases, E.safe_ratio("heart_rate", "systolic_bp")) == [0.5, None, None, None]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        evaluate(spark, [{"systolic_bp": 0}], E.safe_ratio("heart_rate", "systolic_bp", strict=True))


def test_clip_and_round(spark):
    values = spark.createDataFrame([(1, -3.0), (2, 2.25), (3, 2.35), (4, 99.0), (5, None)], "i int, x double")
    got = [tuple(r) for r in values.orderBy("i").select(E.clip_round("x", 0, 10, 1), E.clip_truncate("x", -2, 10)).collect()]
    assert got == [(0.0, -2), (2.3, 2), (2.4, 2), (10.0, 10), (None, None)]


def test_bucketize_rejects_wrong_label_count():
    with pytest.raises(ValueError):
        E.bucketize("x", [1.0], ["a"], closed="left")
    with pytest.raises(ValueError):
        E.bucketize("x", [1.0, 2.0], ["a", "b"], closed="right")


def test_perturb_limits(spark):
    rows = [(1, "E1", 95, 170, 215, 71.0), (2, "E2", 30, 100, 100, 98.0), (3, "E3", None, None, None, None)]
    frame = spark.createDataFrame(
        rows, "i int, encounter_id string, age int, heart_rate int, systolic_bp int, oxygen_saturation double"
    )
    aged = [r.age for r in perturb(frame, "age_shift").orderBy("i").collect()]
    assert aged == [100, 40, None]
    sick = perturb(frame, "vital_degradation").orderBy("i").collect()
    assert [(r.heart_rate, r.systolic_bp, r.oxygen_saturation) for r in sick] == [
        (180, 220, 70.0),
        (114, 110, 95.0),  # 100 * 1.15 is just below 115 in doubles
        (None, None, None),
    ]
    only_first = perturb(frame, "age_shift", when=F.col("i") == 1).orderBy("i").collect()
    assert [r.age for r in only_first] == [100, 30, None]
