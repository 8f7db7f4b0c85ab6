"""Preprocessing against numpy; models by quality, not by exact value."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.constants import MODEL_CATEGORICAL, MODEL_NUMERIC
from riskloom.operators import metrics as M
from riskloom.operators import preprocess as R
from riskloom.operators import scoring as C
from riskloom.operators import search as H
from riskloom.operators import training as T
from riskloom.operators.features import feature_frame
from riskloom.operators.selection import hash_split
from riskloom.sources import fixtures as X
from riskloom.streaming import live as L
from riskloom.workspace import fresh_path


@pytest.fixture(scope="module")
def split(spark, sf_dir):
    return hash_split(feature_frame(X.patients(spark, sf_dir)), ["patient_id"])


def test_split_is_disjoint_and_complete(spark, sf_dir, split):
    train, test = split
    assert train.count() + test.count() == X.patients(spark, sf_dir).count()
    assert train.join(test, "patient_id", "left_semi").count() == 0


def test_preprocessor_vector(spark):
    rows = [(1.0, "a"), (2.0, "b"), (6.0, None), (None, "a"), (float("nan"), "c")]
    train = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x double, c string")
    fitted = R.fit_preprocessor(train, ["x"], ["c"])
    odd = spark.createDataFrame([(0, 8.0, "new"), (1, None, None)], "i int, x double, c string")
    got = [np.array(r.features.toArray()) for r in fitted.transform(odd).orderBy("i").collect()]
    filled = np.array([1.0, 2.0, 6.0, 2.0, 2.0])
    scale = lambda v: (v - filled.mean()) / filled.std()
    np.testing.assert_allclose(got[0], [scale(8.0), 0, 0, 0, 0])  # unseen: all zeros
    np.testing.assert_allclose(got[1], [scale(2.0), 1, 0, 0, 0])  # 'Unknown' sorts before a, b, c


def test_cardinality_guard(spark):
    frame = spark.createDataFrame([(str(i),) for i in range(50)], "c string")
    with pytest.raises(ValueError, match="too many categories"):
        R.check_cardinality(frame, ["c"], limit=10)


def test_metrics_by_hand(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    counts = M.pair_counts(spark.createDataFrame(pairs, "y string, p string"), "y", "p")
    rates = {r.label: (r.precision, r.recall, r.f1, r.support) for r in M.per_label_prf(counts).collect()}
    assert rates["a"] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert rates["b"] == (pytest.approx(1 / 3), 1.0, 0.5, 1)
    assert rates["c"] == (0.0, 0.0, 0.0, 1)
    one = M.summary(counts).head()
    assert one.accuracy == 0.5 and one.test_size == 4
    assert one.f1_macro == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    cells = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(counts).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4 and cells["b", "c"] == 0


def test_promotion(spark):
    metrics = spark.createDataFrame([("accuracy", 0.8), ("f1_macro", 0.7)], "metric_name string, metric_value double")
    good = M.promotion_check(metrics, {"accuracy": 0.8})
    assert {r.metric_name: r.passed for r in good.collect()} == {"accuracy": True, "overall": True}
    bad = M.promotion_check(metrics, {"accuracy": 0.8, "f1_macro": 0.75, "auc": 0.1})
    assert {r.metric_name: (r.passed, r.reason) for r in bad.collect()} == {
        "accuracy": (True, None),
        "f1_macro": (False, None),
        "auc": (False, "metric_not_found"),
        "overall": (False, None),
    }


def test_forest_registry_and_stream_scoring(spark, sf_dir, split):
    train, test = split
    model = T.train_forest(train, MODEL_NUMERIC, MODEL_CATEGORICAL, num_trees=10, max_depth=6)
    quality = T.evaluate(model, test, "risk_level").head()
    assert quality.accuracy >= 0.8 and quality.f1_macro >= 0.75
    registry = T.ModelRegistry(spark, fresh_path(spark, "models"))
    for version in ("v_1", "v_2"):
        registry.register(model, "risk", version, json.dumps({"accuracy": quality.accuracy}))
    assert registry.state().head().default_version == "v_2"
    registry.set_default("risk", "v_1", "2024-01-01")
    assert registry.state().head().default_version == "v_1"
    with pytest.raises(LookupError):
        registry.set_default("risk", "v_9", "2024-01-02")
    loaded = registry.load("risk")
    kept = ["encounter_id", "risk_level"]
    scored = C.score_batch(loaded, test, kept, probabilities={"CRITICAL": 0, "HIGH": 1, "LOW": 2, "MEDIUM": 3})
    total = F.col("p_critical") + F.col("p_high") + F.col("p_low") + F.col("p_medium")
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    orders = L.stream_source(spark, sf_dir, "orders.parquet", X.table(spark, sf_dir, "orders").schema)
    live = C.score_batch(loaded, feature_frame(X.patients_from(orders)), kept)
    path = L.run_to_path(lambda p: L.file_sink(live, p), spark, "scored")
    streamed = spark.read.parquet(path)
    again = streamed.join(scored.select("encounter_id", F.col("predicted_risk").alias("batch")), "encounter_id")
    assert again.count() == test.count()
    assert again.filter("predicted_risk <> batch").count() == 0


def test_search_scores_and_failed_trials(spark, split):
    train, test = split
    space = {
        "n_estimators": {"type": "choice", "values": [2, 3]},
        "max_depth": {"type": "grid_search", "values": [3, 99]},  # 99 is beyond what Spark allows
    }
    found = H.run_search(
        train, test, MODEL_NUMERIC, MODEL_CATEGORICAL, "risk_level", space, num_samples=1, estimator="forest"
    )
    scores = {json.loads(r.params)["max_depth"]: r.score for r in found.collect()}
    assert scores[99] == 0.0 and scores[3] > 0.3
    row = H.search_result_row(found, "job", "f1_macro", F.lit("now")).head()
    assert json.loads(row.best_params)["max_depth"] == 3 and row.best_score == scores[3]
    with pytest.raises(ValueError, match="unknown search-space type"):
        H.sample_space(spark.range(1), "id", {"x": {"type": "normal"}})


def test_halving(spark, split):
    train, test = split
    space = {"max_depth": {"type": "randint", "lower": 2, "upper": 6}}
    found = H.run_halving(
        train, test, MODEL_NUMERIC, MODEL_CATEGORICAL, "risk_level", space, num_samples=4, max_trees=2
    )
    per_rung = {r.rung: r.n for r in found.groupBy("rung").agg(F.count("*").alias("n")).collect()}
    assert per_rung[1] == 4 and 1 <= per_rung[2] <= 3


def test_halving_promote_per_rung(spark):
    rows = [(i, 1, float(i)) for i in range(8)] + [(i, 2, float(-i)) for i in range(4)]
    frame = spark.createDataFrame(rows, "trial int, rung int, score double")
    best = H.halving_promote(frame, "rung", "score", factor=4).filter("promoted")
    assert sorted((r.rung, r.trial) for r in best.collect()) == [(1, 6), (1, 7), (2, 0)]
    low = H.halving_promote(frame, "rung", "score", factor=4, mode="min").filter("promoted")
    assert sorted((r.rung, r.trial) for r in low.collect()) == [(1, 0), (1, 1), (2, 3)]


def test_long_projections_stay_compiled(spark):
    """A session without a method limit gets that of the package when a train set is prepared; one that has a limit keeps it."""
    from riskloom.session import SETTINGS, prefer_split_methods

    key = "spark.sql.codegen.hugeMethodLimit"
    try:
        spark.conf.unset(key)
        frame = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(20)], "x double, y string")
        T.TrainingFrame(frame, ["x"], [], "y").close()
        assert spark.conf.get(key) == SETTINGS[key]
        spark.conf.set(key, "9000")
        prefer_split_methods(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, SETTINGS[key])
