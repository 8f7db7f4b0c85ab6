"""Queries over preprocessing, training, search and scoring."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.constants import MODEL_CATEGORICAL, MODEL_NUMERIC, PROMOTION_THRESHOLDS, RISK_LABELS, SEARCH_SPACE
from riskloom.functions.expressions import risk_label, risk_score
from riskloom.operators import metrics as M
from riskloom.operators import preprocess as R
from riskloom.operators import scoring as C
from riskloom.operators import search as H
from riskloom.operators import training as T
from riskloom.operators.features import feature_frame
from riskloom.operators.selection import hash_split
from riskloom.plans.registry import query
from riskloom.plans.sql import D, ENGINEERED_SERVE, label, over_p, over_pn, over_pr
from riskloom.sources import fixtures as X
from riskloom.workspace import fresh_path


def _round(df, columns: list[str], digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ------------------------------------------------------------------ preprocessing


@query(
    "median_impute",
    over_pn(
        """SELECT encounter_id, coalesce(glucose_level, (SELECT median(glucose_level) FROM pn)) AS glucose_level,
             coalesce(bmi, (SELECT median(bmi) FROM pn)) AS bmi,
             CAST(age AS DOUBLE) AS age FROM pn"""
    ),
)
def median_impute(spark, sf_dir):
    gaps = X.patients_with_gaps(spark, sf_dir).select("encounter_id", "glucose_level", "bmi", "age")
    return R.median_impute(gaps, ["glucose_level", "bmi", "age"])


@query("constant_impute", over_pn("SELECT encounter_id, coalesce(gender, 'Unknown') AS gender FROM pn"))
def constant_impute(spark, sf_dir):
    return R.constant_impute(X.patients_with_gaps(spark, sf_dir).select("encounter_id", "gender"), ["gender"])


_SCALED = ["age", "bmi", "heart_rate", "glucose_level", "creatinine"]


@query(
    "standard_scale",
    over_p(
        "SELECT encounter_id, "
        + ", ".join(
            f"round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM p)) "
            f"/ (SELECT stddev_pop(CAST({c} AS DOUBLE)) FROM p), 6) AS {c}"
            for c in _SCALED
        )
        + " FROM p"
    ),
)
def standard_scale(spark, sf_dir):
    frame = X.patients(spark, sf_dir).select("encounter_id", *_SCALED)
    return _round(R.standard_scale(frame, _SCALED), _SCALED)


@query(
    "one_hot_unseen",
    over_p(
        """SELECT encounter_id, 'admission_type' AS "column", c AS category,
             CASE WHEN admission_type = c THEN 1 ELSE 0 END AS hot
           FROM p, (SELECT DISTINCT admission_type AS c FROM p WHERE admission_type <> 'Elective')
           UNION ALL
           SELECT encounter_id, 'insurance_type', c, CASE WHEN insurance_type = c THEN 1 ELSE 0 END
           FROM p, (SELECT DISTINCT insurance_type AS c FROM p WHERE admission_type <> 'Elective')"""
    ),
)
def one_hot_unseen(spark, sf_dir):
    frame, columns = X.patients(spark, sf_dir), ["admission_type", "insurance_type"]
    models = R.fit_one_hot(frame.filter("admission_type <> 'Elective'"), columns)
    return R.one_hot_long(frame, columns, models, ["encounter_id"])


@query(
    "label_encode",
    over_p(
        """SELECT encounter_id, risk_level,
             CAST((SELECT count(DISTINCT q.risk_level) FROM p q WHERE q.risk_level < p.risk_level) AS INTEGER) AS label
           FROM p"""
    ),
)
def label_encode(spark, sf_dir):
    frame = X.patients(spark, sf_dir).select("encounter_id", "risk_level")
    return R.fit_label_encoder(frame, "risk_level").transform(frame).withColumn("label", F.col("label").cast("int"))


@query(
    "class_weights",
    over_p(
        """SELECT risk_level, count(*) AS n,
             round((SELECT count(*) FROM p) / (CAST((SELECT count(DISTINCT risk_level) FROM p) AS DOUBLE) * count(*)), 6)
               AS weight
           FROM p GROUP BY risk_level"""
    ),
)
def class_weights(spark, sf_dir):
    return _round(R.class_weights(X.patients(spark, sf_dir), "risk_level"), ["weight"])


# ------------------------------------------------------------------ training


def _train_test(spark, sf_dir):
    """Feature frame split by patient, so no person is on both sides."""
    return hash_split(feature_frame(X.patients(spark, sf_dir)), ["patient_id"])


_TEST = "CAST('0x' || substr(md5(patient_id), 1, 8) AS BIGINT) % 10 >= 8"


def _quality(row, estimator: str):
    """What can be known beforehand of a fit: the size of the test set, and that the gate is passed."""
    return row.select(
        F.lit(estimator).alias("estimator"),
        (F.col("accuracy") >= PROMOTION_THRESHOLDS["accuracy"]).alias("accuracy_passed"),
        (F.col("f1_macro") >= PROMOTION_THRESHOLDS["f1_macro"]).alias("f1_macro_passed"),
        "test_size",
    )


def _quality_sql(estimator: str) -> str:
    return over_p(
        f"""SELECT '{estimator}' AS estimator, true AS accuracy_passed, true AS f1_macro_passed, count(*) AS test_size
            FROM p WHERE {_TEST}"""
    )


@query("train_forest_quality", _quality_sql("forest"))
def train_forest_quality(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = T.train_forest(train, MODEL_NUMERIC, MODEL_CATEGORICAL)
    return _quality(T.evaluate(model, test, "risk_level"), "forest")


@query("train_boosted_quality", _quality_sql("boosted"))
def train_boosted_quality(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = T.train_boosted(train, MODEL_NUMERIC, MODEL_CATEGORICAL, num_trees=SEARCH_SPACE["n_estimators"]["lower"])
    return _quality(T.evaluate(model, test, "risk_level"), "boosted")


def _registered(spark, train):
    registry = T.ModelRegistry(spark, fresh_path(spark, "models"))
    registry.register(T.train_forest(train, MODEL_NUMERIC, MODEL_CATEGORICAL), "patient_risk", "v_20240101_000000")
    return registry


@query(
    "score_batch",
    over_p(
        f"""SELECT patient_id, encounter_id, risk_level, true AS label_known, true AS sums_to_one FROM p WHERE {_TEST}"""
    ),
)
def score_batch(spark, sf_dir):
    """The default version, set by the gate, scores the test set with probabilities."""
    train, test = _train_test(spark, sf_dir)
    registry = _registered(spark, train)
    T.evaluate_and_promote(
        registry, "patient_risk", "v_20240101_000000", test, "risk_level", PROMOTION_THRESHOLDS, "2024-01-01 00:00:00"
    )
    positions = {name: i for i, name in enumerate(sorted(RISK_LABELS))}
    scored = C.score_batch(
        registry.load("patient_risk"), test, ["patient_id", "encounter_id", "risk_level"], probabilities=positions
    )
    total = sum((F.col(f"p_{n.lower()}") for n in RISK_LABELS), F.lit(0.0))
    return scored.select(
        "patient_id",
        "encounter_id",
        "risk_level",
        F.col("predicted_risk").isin(*RISK_LABELS).alias("label_known"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
    )


@query(
    "evaluate_and_promote",
    over_p(
        f"""SELECT metric_name, passed, reason, 'v_20240101_000000' AS default_version, n AS test_size, 26 AS logged
            FROM (VALUES ('accuracy', true, CAST(NULL AS VARCHAR)), ('f1_macro', true, NULL), ('overall', true, NULL)) c(metric_name, passed, reason),
              (SELECT CAST(count(*) AS DOUBLE) AS n FROM p WHERE {_TEST})"""
    ),
)
def evaluate_and_promote(spark, sf_dir):
    """A worse version is registered later and fails a stricter gate, so the default stays."""
    train, test = _train_test(spark, sf_dir)
    registry = _registered(spark, train)
    checks = T.evaluate_and_promote(
        registry, "patient_risk", "v_20240101_000000", test, "risk_level", PROMOTION_THRESHOLDS, "2024-01-01 00:00:00"
    )
    registry.register(registry.load("patient_risk", "v_20240101_000000"), "patient_risk", "v_20240102_000000")
    T.evaluate_and_promote(registry, "patient_risk", "v_20240102_000000", test, "risk_level", {"accuracy": 1.01}, "2024-01-02 00:00:00")
    log = registry.metrics().filter("model_version = 'v_20240101_000000'")
    return checks.select(
        "metric_name",
        "passed",
        "reason",
        registry.state().agg(F.first("default_version")).scalar().alias("default_version"),
        log.agg(F.max(F.when(F.col("metric_name") == "test_size", F.col("metric_value")))).scalar().alias("test_size"),
        log.agg(F.count("*").cast("int")).scalar().alias("logged"),
    )


# ------------------------------------------------------------------ search


def _uniform(name: str) -> str:
    digest = f"md5('42|{name}|' || p_partkey)"
    return f"(CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) AS DOUBLE) / {D(4294967296)})"


def _draw_sql(name: str, spec: dict) -> str:
    lo, hi, u = D(spec["lower"]), D(spec["upper"]), _uniform(name)
    if spec["type"] == "randint":
        return f"CAST({lo} + floor({u} * ({hi} - {lo})) AS INTEGER) AS {name}"
    if spec["type"] == "uniform":
        return f"round({lo} + {u} * ({hi} - {lo}), 9) AS {name}"
    return f"round(exp(ln({lo}) + {u} * (ln({hi}) - ln({lo}))), 9) AS {name}"


@query(
    "hpo_sample_space",
    f"""SELECT p_partkey, {', '.join(_draw_sql(n, s) for n, s in SEARCH_SPACE.items())}, booster
        FROM part, (VALUES ('forest'), ('boosted')) b(booster)""",
)
def hpo_sample_space(spark, sf_dir):
    space = {**SEARCH_SPACE, "booster": {"type": "grid_search", "values": ["forest", "boosted"]}}
    drawn = H.sample_space(X.table(spark, sf_dir, "part"), "p_partkey", space)
    return _round(drawn, [c for c, t in drawn.dtypes if t == "double"], 9)


@query(
    "hpo_search",
    f"""SELECT 8 AS trials, {len(SEARCH_SPACE)} AS drawn, 50 AS first_rung, 8 AS reached_first, true AS thinned, true AS each_tree_once,
          true AS scored, true AS best_passed""",
)
def hpo_search(spark, sf_dir):
    """Eight configurations of all documented ranges, boosted; the better half of each rung goes on."""
    train, test = _train_test(spark, sf_dir)
    found = H.run_async_halving(train, test, MODEL_NUMERIC, MODEL_CATEGORICAL, "risk_level", SEARCH_SPACE, num_samples=8)
    params = F.from_json("params", "map<string, double>")
    trials = found.groupBy("trial_id").agg(
        F.min(F.size(F.map_keys(params))).alias("drawn"),
        F.min("rung").alias("first"),
        (F.max("rung") > 50).alias("went_on"),
        # what its steps fitted is what its ensemble holds
        (F.sum("trees_fitted") == F.max("rung")).alias("once"),
        F.max("score").alias("best"),
        F.bool_and(F.col("score").between(0, 1)).alias("scored"),
    )
    return trials.agg(
        F.count("*").cast("int").alias("trials"),
        F.min("drawn").alias("drawn"),
        F.min("first").alias("first_rung"),
        F.count_if(F.col("first") == 50).cast("int").alias("reached_first"),
        (F.count_if("went_on") <= F.count("*") / 2 + 4).alias("thinned"),
        F.bool_and("once").alias("each_tree_once"),
        F.bool_and("scored").alias("scored"),
        (F.max("best") >= PROMOTION_THRESHOLDS["f1_macro"]).alias("best_passed"),
    )


_TRIALS = """trials AS (
  SELECT p_partkey AS trial_id, p_brand, p_type, p_size, p_retailprice AS score,
    CAST(p_partkey % 97 AS INTEGER) AS rung FROM part)"""


def _trials(spark, sf_dir):
    rung = (F.col("p_partkey") % 97).cast("int")
    return X.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("trial_id"), "p_brand", "p_type", "p_size", F.col("p_retailprice").alias("score"), rung.alias("rung")
    )


@query(
    "halving_promote",
    f"""WITH {_TRIALS}, cuts AS (SELECT rung, quantile_cont(score, 0.5) AS cut FROM trials GROUP BY rung)
        SELECT trial_id, t.rung, score, score >= cut AS promoted FROM trials t JOIN cuts ON t.rung = cuts.rung""",
)
def halving_promote(spark, sf_dir):
    return H.halving_promote(_trials(spark, sf_dir), "rung", "score", factor=2).select(
        "trial_id", "rung", "score", "promoted"
    )


_BY_GROUP = """tallies AS (
  SELECT insurance_type AS g, l, sum(a) AS support, sum(b) AS n_predicted, sum(h) AS hits FROM (
    SELECT insurance_type, risk_level AS l, 1 AS a, 0 AS b, CASE WHEN risk_level = predicted THEN 1 ELSE 0 END AS h FROM pr
    UNION ALL SELECT insurance_type, predicted, 0, 1, 0 FROM pr) GROUP BY ALL),
runs AS (
  SELECT g, CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, avg(2 * hits / CAST(support + n_predicted AS DOUBLE)) AS f1_macro,
    CAST(sum(support) AS DOUBLE) AS test_size FROM tallies GROUP BY g)"""


@query(
    "experiment_log",
    over_pr(
        """SELECT 'rules_' || g AS run_name, 'metric' AS kind, 'accuracy' AS name, round(accuracy, 6) AS value FROM runs
           UNION ALL SELECT 'rules_' || g, 'metric', 'f1_macro', round(f1_macro, 6) FROM runs
           UNION ALL SELECT 'rules_' || g, 'param', 'test_size', test_size FROM runs
           UNION ALL SELECT 'rules_' || g, 'param', 'seed', 42 FROM runs""",
        _BY_GROUP,
    ),
)
def experiment_log(spark, sf_dir):
    counts = M.pair_counts(X.predictions(spark, sf_dir), "risk_level", "predicted", by=["insurance_type"])
    runs = M.summary(counts, by=["insurance_type"]).select(
        F.concat(F.lit("rules_"), "insurance_type").alias("run"), "accuracy", "f1_macro", "test_size", F.lit(42).alias("seed")
    )
    logged = T.log_run(runs, "run", params=["test_size", "seed"], metrics=["accuracy", "f1_macro"])
    return logged.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(
    "model_registry_default",
    """WITH versions AS (SELECT p_brand, 'v_' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS version FROM part),
       pointers AS (SELECT p_brand, 'v_' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS version, p_retailprice AS set_at
         FROM part WHERE p_size > 40),
       current AS (SELECT p_brand, version FROM (
         SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY set_at DESC, version DESC) AS rn FROM pointers) WHERE rn = 1)
       SELECT v.p_brand AS model_name, count(*) AS n_versions, max(v.version) AS latest_version,
         coalesce(any_value(c.version), max(v.version)) AS default_version
       FROM versions v LEFT JOIN current c ON v.p_brand = c.p_brand GROUP BY v.p_brand""",
)
def model_registry_default(spark, sf_dir):
    part = X.table(spark, sf_dir, "part")
    name = F.concat(F.lit("v_"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"))
    versions = part.select(F.col("p_brand").alias("model_name"), name.alias("version"))
    set_rows = part.filter("p_size > 40").select(
        F.col("p_brand").alias("model_name"), name.alias("version"), F.col("p_retailprice").alias("set_at")
    )
    broken = part.select(
        F.col("p_brand").alias("model_name"), F.lit("v_missing").alias("version"), (F.col("p_retailprice") + 1e9).alias("set_at")
    )
    return T.registry_state(versions, set_rows.unionByName(broken))


@query(
    "hpo_results_log",
    f"""WITH {_TRIALS}, best AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, trial_id) AS rn FROM trials) WHERE rn = 1)
        SELECT p_brand AS job_id, '{{"p_size":' || p_size || ',"p_type":"' || p_type || '"}}' AS best_params,
          score AS best_score, 'f1_macro' AS metric_name, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM best""",
)
def hpo_results_log(spark, sf_dir):
    trials = _trials(spark, sf_dir).withColumn("params", F.to_json(F.struct("p_size", "p_type")))
    best = M.best_trial_per_job(trials, "p_brand", "score", "max", "trial_id")
    return best.select(
        F.col("p_brand").alias("job_id"),
        F.col("params").alias("best_params"),
        F.col("score").alias("best_score"),
        F.lit("f1_macro").alias("metric_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


# ------------------------------------------------------------------ scoring


@query("score_rules", over_p(f"SELECT patient_id, encounter_id, risk_level, {label('score')} AS predicted_risk FROM full_p"))
def score_rules(spark, sf_dir):
    scored = C.score_rules(X.patients(spark, sf_dir))
    return scored.select("patient_id", "encounter_id", "risk_level", "predicted_risk")


FALLBACK_SQL = over_pn(
    f"""SELECT pn.encounter_id, CASE WHEN pn.glucose_level IS NULL OR pn.bmi IS NULL OR pn.gender IS NULL
          THEN 'ERROR' ELSE rescored END AS predicted_risk
        FROM pn JOIN (
          SELECT encounter_id, {label('(score + CASE WHEN h3 % 97 = 0 THEN 2 ELSE 0 END)')} AS rescored FROM full_p) r
        ON pn.encounter_id = r.encounter_id"""
)


@query("score_with_fallback", FALLBACK_SQL)
def score_with_fallback(spark, sf_dir):
    gaps = X.patients_with_gaps(spark, sf_dir)
    required = [*C.RULE_INPUTS, "bmi", "gender"]
    return C.score_or_error(gaps, risk_label(risk_score()), required).select("encounter_id", "predicted_risk")


def _linear_risk(batch: pd.DataFrame) -> pd.Series:
    """A foreign model: a few vectorised operations on an Arrow batch."""
    weighted = batch["age"] * 2 + batch["heart_rate"] + batch["comorbidity_count"] * 15
    return pd.Series(np.where(weighted > 270, "HIGH", "LOW"))


@query(
    "score_with_function",
    over_p(
        """SELECT encounter_id, CASE WHEN age * 2 + heart_rate + comorbidity_count * 15 > 270 THEN 'HIGH' ELSE 'LOW' END
             AS predicted FROM p"""
    ),
)
def score_with_function(spark, sf_dir):
    frame = X.patients(spark, sf_dir).select("encounter_id", "age", "heart_rate", "comorbidity_count")
    return C.score_with_function(frame, _linear_risk, ["age", "heart_rate", "comorbidity_count"], "predicted").select(
        "encounter_id", "predicted"
    )


_LOGGED = ["age", "bmi", "shock_index", "vital_signs_severity"]


@query(
    "inference_log_roundtrip",
    over_p(
        f"""SELECT encounter_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _LOGGED)}, risk_level
            FROM (SELECT *, {ENGINEERED_SERVE} FROM p)"""
    ),
)
def inference_log_roundtrip(spark, sf_dir):
    scored = C.score_rules(feature_frame(X.patients(spark, sf_dir), severity="serve", bmi="serve"))
    log = C.capture_log(scored, "predicted_risk", features=_LOGGED, keep=["encounter_id"])
    return C.flatten_log(log, numeric=_LOGGED, categorical=[], keep=["encounter_id"]).drop("record_id", "ts")

