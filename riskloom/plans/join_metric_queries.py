"""Queries over joins, windows, aggregations and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.constants import PROMOTION_THRESHOLDS, RISK_LABELS
from riskloom.operators import joins as J
from riskloom.operators import metrics as M
from riskloom.plans.registry import query
from riskloom.plans.sql import D, SLICES_CTE, over_p, over_pr
from riskloom.sources import fixtures as X
from riskloom.sources.layout import TimeLayout
from riskloom.workspace import fresh_path

PROBABILITIES = {name: f"p_{name.lower()}" for name in RISK_LABELS}
CUT_DATES = ["1995-06-01", "1996-07-01", "1998-01-01", "2002-01-01"]

_SPINE = """spine AS (
  SELECT 'P' || c_custkey AS patient_id, unnest([{}]) AS cut_ts FROM customer)""".format(
    ", ".join(f"TIMESTAMP '{d}'" for d in CUT_DATES)
)
_NEWEST = """newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, ts ORDER BY encounter_id DESC) AS rn FROM p)
  WHERE rn = 1)"""
_SPEND = """spend AS (
  SELECT 'P' || o_custkey AS patient_id, o_orderdate AS paid_at, o_totalprice, o_orderkey FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
    FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1)"""


def _spine(spark, sf_dir):
    dates = F.array(*[F.lit(d).cast("timestamp_ntz") for d in CUT_DATES])
    return X.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), F.col("c_custkey")).alias("patient_id"), F.explode(dates).alias("cut_ts")
    )


_AS_OF = over_p(
    """SELECT s.patient_id, s.cut_ts, n.encounter_id, n.ts AS feature_ts, CAST(n.age AS DOUBLE) AS age, n.risk_level
       FROM spine s ASOF LEFT JOIN newest n ON s.patient_id = n.patient_id AND s.cut_ts >= n.ts""",
    _NEWEST,
    _SPINE,
)


def _as_of_features(spark, sf_dir):
    return X.patients(spark, sf_dir).select(
        "patient_id", "ts", F.col("ts").alias("feature_ts"), "encounter_id", F.col("age").cast("double").alias("age"), "risk_level"
    )


@query("as_of_bucketed", _AS_OF)
def as_of_bucketed(spark, sf_dir):
    """The as-of join over a view that is stored in buckets of (key, slice of time), in two appends."""
    features, even = _as_of_features(spark, sf_dir), F.crc32(F.col("encounter_id").cast("binary")) % 2 == 0
    layout = TimeLayout(
        spark, fresh_path(spark, "layout"), "encounters", ["patient_id"], "ts", ["encounter_id", "feature_ts", "age", "risk_level"],
        ["encounter_id"], seconds=365 * 86400, buckets=8,
    )
    layout.append(features.filter(even))
    layout.append(features.filter(~even))
    return layout.retrieve(_spine(spark, sf_dir), "cut_ts")


@query("as_of_join", _AS_OF)
def as_of_join(spark, sf_dir):
    return J.as_of_join(
        _spine(spark, sf_dir),
        _as_of_features(spark, sf_dir),
        ["patient_id"],
        "cut_ts",
        "ts",
        ["encounter_id", "feature_ts", "age", "risk_level"],
        tie_break=["encounter_id"],
    )


@query(
    "retrieve_multi_view",
    over_p(
        """SELECT s.patient_id, s.cut_ts, n.encounter_id, n.risk_level, m.o_totalprice AS spend_o_totalprice,
             m.paid_at AS spend_paid_at
           FROM spine s ASOF LEFT JOIN newest n ON s.patient_id = n.patient_id AND s.cut_ts >= n.ts
           ASOF LEFT JOIN spend m ON s.patient_id = m.patient_id AND s.cut_ts >= m.paid_at""",
        _NEWEST,
        _SPINE,
        _SPEND,
    ),
)
def retrieve_multi_view(spark, sf_dir):
    encounters = J.FeatureView(
        X.patients(spark, sf_dir).select("patient_id", "ts", "encounter_id", "risk_level"),
        "ts",
        ["encounter_id", "risk_level"],
        ["encounter_id"],
    )
    orders = X.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    paid = orders.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("patient_id"),
        F.col("o_orderdate").alias("paid_at"),
        "o_totalprice",
        "o_orderkey",
    )
    spend = J.FeatureView(paid, "paid_at", ["o_totalprice", "paid_at"], ["o_orderkey"], prefix="spend_")
    return J.retrieve_features(_spine(spark, sf_dir), [encounters, spend], ["patient_id"], "cut_ts")


@query("join_pred_label", over_pr("SELECT encounter_id, predicted, risk_level FROM pr"))
def join_pred_label(spark, sf_dir):
    scored = X.predictions(spark, sf_dir)
    return J.predictions_to_labels(
        scored.select("encounter_id", "predicted"), scored.select("encounter_id", "risk_level"), ["encounter_id"]
    )


@query(
    "anti_join_new_alerts",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (
         SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1996-01-01')""",
)
def anti_join_new_alerts(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    current = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    seen = orders.filter("o_orderpriority = '1-URGENT' AND o_orderdate < timestamp_ntz'1996-01-01 00:00:00'")
    return J.new_only(current, seen, ["o_custkey"])


# ------------------------------------------------------------------ metrics

_LABELS = "(SELECT risk_level AS l FROM pr UNION SELECT predicted FROM pr)"
_RATES = f"""tallies AS (
  SELECT l AS label, (SELECT count(*) FROM pr WHERE risk_level = l) AS support,
    (SELECT count(*) FROM pr WHERE predicted = l) AS n_predicted,
    (SELECT count(*) FROM pr WHERE predicted = l AND risk_level = l) AS hits
  FROM {_LABELS} labels),
rates AS (
  SELECT label, support, CASE WHEN n_predicted = 0 THEN 0 ELSE hits / CAST(n_predicted AS DOUBLE) END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / CAST(support AS DOUBLE) END AS recall,
    CASE WHEN support + n_predicted = 0 THEN 0 ELSE 2 * hits / CAST(support + n_predicted AS DOUBLE) END AS f1
  FROM tallies)"""
_NLL = f"""-ln(greatest({D('2.220446049250313e-16')}, least({D(1)} - {D('2.220446049250313e-16')},
  CASE risk_level WHEN 'LOW' THEN p_low WHEN 'MEDIUM' THEN p_medium WHEN 'HIGH' THEN p_high ELSE p_critical END)))"""


def _rounded(df, digits: int = 6, skip: tuple = ()):
    return df.select(
        *[F.round(n, digits).alias(n) if t == "double" and n not in skip else F.col(n) for n, t in df.dtypes]
    )


def _pairs(spark, sf_dir, **kw):
    return M.pair_counts(X.predictions(spark, sf_dir), "risk_level", "predicted", **kw)


@query(
    "confusion_matrix",
    over_pr(
        f"""SELECT a.l AS actual, b.l AS predicted,
              (SELECT count(*) FROM pr WHERE risk_level = a.l AND predicted = b.l) AS n
            FROM {_LABELS} a, {_LABELS} b"""
    ),
)
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_pairs(spark, sf_dir))


@query("accuracy", over_pr("SELECT round(avg(CASE WHEN risk_level = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pr"))
def accuracy(spark, sf_dir):
    return _rounded(M.accuracy(X.predictions(spark, sf_dir), "risk_level", "predicted"))


@query(
    "macro_prf",
    over_pr(
        """SELECT round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
             round(avg(f1), 6) AS f1_macro FROM rates""",
        _RATES,
    ),
)
def macro_prf(spark, sf_dir):
    return _rounded(M.macro_prf(_pairs(spark, sf_dir)))


@query(
    "weighted_prf",
    over_pr(
        """SELECT round(sum(precision * support) / sum(support), 6) AS precision_weighted,
             round(sum(recall * support) / sum(support), 6) AS recall_weighted,
             round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM rates""",
        _RATES,
    ),
)
def weighted_prf(spark, sf_dir):
    return _rounded(M.weighted_prf(_pairs(spark, sf_dir)))


@query(
    "per_class_prf",
    over_pr(
        """SELECT g.label, coalesce(round(precision, 6), 0) AS precision, coalesce(round(recall, 6), 0) AS recall,
             coalesce(round(f1, 6), 0) AS f1, coalesce(support, 0) AS support
           FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH'), ('CRITICAL'), ('UNSEEN')) g(label)
           LEFT JOIN rates ON rates.label = g.label""",
        _RATES,
    ),
)
def per_class_prf(spark, sf_dir):
    return _rounded(M.per_class_prf(_pairs(spark, sf_dir), [*RISK_LABELS, "UNSEEN"]))


@query("log_loss", over_pr(f"SELECT round(avg({_NLL}), 6) AS log_loss FROM pr"))
def log_loss(spark, sf_dir):
    return _rounded(M.log_loss(X.predictions(spark, sf_dir), "risk_level", PROBABILITIES))


@query("class_support", over_p("SELECT risk_level, count(*) AS support FROM p GROUP BY risk_level"))
def class_support(spark, sf_dir):
    return M.support(X.patients(spark, sf_dir), "risk_level")


@query(
    "class_share",
    over_p(
        """SELECT risk_level, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM p) AS DOUBLE), 6) AS share
           FROM p GROUP BY risk_level"""
    ),
)
def class_share(spark, sf_dir):
    return _rounded(M.class_share(X.patients(spark, sf_dir), "risk_level"))


@query(
    "share_of_total",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n,
          floor(count(*) * {D(100)} / (SELECT count(*) FROM lineitem) * {D(10)} + {D(0.5)}) / {D(10)} AS pct
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def share_of_total(spark, sf_dir):
    shares = M.share_of_total(X.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return shares.orderBy(F.col("n").desc())


@query(
    "group_counts",
    over_pr(
        """SELECT ts >= TIMESTAMP '2000-06-01' AS drift_applied, predicted, count(*) AS n FROM pr GROUP BY ALL"""
    ),
)
def group_counts(spark, sf_dir):
    flag = (F.col("ts") >= F.lit(X.DRIFT_START).cast("timestamp_ntz")).alias("drift_applied")
    return M.group_counts(X.predictions(spark, sf_dir), flag, "predicted")


_MEANS = {"age": 1, "heart_rate": 1, "systolic_bp": 1, "oxygen_saturation": 1, "glucose_level": 1, "creatinine": 2}


@query(
    "group_means",
    over_p(
        "SELECT drift_applied, "
        + ", ".join(
            f"floor(avg(CAST({c} AS DOUBLE)) * {D(10**d)} + {D(0.5)}) / {D(10**d)} AS avg_{c}" for c, d in _MEANS.items()
        )
        + " FROM drifted GROUP BY drift_applied",
        SLICES_CTE,
    ),
)
def group_means(spark, sf_dir):
    return M.group_means(X.drifted_live(spark, sf_dir), ["drift_applied"], _MEANS)


@query(
    "batch_distribution",
    over_pr(
        """SELECT b.batch_id, predicted, n, CAST(total AS BIGINT) AS running_total
           FROM (SELECT batch_id, predicted, count(*) AS n FROM pb GROUP BY ALL) b
           JOIN (SELECT batch_id, sum(count(*)) OVER (ORDER BY batch_id) AS total FROM pb GROUP BY batch_id) r
           ON b.batch_id = r.batch_id""",
        "pb AS (SELECT predicted, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS batch_id FROM pr)",
    ),
)
def batch_distribution(spark, sf_dir):
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    batches = X.predictions(spark, sf_dir).select("predicted", day.alias("batch_id"))
    return M.batch_distribution(batches, "batch_id", "predicted")


_MODEL, _VERSION = "patient_risk", "v_20240101_000000"
_LONG = f"""scalars AS (
  SELECT (SELECT avg(CASE WHEN risk_level = predicted THEN CAST(1 AS DOUBLE) ELSE 0 END) FROM pr) AS accuracy,
    avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
    sum(precision * support) / sum(support) AS precision_weighted,
    sum(recall * support) / sum(support) AS recall_weighted, sum(f1 * support) / sum(support) AS f1_weighted,
    CAST(sum(support) AS DOUBLE) AS test_size, (SELECT avg({_NLL}) FROM pr) AS log_loss
  FROM rates),
cells AS (
  SELECT a.l AS actual, b.l AS predicted,
    (SELECT count(*) FROM pr WHERE risk_level = a.l AND predicted = b.l) AS n FROM {_LABELS} a, {_LABELS} b),
metric_rows AS (
  SELECT metric_name, metric_value, CAST(NULL AS VARCHAR) AS metric_details FROM (
    UNPIVOT scalars ON * INTO NAME metric_name VALUE metric_value)
  UNION ALL SELECT label || '_precision', precision, NULL FROM rates
  UNION ALL SELECT label || '_recall', recall, NULL FROM rates
  UNION ALL SELECT label || '_f1', f1, NULL FROM rates
  UNION ALL SELECT label || '_support', CAST(support AS DOUBLE), NULL FROM rates
  UNION ALL SELECT 'confusion_matrix', NULL, '[' || string_agg(line, ',' ORDER BY actual) || ']' FROM (
    SELECT actual, '[' || string_agg(CAST(n AS VARCHAR), ',' ORDER BY predicted) || ']' AS line
    FROM cells GROUP BY actual))"""


@query(
    "metrics_long",
    over_pr(
        f"""SELECT 'M' || upper(md5('{_MODEL}|{_VERSION}|2024-01-01 00:00:00|' || metric_name)) AS metric_id,
              '{_MODEL}' AS model_name, '{_VERSION}' AS model_version, metric_name,
              round(metric_value, 6) AS metric_value, metric_details,
              TIMESTAMP '2024-01-01 00:00:00' AS evaluated_at FROM metric_rows""",
        _RATES,
        _LONG,
    ),
)
def metrics_long(spark, sf_dir):
    return _rounded(_long_metrics(spark, sf_dir))


def _long_metrics(spark, sf_dir):
    return M.metrics_to_long(
        X.predictions(spark, sf_dir),
        "risk_level",
        "predicted",
        _MODEL,
        _VERSION,
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        probabilities=PROBABILITIES,
        labels=RISK_LABELS,
    )


@query(
    "promotion_check",
    over_pr(
        """SELECT metric_name, threshold, round(actual, 6) AS actual, passed, reason FROM (
             SELECT 'accuracy' AS metric_name, CAST(0.80 AS DOUBLE) AS threshold, accuracy AS actual,
               accuracy >= 0.80 AS passed, CAST(NULL AS VARCHAR) AS reason FROM scalars
             UNION ALL SELECT 'f1_macro', 0.75, f1_macro, f1_macro >= 0.75, NULL FROM scalars
             UNION ALL SELECT 'auc', 0.9, NULL, false, 'metric_not_found'
             UNION ALL SELECT 'overall', NULL, NULL, false, NULL)""",
        _RATES,
        _LONG,
    ),
)
def promotion_check(spark, sf_dir):
    thresholds = {**PROMOTION_THRESHOLDS, "auc": 0.9}
    return _rounded(M.promotion_check(_long_metrics(spark, sf_dir), thresholds))


@query(
    "best_trial",
    """SELECT p_partkey AS trial_id, p_size, p_retailprice AS score FROM part
       ORDER BY p_retailprice DESC, p_partkey LIMIT 1""",
)
def best_trial(spark, sf_dir):
    trials = X.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("trial_id"), "p_size", F.col("p_retailprice").alias("score")
    )
    return M.best_trial(trials, "score", "max", "trial_id")


