"""Queries over scalar expressions, predicates and what-if perturbations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.constants import MODEL_CATEGORICAL, MODEL_NUMERIC, RAW_CATEGORICAL, RAW_NUMERIC
from riskloom.functions import expressions as E
from riskloom.functions import payload as J
from riskloom.functions.whatif import perturb
from riskloom.operators.features import feature_frame
from riskloom.operators.scoring import flatten_log
from riskloom.operators.selection import hash_split, preview, sample_fraction, top_k
from riskloom.plans.registry import query
from riskloom.plans.sql import (
    BMI_SERVE,
    BMI_TRAIN,
    D,
    ENGINEERED_SERVE,
    SEVERITY_SERVE,
    SEVERITY_TRAIN,
    SHOCK,
    VITALS_DEGRADED,
    as_doubles,
    half_up,
    over_p,
    over_pn,
)
from riskloom.sources import fixtures as X
from riskloom.sources import tables as S


@query("shock_index", over_pn(f"SELECT encounter_id, {SHOCK} AS shock_index FROM pn"))
def shock_index(spark, sf_dir):
    return X.patients_with_gaps(spark, sf_dir).select(
        "encounter_id", E.safe_ratio("heart_rate", "systolic_bp").alias("shock_index")
    )


@query("pulse_pressure", over_p("SELECT encounter_id, systolic_bp - diastolic_bp AS pulse_pressure FROM p"))
def pulse_pressure(spark, sf_dir):
    return X.patients(spark, sf_dir).select(
        "encounter_id", E.difference("systolic_bp", "diastolic_bp").alias("pulse_pressure")
    )


@query("bmi_category_train", over_pn(f"SELECT encounter_id, {BMI_TRAIN} AS bmi_category FROM pn"))
def bmi_category_train(spark, sf_dir):
    return X.patients_with_gaps(spark, sf_dir).select("encounter_id", E.bmi_category_train().alias("bmi_category"))


@query("bmi_category_serve", over_pn(f"SELECT encounter_id, {BMI_SERVE} AS bmi_category FROM pn"))
def bmi_category_serve(spark, sf_dir):
    return X.patients_with_gaps(spark, sf_dir).select("encounter_id", E.bmi_category_serve().alias("bmi_category"))


@query("severity_train", over_pn(f"SELECT encounter_id, {SEVERITY_TRAIN} AS severity FROM pn"))
def severity_train(spark, sf_dir):
    return X.patients_with_gaps(spark, sf_dir).select("encounter_id", E.severity_train().alias("severity"))


@query("severity_serve", over_pn(f"SELECT encounter_id, {SEVERITY_SERVE} AS severity FROM pn"))
def severity_serve(spark, sf_dir):
    return X.patients_with_gaps(spark, sf_dir).select("encounter_id", E.severity_serve().alias("severity"))


@query("risk_score_label", over_p("SELECT encounter_id, score, risk_level FROM full_p"))
def risk_score_label(spark, sf_dir):
    scored = X.patients(spark, sf_dir).select("encounter_id", E.risk_score().alias("score"))
    return scored.select("*", E.risk_label("score").alias("risk_level"))


@query(
    "baseline_projection",
    over_p(f"SELECT {as_doubles(RAW_NUMERIC)}, {', '.join(RAW_CATEGORICAL)}, risk_level FROM p"),
)
def baseline_projection(spark, sf_dir):
    types = {c: "double" for c in RAW_NUMERIC} | {c: "string" for c in [*RAW_CATEGORICAL, "risk_level"]}
    return S.project_cast(X.patients(spark, sf_dir), types)


@query("normalise_columns", "SELECT r_regionkey, r_name FROM region")
def normalise_columns(spark, sf_dir):
    return S.normalise_columns(S.normalise_columns(X.table(spark, sf_dir, "region"), upper=True))


@query("select_subset", over_p("SELECT risk_level, encounter_id, age FROM p"))
def select_subset(spark, sf_dir):
    frame = X.patients(spark, sf_dir)
    return frame.drop(*[c for c in frame.columns if c not in ("encounter_id", "age", "risk_level")]).select(
        "risk_level", "encounter_id", "age"
    )


@query(
    "filter_predicate",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity >= 30 AND l_discount < CAST(0.05 AS DOUBLE) AND l_returnflag = 'R'""",
)
def filter_predicate(spark, sf_dir):
    lines = X.table(spark, sf_dir, "lineitem")
    wanted = (F.col("l_quantity") >= 30) & (F.col("l_discount") < 0.05) & (F.col("l_returnflag") == "R")
    return lines.filter(wanted).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "fill_missing",
    over_pn(
        """SELECT encounter_id, coalesce(glucose_level, 0) AS glucose_level, coalesce(bmi, 0) AS bmi,
             coalesce(gender, 'Unknown') AS gender FROM pn"""
    ),
)
def fill_missing(spark, sf_dir):
    gaps = X.patients_with_gaps(spark, sf_dir).select("encounter_id", "glucose_level", "bmi", "gender")
    return S.fill_missing(gaps)


_PRICE = f"greatest({D(1000)}, least({D(50000)}, l_extendedprice * (1 - l_discount)))"


@query(
    "clip_round",
    f"""SELECT l_orderkey, l_linenumber, {half_up(_PRICE, 1)} AS price,
          CAST(floor(greatest({D(5)}, least({D(40)}, l_quantity * {D(1.15)}))) AS INTEGER) AS quantity
        FROM lineitem""",
)
def clip_round(spark, sf_dir):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        E.clip_round(price, 1000, 50000, 1).alias("price"),
        E.clip_truncate(F.col("l_quantity") * F.lit(1.15), 5, 40).alias("quantity"),
    )


@query(
    "surrogate_id",
    "SELECT o_orderkey, 'M' || upper(md5(o_orderkey || '|' || o_custkey)) AS id FROM orders",
)
def surrogate_id(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey", E.surrogate_id(["o_orderkey", "o_custkey"], "M").alias("id")
    )


_EXTRACTED = ["age", "bmi", "heart_rate", "shock_index"]


@query(
    "json_extract_typed",
    over_p(
        f"""SELECT encounter_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _EXTRACTED)},
              gender, risk_level FROM (SELECT *, {ENGINEERED_SERVE} FROM p)"""
    ),
)
def json_extract_typed(spark, sf_dir):
    request = f"{X.LOG_PREFIX}.request.data"
    fields = {c: (f"{request}.{c.upper()}", "double") for c in _EXTRACTED}
    fields["gender"] = (f"{request}.GENDER", "string")
    fields["risk_level"] = (f"{X.LOG_PREFIX}.response.data.output_feature_0", "string")
    return J.json_extract(X.inference_log(spark, sf_dir), "record_attributes", fields, keep=["encounter_id"])


@query(
    "record_hash",
    "SELECT event_id, md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || props) AS record_id FROM events",
)
def record_hash(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select("event_id", E.record_hash("ts", "props").alias("record_id"))


@query(
    "json_roundtrip",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 AS k, event_type AS kind FROM events""",
)
def json_roundtrip(spark, sf_dir):
    parsed = J.json_parse_map("props")
    doubled = J.json_put(parsed, "k", F.element_at(parsed, "k").cast("bigint") * 2)
    packed = F.to_json(J.json_put(doubled, "kind", F.col("event_type")))
    events = X.table(spark, sf_dir, "events").select("event_id", packed.alias("payload"))
    return J.json_extract(events, "payload", {"k": ("k", "bigint"), "kind": ("kind", "string")}, keep=["event_id"])


@query(
    "time_range_filter",
    "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-15'",
)
def time_range_filter(spark, sf_dir):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-14", "2024-01-15"))
    return X.table(spark, sf_dir, "events").filter(E.time_range("ts", start, end)).select("event_id", "ts", "value")


@query("version_stamp", "SELECT o_orderkey, strftime(o_orderdate, 'v_%Y%m%d_%H%M%S') AS version FROM orders")
def version_stamp(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select("o_orderkey", E.version_stamp("o_orderdate").alias("version"))


@query(
    "in_list_filter",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""",
)
def in_list_filter(spark, sf_dir):
    wanted = E.in_list("o_orderstatus", ["F", "O"]) & E.in_list("o_orderpriority", ["1-URGENT", "5-LOW"], negate=True)
    return X.table(spark, sf_dir, "orders").filter(wanted).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "align_schema",
    over_p(
        f"""SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MODEL_NUMERIC)},
              {', '.join(MODEL_CATEGORICAL)}, ts, risk_level
            FROM (SELECT *, {ENGINEERED_SERVE} FROM p)"""
    ),
)
def align_schema(spark, sf_dir):
    baseline = feature_frame(X.patients(spark, sf_dir), severity="serve", bmi="serve")
    return S.align_schema(baseline, flatten_log(X.inference_log(spark, sf_dir)))


@query(
    "preview_limit",
    over_p("SELECT encounter_id, ts, age, risk_level FROM p ORDER BY ts DESC, encounter_id LIMIT 10"),
)
def preview_limit(spark, sf_dir):
    order = [F.col("ts").desc(), F.col("encounter_id")]
    return preview(X.patients(spark, sf_dir).select("encounter_id", "ts", "age", "risk_level"), order, 10)


@query(
    "top_k",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100""",
)
def top_k_query(spark, sf_dir):
    lines = X.table(spark, sf_dir, "lineitem")
    order = [F.col("l_extendedprice").desc(), *map(F.col, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))]
    return top_k(lines, order, 100).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "sample_bernoulli",
    f"""SELECT * FROM orders
        WHERE CAST(CAST('0x' || substr(md5('42|' || o_orderkey), 1, 8) AS BIGINT) AS DOUBLE) / {D(4294967296)} < 0.2""",
)
def sample_bernoulli(spark, sf_dir):
    return sample_fraction(X.table(spark, sf_dir, "orders"), 0.2, ["o_orderkey"], seed=42)


@query(
    "hash_split",
    over_p(
        """SELECT encounter_id, CASE WHEN CAST('0x' || substr(md5(encounter_id), 1, 8) AS BIGINT) % 10 < 8
             THEN 'train' ELSE 'test' END AS split FROM p"""
    ),
)
def hash_split_query(spark, sf_dir):
    train, test = hash_split(X.patients(spark, sf_dir).select("encounter_id"), ["encounter_id"])
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


# ------------------------------------------------------------------ what-if


@query("perturb_age", over_p("SELECT encounter_id, least(age + 10, 100) AS age FROM p"))
def perturb_age(spark, sf_dir):
    return perturb(X.patients(spark, sf_dir), "age_shift").select("encounter_id", "age")


@query("perturb_vitals", over_p(f"SELECT encounter_id, {VITALS_DEGRADED} FROM p"))
def perturb_vitals(spark, sf_dir):
    return perturb(X.patients(spark, sf_dir), "vital_degradation").select(
        "encounter_id", "heart_rate", "systolic_bp", "oxygen_saturation"
    )


@query(
    "perturb_scale",
    over_p(
        f"""SELECT encounter_id, {half_up('glucose_level * ' + D(1.3), 1)} AS glucose_level,
              {half_up('creatinine * ' + D(1.3), 2)} AS creatinine FROM p"""
    ),
)
def perturb_scale(spark, sf_dir):
    return perturb(X.patients(spark, sf_dir), "feature_scale").select("encounter_id", "glucose_level", "creatinine")


@query(
    "perturb_category",
    over_p(
        f"""SELECT encounter_id, CASE WHEN u < {D(0.7)} THEN 'Emergency' WHEN u < {D(0.7)} + {D(0.2)} THEN 'Urgent'
              ELSE 'Elective' END AS admission_type
            FROM (SELECT encounter_id, CAST(CAST('0x' || substr(md5(encounter_id), 1, 8) AS BIGINT) AS DOUBLE)
              / {D(4294967296)} AS u FROM p)"""
    ),
)
def perturb_category(spark, sf_dir):
    return perturb(X.patients(spark, sf_dir), "distribution_shift").select("encounter_id", "admission_type")


@query("perturb_unknown", over_p("SELECT encounter_id, age, heart_rate FROM p"))
def perturb_unknown(spark, sf_dir):
    return perturb(X.patients(spark, sf_dir), "no_such_kind").select("encounter_id", "age", "heart_rate")
