"""Encounter frames derived from the ``orders`` table.

The test tables hold no encounters, so each order becomes one encounter by integer arithmetic on
its keys: one narrow projection, no shuffle, as many rows as ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import ENCOUNTER_SCHEMA, RISK_LABELS
from riskloom.functions.expressions import RISK_CUTPOINTS, label_by_cutpoints, risk_label, risk_score
from riskloom.functions.whatif import perturb
from riskloom.operators.features import feature_frame
from riskloom.operators.scoring import capture_log

BASELINE_END = "1999-01-01"
DRIFT_START = "2000-06-01"
CLASS_CENTRES = {"LOW": 1, "MEDIUM": 4, "HIGH": 7, "CRITICAL": 11}
LOG_PREFIX = "serving"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- fixed values: diagnosis codes of the encounter model ------------------------------------
DIAGNOSES = ["I10", "E11", "J44", "I25", "N18", "I50", "J18", "A41", "K92", "I63"]
# ---------------------------------------------------------------------------------------------
_DIAGNOSES = ", ".join(f"'{code}'" for code in DIAGNOSES)

HASHES = [
    "o_orderkey",
    "o_custkey",
    "o_orderdate AS ts",
    "(o_orderkey * 7919 + o_custkey * 31) % 1000 AS h1",
    "(o_orderkey * 104729 + 17) % 1000 AS h2",
    "(o_orderkey * 1299709 + o_custkey * 101) % 1000 AS h3",
    "(o_custkey * 15485863 + 7) % 1000 AS h4",
]
RISK = [
    "CASE WHEN h1 < 400 THEN 0L WHEN h1 < 750 THEN 330L WHEN h1 < 930 THEN 660L ELSE 1000L END + h2 % 80 AS rf",
    "int(30 + h4 % 66) AS age",
]
MEASURES = [
    "h1",
    "h2",
    "h3",
    "concat('P', o_custkey) AS patient_id",
    "concat('E', o_orderkey) AS encounter_id",
    "ts",
    "age",
    "CASE WHEN h4 % 25 = 0 THEN 'Other' WHEN h4 % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
    "double(160 + h3 % 250) / 10D AS bmi",
    "int(64 + age % 30 + (rf * 25) div 1000) AS heart_rate",
    "int(108 + age % 40 + (rf * 35) div 1000) AS systolic_bp",
    "int(70 + age % 20 + (rf * 15) div 1000) AS diastolic_bp",
    "double(366 + (rf * 12) div 1000 + h2 % 5) / 10D AS temperature",
    "int(15 + h3 % 3 + (rf * 8) div 1000) AS respiratory_rate",
    "double(985 - (rf * 80) div 1000 - h2 % 10) / 10D AS oxygen_saturation",
    "double(930 + (rf * 1200) div 1000 + h3 % 150) / 10D AS glucose_level",
    "double(90 + (rf * 250) div 1000 + h2 % 20) / 100D AS creatinine",
    "double(145 - (rf * 50) div 1000 - h3 % 10) / 10D AS hemoglobin",
    "double(65 + (rf * 100) div 1000 + h2 % 20) / 10D AS wbc_count",
    f"array({_DIAGNOSES})[int(h3 % 10)] AS primary_diagnosis",
    "int(h3 % 3 + (rf * 3) div 1000) AS comorbidity_count",
    "CASE WHEN h2 < 450 THEN 'Emergency' WHEN h2 < 800 THEN 'Urgent' ELSE 'Elective' END AS admission_type",
    "CASE WHEN h4 % 20 < 8 THEN 'Private' WHEN h4 % 20 < 13 THEN 'Medicare' WHEN h4 % 20 < 18 THEN 'Medicaid' ELSE 'Uninsured' END AS insurance_type",
    "int(h2 % 2 + (rf * 2) div 1000) AS previous_admissions",
    "int(5 + h1 % 6) AS medication_count",
]


def encounters_from_orders(orders: DataFrame) -> DataFrame:
    """The encounter columns plus the hash columns h1..h3 that the variants need."""
    return (
        orders.selectExpr(*HASHES)
        .selectExpr("*", *RISK)
        .selectExpr(*MEASURES)
        .select("*", risk_score().alias("score"))
        .select("*", risk_label("score").alias("risk_level"))
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def patients_from(orders: DataFrame) -> DataFrame:
    return encounters_from_orders(orders).select(*ENCOUNTER_SCHEMA)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: one row per encounter, 23 columns."""
    return patients_from(_orders(spark, sf_dir))


def patients_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PN: P with NULL glucose, gender and BMI and with zero pressure on some rows."""
    return patients_with_gaps_from(_orders(spark, sf_dir))


def patients_with_gaps_from(orders: DataFrame) -> DataFrame:
    gaps = {
        "glucose_level": F.when(F.col("h2") % 50 != 0, F.col("glucose_level")),
        "gender": F.when(F.col("h1") % 50 != 0, F.col("gender")),
        "bmi": F.when(F.col("h3") % 50 != 0, F.col("bmi")),
        "systolic_bp": F.when(F.col("h3") % 97 == 0, F.lit(0)).otherwise(F.col("systolic_bp")),
    }
    return encounters_from_orders(orders).withColumns(gaps).select(*ENCOUNTER_SCHEMA)


def baseline_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients(spark, sf_dir).filter(F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))


def live_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients(spark, sf_dir).filter(F.col("ts") >= F.lit(BASELINE_END).cast("timestamp_ntz"))


def drifted_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LV with degraded vitals from DRIFT_START on, and a flag for those rows."""
    flag = F.col("ts") >= F.lit(DRIFT_START).cast("timestamp_ntz")
    live = live_slice(spark, sf_dir).withColumn("drift_applied", flag)
    return perturb(live, "vital_degradation", when=F.col("drift_applied"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR: ids, actual and predicted label, and one probability column per label."""
    return predictions_from(_orders(spark, sf_dir))


def predictions_from(orders: DataFrame) -> DataFrame:
    shifted = F.col("score") + (F.col("h2") % 3).cast("int") - 1
    closeness = {
        name: F.lit(1.0) / (F.lit(1.0) + F.abs(F.col("score") - centre).cast("double"))
        for name, centre in CLASS_CENTRES.items()
    }
    total = closeness["LOW"] + closeness["MEDIUM"] + closeness["HIGH"] + closeness["CRITICAL"]
    return encounters_from_orders(orders).select(
        "patient_id",
        "encounter_id",
        "ts",
        "admission_type",
        "insurance_type",
        "risk_level",
        label_by_cutpoints(shifted, RISK_CUTPOINTS, RISK_LABELS).alias("predicted"),
        *[(c / total).alias(f"p_{name.lower()}") for name, c in closeness.items()],
    )


def inference_log(spark: SparkSession, sf_dir: str, prefix: str = LOG_PREFIX) -> DataFrame:
    """LOG: timestamp and one JSON object per encounter, as a serving layer captures it."""
    featured = feature_frame(
        encounters_from_orders(_orders(spark, sf_dir)), severity="serve", bmi="serve"
    )
    function_name = F.when(F.col("h1") % 20 == 0, "explain").otherwise("predict")
    return capture_log(
        featured, "risk_level", prefix=prefix, function_name=function_name, keep=["encounter_id"]
    )
