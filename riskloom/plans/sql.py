"""SQL text shared by the checks: the derived encounter frames as common table expressions."""

from __future__ import annotations

from riskloom.constants import ENCOUNTER_SCHEMA, MODEL_CATEGORICAL, MODEL_NUMERIC, RAW_NUMERIC

D = "CAST({} AS DOUBLE)".format


def half_up(expr: str, digits: int) -> str:
    scale = D(10**digits)
    return f"(floor(({expr}) * {scale} + {D(0.5)}) / {scale})"


SEVERITY_TRAIN = f"""(
  CASE WHEN heart_rate > 100 OR heart_rate < 50 THEN 1 ELSE 0 END
  + CASE WHEN systolic_bp > 180 OR systolic_bp < 90 THEN 2 ELSE 0 END
  + CASE WHEN oxygen_saturation < 92 THEN 2 WHEN oxygen_saturation < 95 THEN 1 ELSE 0 END
  + CASE WHEN respiratory_rate > 24 THEN 1 ELSE 0 END
  + CASE WHEN temperature > {D(38.5)} OR temperature < 36 THEN 1 ELSE 0 END)"""

SEVERITY_SERVE = f"""(
  CASE WHEN heart_rate > 100 THEN 1 ELSE 0 END + CASE WHEN heart_rate < 60 THEN 1 ELSE 0 END
  + CASE WHEN respiratory_rate > 20 THEN 1 ELSE 0 END
  + CASE WHEN oxygen_saturation < 94 THEN 2 ELSE 0 END
  + CASE WHEN temperature > {D(38.0)} THEN 1 ELSE 0 END
  + CASE WHEN systolic_bp < 90 THEN 2 ELSE 0 END + CASE WHEN systolic_bp > 180 THEN 1 ELSE 0 END)"""

BMI_TRAIN = f"""CASE WHEN bmi < {D(18.5)} THEN 'UNDERWEIGHT' WHEN bmi < 25 THEN 'NORMAL'
  WHEN bmi < 30 THEN 'OVERWEIGHT' ELSE 'OBESE' END"""

BMI_SERVE = f"""CASE WHEN bmi > 0 AND bmi <= {D(18.5)} THEN 'UNDERWEIGHT'
  WHEN bmi > {D(18.5)} AND bmi <= 25 THEN 'NORMAL' WHEN bmi > 25 AND bmi <= 30 THEN 'OVERWEIGHT'
  WHEN bmi > 30 AND bmi <= 35 THEN 'OBESE' WHEN bmi > 35 AND bmi <= 100 THEN 'SEVERELY_OBESE'
  ELSE 'nan' END"""

SHOCK = "CASE WHEN systolic_bp > 0 THEN CAST(heart_rate AS DOUBLE) / CAST(systolic_bp AS DOUBLE) END"

SCORE = f"""({SEVERITY_TRAIN}
  + CASE WHEN age >= 75 THEN 2 WHEN age >= 65 THEN 1 ELSE 0 END
  + CASE WHEN glucose_level > 200 THEN 1 ELSE 0 END
  + CASE WHEN creatinine > 2 THEN 2 WHEN creatinine > {D(1.5)} THEN 1 ELSE 0 END
  + CASE WHEN hemoglobin < 10 THEN 1 ELSE 0 END
  + CASE WHEN wbc_count > 12 OR wbc_count < 4 THEN 1 ELSE 0 END
  + CASE WHEN comorbidity_count >= 4 THEN 2 WHEN comorbidity_count >= 2 THEN 1 ELSE 0 END
  + CASE WHEN previous_admissions >= 3 THEN 2 WHEN previous_admissions >= 1 THEN 1 ELSE 0 END)"""


def label(score: str) -> str:
    return (
        f"CASE WHEN {score} <= 2 THEN 'LOW' WHEN {score} <= 5 THEN 'MEDIUM' "
        f"WHEN {score} <= 8 THEN 'HIGH' ELSE 'CRITICAL' END"
    )


P_CTE = f"""hashed AS (
  SELECT o_orderkey, o_custkey, o_orderdate AS ts,
    (o_orderkey * 7919 + o_custkey * 31) % 1000 AS h1, (o_orderkey * 104729 + 17) % 1000 AS h2,
    (o_orderkey * 1299709 + o_custkey * 101) % 1000 AS h3, (o_custkey * 15485863 + 7) % 1000 AS h4
  FROM orders),
risky AS (
  SELECT *, CAST(30 + h4 % 66 AS INTEGER) AS age,
    (CASE WHEN h1 < 400 THEN 0 WHEN h1 < 750 THEN 330 WHEN h1 < 930 THEN 660 ELSE 1000 END)
      + h2 % 80 AS rf
  FROM hashed),
raw AS (
  SELECT h1, h2, h3, 'P' || o_custkey AS patient_id, 'E' || o_orderkey AS encounter_id, ts, age,
    CASE WHEN h4 % 25 = 0 THEN 'Other' WHEN h4 % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    CAST(160 + h3 % 250 AS DOUBLE) / 10 AS bmi,
    CAST(64 + age % 30 + (rf * 25) // 1000 AS INTEGER) AS heart_rate,
    CAST(108 + age % 40 + (rf * 35) // 1000 AS INTEGER) AS systolic_bp,
    CAST(70 + age % 20 + (rf * 15) // 1000 AS INTEGER) AS diastolic_bp,
    CAST(366 + (rf * 12) // 1000 + h2 % 5 AS DOUBLE) / 10 AS temperature,
    CAST(15 + h3 % 3 + (rf * 8) // 1000 AS INTEGER) AS respiratory_rate,
    CAST(985 - (rf * 80) // 1000 - h2 % 10 AS DOUBLE) / 10 AS oxygen_saturation,
    CAST(930 + (rf * 1200) // 1000 + h3 % 150 AS DOUBLE) / 10 AS glucose_level,
    CAST(90 + (rf * 250) // 1000 + h2 % 20 AS DOUBLE) / 100 AS creatinine,
    CAST(145 - (rf * 50) // 1000 - h3 % 10 AS DOUBLE) / 10 AS hemoglobin,
    CAST(65 + (rf * 100) // 1000 + h2 % 20 AS DOUBLE) / 10 AS wbc_count,
    CASE h3 % 10 WHEN 0 THEN 'I10' WHEN 1 THEN 'E11' WHEN 2 THEN 'J44' WHEN 3 THEN 'I25'
      WHEN 4 THEN 'N18' WHEN 5 THEN 'I50' WHEN 6 THEN 'J18' WHEN 7 THEN 'A41' WHEN 8 THEN 'K92'
      ELSE 'I63' END AS primary_diagnosis,
    CAST(h3 % 3 + (rf * 3) // 1000 AS INTEGER) AS comorbidity_count,
    CASE WHEN h2 < 450 THEN 'Emergency' WHEN h2 < 800 THEN 'Urgent' ELSE 'Elective' END AS admission_type,
    CASE WHEN h4 % 20 < 8 THEN 'Private' WHEN h4 % 20 < 13 THEN 'Medicare'
      WHEN h4 % 20 < 18 THEN 'Medicaid' ELSE 'Uninsured' END AS insurance_type,
    CAST(h2 % 2 + (rf * 2) // 1000 AS INTEGER) AS previous_admissions,
    CAST(5 + h1 % 6 AS INTEGER) AS medication_count
  FROM risky),
scored AS (SELECT *, CAST({SCORE} AS INTEGER) AS score FROM raw),
full_p AS (SELECT *, {label('score')} AS risk_level FROM scored),
p AS (SELECT {', '.join(ENCOUNTER_SCHEMA)} FROM full_p)"""

_GAPS = {
    "glucose_level": "CASE WHEN h2 % 50 <> 0 THEN glucose_level END",
    "gender": "CASE WHEN h1 % 50 <> 0 THEN gender END",
    "bmi": "CASE WHEN h3 % 50 <> 0 THEN bmi END",
    "systolic_bp": "CASE WHEN h3 % 97 = 0 THEN 0 ELSE systolic_bp END",
}
PN_CTE = "pn AS (SELECT {} FROM full_p)".format(
    ", ".join(f"{_GAPS[c]} AS {c}" if c in _GAPS else c for c in ENCOUNTER_SCHEMA)
)

PR_CTE = f"""pr0 AS (
  SELECT *, score + CAST(h2 % 3 AS INTEGER) - 1 AS shifted,
    1 / (1 + abs(CAST(score - 1 AS DOUBLE))) AS w_low, 1 / (1 + abs(CAST(score - 4 AS DOUBLE))) AS w_medium,
    1 / (1 + abs(CAST(score - 7 AS DOUBLE))) AS w_high, 1 / (1 + abs(CAST(score - 11 AS DOUBLE))) AS w_critical
  FROM full_p),
pr AS (
  SELECT patient_id, encounter_id, ts, admission_type, insurance_type, risk_level,
    {label('shifted')} AS predicted,
    w_low / (w_low + w_medium + w_high + w_critical) AS p_low,
    w_medium / (w_low + w_medium + w_high + w_critical) AS p_medium,
    w_high / (w_low + w_medium + w_high + w_critical) AS p_high,
    w_critical / (w_low + w_medium + w_high + w_critical) AS p_critical
  FROM pr0)"""

VITALS_DEGRADED = f"""
  least(180, CAST(floor(CAST(heart_rate AS DOUBLE) * {D(1.15)}) AS INTEGER)) AS heart_rate,
  least(220, CAST(floor(CAST(systolic_bp AS DOUBLE) * {D(1.1)}) AS INTEGER)) AS systolic_bp,
  greatest(oxygen_saturation - {D(3)}, {D(70)}) AS oxygen_saturation"""

SLICES_CTE = f"""bl AS (SELECT * FROM p WHERE ts < TIMESTAMP '1999-01-01'),
lv AS (SELECT * FROM p WHERE ts >= TIMESTAMP '1999-01-01'),
drifted AS (
  SELECT * REPLACE (
    CASE WHEN drift_applied THEN d_hr ELSE heart_rate END AS heart_rate,
    CASE WHEN drift_applied THEN d_sbp ELSE systolic_bp END AS systolic_bp,
    CASE WHEN drift_applied THEN d_spo2 ELSE oxygen_saturation END AS oxygen_saturation)
  FROM (SELECT *, ts >= TIMESTAMP '2000-06-01' AS drift_applied,
    least(180, CAST(floor(CAST(heart_rate AS DOUBLE) * {D(1.15)}) AS INTEGER)) AS d_hr,
    least(220, CAST(floor(CAST(systolic_bp AS DOUBLE) * {D(1.1)}) AS INTEGER)) AS d_sbp,
    greatest(oxygen_saturation - {D(3)}, {D(70)}) AS d_spo2 FROM lv))"""

ENGINEERED_TRAIN = f"""{SHOCK} AS shock_index, systolic_bp - diastolic_bp AS pulse_pressure,
  {BMI_TRAIN} AS bmi_category, {SEVERITY_TRAIN} AS vital_signs_severity"""
ENGINEERED_SERVE = f"""{SHOCK} AS shock_index, systolic_bp - diastolic_bp AS pulse_pressure,
  {BMI_SERVE} AS bmi_category, {SEVERITY_SERVE} AS vital_signs_severity"""
F_CTE = f"f AS (SELECT *, {ENGINEERED_TRAIN} FROM p)"
FLAT_CTE = (
    "flat AS (SELECT encounter_id, ts, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_NUMERIC)
    + ", "
    + ", ".join(MODEL_CATEGORICAL)
    + f", risk_level FROM (SELECT *, {ENGINEERED_SERVE} FROM full_p WHERE h1 % 20 <> 0))"
)

ENCOUNTERS = ", ".join(ENCOUNTER_SCHEMA)


def over_p(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([P_CTE, *more]) + "\n" + body


def over_pn(body: str, *more: str) -> str:
    return over_p(body, PN_CTE, *more)


def over_pr(body: str, *more: str) -> str:
    return over_p(body, PR_CTE, *more)


def over_slices(body: str, *more: str) -> str:
    return over_p(body, SLICES_CTE, *more)


def as_doubles(columns=RAW_NUMERIC) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)

