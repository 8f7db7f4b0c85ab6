"""Names and limits shared by the whole package."""

# --- fixed values: they must equal the documented encounter model ---------------------------
RAW_NUMERIC = [
    "age",
    "bmi",
    "heart_rate",
    "systolic_bp",
    "diastolic_bp",
    "temperature",
    "respiratory_rate",
    "oxygen_saturation",
    "glucose_level",
    "creatinine",
    "hemoglobin",
    "wbc_count",
    "comorbidity_count",
    "previous_admissions",
    "medication_count",
]
RAW_CATEGORICAL = ["gender", "primary_diagnosis", "admission_type", "insurance_type"]
COMPUTED_NUMERIC = ["shock_index", "pulse_pressure", "vital_signs_severity"]
COMPUTED_CATEGORICAL = ["bmi_category"]
TARGET = "risk_level"
RISK_LABELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ADMISSION_TYPES = ["Emergency", "Urgent", "Elective"]
SEGMENT_COLUMNS = ["admission_type", "insurance_type"]
PROMOTION_THRESHOLDS = {"accuracy": 0.80, "f1_macro": 0.75}
DRIFT_RULES = [
    # (rule name, monitored column, metric, threshold)
    ("risk_level_drift", "risk_level", "psi", 0.25),
    ("vital_signs_severity_drift", "vital_signs_severity", "psi", 0.20),
]
SEARCH_SPACE = {
    "n_estimators": {"type": "randint", "lower": 50, "upper": 500},
    "max_depth": {"type": "randint", "lower": 3, "upper": 20},
    "learning_rate": {"type": "loguniform", "lower": 0.0001, "upper": 0.3},
    "subsample": {"type": "uniform", "lower": 0.5, "upper": 1.0},
    "colsample_bytree": {"type": "uniform", "lower": 0.5, "upper": 1.0},
    "reg_alpha": {"type": "loguniform", "lower": 0.00001, "upper": 10.0},
    "reg_lambda": {"type": "loguniform", "lower": 0.00001, "upper": 10.0},
}
ENCOUNTER_SCHEMA = {
    "patient_id": "string",
    "encounter_id": "string",
    "ts": "timestamp_ntz",
    "age": "int",
    "gender": "string",
    "bmi": "double",
    "heart_rate": "int",
    "systolic_bp": "int",
    "diastolic_bp": "int",
    "temperature": "double",
    "respiratory_rate": "int",
    "oxygen_saturation": "double",
    "glucose_level": "double",
    "creatinine": "double",
    "hemoglobin": "double",
    "wbc_count": "double",
    "primary_diagnosis": "string",
    "comorbidity_count": "int",
    "admission_type": "string",
    "insurance_type": "string",
    "previous_admissions": "int",
    "medication_count": "int",
    "risk_level": "string",
}
# ---------------------------------------------------------------------------------------------

RAW_FEATURES = RAW_NUMERIC + RAW_CATEGORICAL
MODEL_NUMERIC = RAW_NUMERIC + COMPUTED_NUMERIC
MODEL_CATEGORICAL = RAW_CATEGORICAL + COMPUTED_CATEGORICAL
MODEL_FEATURES = MODEL_NUMERIC + MODEL_CATEGORICAL
