"""Names, patterns, cut-offs and lists the results depend on.

Everything here is data, not logic. Changing an entry changes results.
"""

from __future__ import annotations

# --- Fixed values: text that stands for a missing value in a CSV file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: which dictionary entries count as nutrition labs.
LAB_FLUID = "blood"
LAB_LABEL_PATTERNS = [
    "%albumin", "hemoglobin", "hema%", "phos%", "%glucose%", "%potassium%", "%magnesium%",
    "Alk%", "Aspar%", "prealb%", "c-%",
]

# --- Fixed values: lab label -> output column (maximum within the window).
LAB_MEASURES = {
    "albumin_admit": "Albumin",
    "alkaline_phosphatase_admit": "Alkaline Phosphatase",
    "asparate_aminotransferase_admit": "Asparate Aminotransferase",
    "asparate_aminotransferase_ast_admit": "Asparate Aminotransferase (AST)",
    "c_reactive_protein_admit": "C-Reactive Protein",
    "glucose_admit": "Glucose",
    "glucose_whole_blood_admit": "Glucose, Whole Blood",
    "hematocrit_admit": "Hematocrit",
    "hematocrit_calculated_admit": "Hematocrit, Calculated",
    "hemoglobin_admit": "Hemoglobin",
    "magnesium_admit": "Magnesium",
    "phosphate_admit": "Phosphate",
    "potassium_admit": "Potassium",
    "potassium_whole_blood_admit": "Potassium, Whole Blood",
}
LAB_WINDOW_HOURS = 24

# --- Fixed values: observation name pattern -> output column (first value per patient).
OBSERVATION_MEASURES = {
    "height_in": "%height%",
    "weight_lb": "%weight%",
    "bmi": "%bmi%",
    "blood_pressure": "%blood%",
}
OBSERVATION_TEXT_MEASURES = ["blood_pressure"]

# --- Fixed values: diagnosis code patterns that set the label.
LABEL_CODE_PATTERNS = ["E4%", "263%"]
LABEL_COLUMN = "has_malnutrition"

# --- Fixed values: cleaning.
POUNDS_PER_KG = 2.2
CM_PER_INCH = 2.54
MIN_HEIGHT_CM_EXCLUSIVE = 121.0
MISSING_MARITAL_STATUS = "UNKNOWN"
COLUMNS_TO_DROP = [
    "hadm_id:1", "asparate_aminotransferase_admit", "glucose_whole_blood_admit",
    "potassium_whole_blood_admit", "albumin_admit", "subject_id:1",
]

# --- Fixed values: model columns, in order.
FEATURES_TO_USE = [
    "has_malnutrition", "age", "gender", "race", "marital_status", "height_cm", "weight_kg", "bmi",
    "glucose_admit", "hematocrit_admit", "hemoglobin_admit", "potassium_admit", "systolic",
    "diastolic", "admission_type", "admission_location", "alk_phos_ordered", "ast_ordered",
]

# --- Fixed values: category groups. Rules are tried in order, the first hit names the group.
# Each rule is (group, [(test, text), ...]); a rule hits when any of its tests does.
RACE_GROUPS = [
    ("hispanic", [("contains", "HISPANIC"), ("contains", "LATINO")]),
    ("black", [("startswith", "BLACK")]),
    ("white", [("startswith", "WHITE"), ("equals", "PORTUGUESE")]),
    ("unknown/declined", [("equals", "UNKNOWN"), ("equals", "UNABLE TO OBTAIN"),
                          ("equals", "PATIENT DECLINED TO ANSWER")]),
]
RACE_DEFAULT = "other"
ADMIT_TYPE_GROUPS = [
    ("observation", [("contains", "OBSERVATION")]),
    ("urgent_care", [("contains", "URGENT")]),
    ("emergency", [("contains", "EMER")]),
    ("elective", [("startswith", "ELECTIVE")]),
    ("surgical_admit", [("startswith", "SURGICAL")]),
]
ADMIT_TYPE_DEFAULT = "other"
ADMIT_LOCATION_GROUPS = [
    ("snf", [("contains", "NURSING")]),
    ("internal", [("contains", "ROOM"), ("contains", "PACU"), ("contains", "SITE"),
                  ("contains", "PSYCH")]),
    ("hospital", [("contains", "HOSPITAL")]),
    ("referral", [("startswith", "PHYSI"), ("startswith", "CLINIC")]),
    ("walkin", [("startswith", "WALK")]),
]
ADMIT_LOCATION_DEFAULT = "other_unknown"

# --- Fixed values: imputation.
MATCHING_NUMERIC = ["age", "height_cm", "weight_kg"]
MATCHING_CATEGORY = "gender"
IMPUTED_COLUMNS = ["height_cm", "weight_kg"]
NEIGHBOURS = 5

# --- Fixed values: inclusive ranges (low, high, null allowed) and allowed values.
RANGE_RULES = {
    "age": (18, 99, False),
    "height_cm": (120, 210, False),
    "weight_kg": (30, 300, False),
    "bmi": (10, 80, False),
    "glucose_admit": (20, 2000, True),
    "hematocrit_admit": (3, 70, True),
    "hemoglobin_admit": (1.5, 23, True),
    "potassium_admit": (1.0, 10.0, True),
    "systolic": (40, 280, True),
    "diastolic": (15, 180, True),
    "alk_phos_ordered": (0, 1, True),
    "ast_ordered": (0, 1, True),
}
DOMAIN_RULES = {
    "has_malnutrition": [0, 1],
    "gender": ["M", "F"],
    "marital_status": ["SINGLE", "MARRIED", "DIVORCED", "WIDOWED", "UNKNOWN"],
    "race_grouped": ["hispanic", "black", "white", "unknown/declined", "other"],
    "admit_type_grouped": ["observation", "urgent_care", "emergency", "elective",
                           "surgical_admit", "other"],
    "admit_loc_grouped": ["snf", "internal", "hospital", "referral", "walkin", "other_unknown"],
}

# --- Fixed values: split, training, gate and search settings.
SEED = 42
TEST_FRACTION = 0.2
FOLDS = 3
MODEL_PARAMS = {
    "n_estimators": 100,
    "max_depth": 10,
    "learning_rate": 0.1,
    "class_weight": "balanced",
}
MIN_ACCURACY = 0.35
MIN_F1 = 0.50
SEARCH_ITERATIONS = 64
SEARCH_SCORING = "f1"
SEARCH_SPACE = {
    "n_estimators": [100, 200, 300, 400, 500],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
    "max_depth": [-1, 4, 6, 8, 10],
    "num_leaves": [15, 31, 63, 127],
    "min_child_samples": [5, 10, 20, 30, 50],
    "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
    "reg_alpha": [0, 0.1, 0.5, 1.0],
    "reg_lambda": [0, 0.5, 1.0, 2.0],
    "class_weight": [None, "balanced"],
    "scale_pos_weight": [10, 15, 20],
}
EXPORTED_PARAMS = [
    "n_estimators", "max_depth", "learning_rate", "class_weight", "num_leaves",
    "min_child_samples", "subsample", "colsample_bytree", "reg_alpha", "reg_lambda",
    "scale_pos_weight", "random_state",
]
METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]

# --- Fixed values: drift thresholds.
DRIFT_DISTANCE_THRESHOLD = 0.1
DRIFT_P_THRESHOLD = 0.05
DRIFT_DATASET_SHARE = 0.5
DRIFT_MIN_SCALE = 0.001
