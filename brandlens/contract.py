"""Fixed values of the data and feature contract."""

from __future__ import annotations

from collections.abc import Iterable

# --- fixed values: schema -------------------------------------------------
CANONICAL_COLUMNS = [
    "name", "country_origin", "domain", "price_category", "founded", "presence_world",
    "presence_russia", "presence_regions", "description", "plans", "total_rented_area",
]
MISSPELLED_COUNTRY = "contry_origin"
REQUIRED_COLUMNS = [
    "name", "description", "price_category", "country_origin", "domain", "presence_world",
    "presence_russia", "presence_regions", "plans", "founded",
]
TARGET_COLUMNS = ["domain", "founded", "price_category"]
NUMERIC_SOURCE_COLUMNS = ["presence_world", "plans", "founded", "total_rented_area"]

# Words a CSV reader of the pandas family turns into null.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Words the result view treats as missing text.
MISSING_WORDS = ["", "none", "nan", "null", "<na>"]

# --- fixed values: targets ------------------------------------------------
UNKNOWN_DOMAIN = "Неизвестно"
UNKNOWN_COUNTRY = "Неизвестно"
UNKNOWN_PRICE_LABEL = "неизвестно"
KNOWN_PRICE_LABELS = ["дисконт", "ниже среднего", "средний", "выше среднего", "люкс / премиум"]
MIN_FOUNDED_YEAR = 1850
MAX_FOUNDED_YEAR = 2025
MIN_CLASS_ROWS = 5
CV_FOLDS = 5
SEED = 42

# --- fixed values: text rules ---------------------------------------------
COUNTRY_SYNONYMS = {
    "россия": "Россия",
    "росия": "Россия",
    "россии": "Россия",
    "республика беларусь": "Республика Беларусь",
    "беларусь": "Республика Беларусь",
    "usa": "США",
    "америка": "США",
    "сша": "США",
}
LEGAL_FORMS = ["ооо", "зао", "ип", "оао", "ooo", "zao"]
FRANCHISE_STEM = "франчайз"

# --- fixed values: dashboard ----------------------------------------------
DOMAIN_ALIASES = {
    "Ремонт и строительство": "Ремонт",
    "Товары и услуги для детей": "Детские товары",
}
HIGHLIGHT_BRAND = "Etam"
HIGHLIGHT_LABEL = "Etam — high presence, low expansion"

# --- fixed values: feature contract ---------------------------------------
FEATURE_CONTRACT_VERSION = "inference_safe_v1"
TEXT_FEATURES = ["description", "name_clean"]
CATEGORICAL_FEATURES = ["country_origin"]
NUMERIC_FEATURES = [
    "presence_world", "plans", "presence_own", "presence_franchise", "n_regions", "desc_len",
    "desc_has_digits", "desc_year_mentions",
]
SAFE_FEATURES = ["description", "name_clean", "country_origin", *NUMERIC_FEATURES]
FORBIDDEN_FEATURES = ["domain", "founded", "price_category", "total_rented_area", "has_total_rented_area"]

# --- fixed values: threshold grids ----------------------------------------
# The raw floats decide the comparison; reports show them rounded to two digits.
THRESHOLD_GRID = [
    0.2, 0.25, 0.3, 0.35, 0.39999999999999997, 0.44999999999999996, 0.49999999999999994,
    0.5499999999999999, 0.5999999999999999, 0.6499999999999999, 0.7, 0.7499999999999998,
    0.7999999999999998,
]

# The older, wider grid.
OLD_THRESHOLD_GRID = [
    0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006, 0.30000000000000004, 0.3500000000000001,
    0.40000000000000013, 0.45000000000000007, 0.5000000000000001, 0.5500000000000002, 0.6000000000000002, 0.6500000000000001,
    0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002, 0.9000000000000002,
]

# --- fixed values: acceptance policy --------------------------------------
POLICY_VERSION = "model_quality_v1"
MODELS = ["domain", "founded", "price_category"]
POLICY = [
    ("domain", "cv_best_macro_f1", ">=", 0.45),
    ("domain", "holdout_macro_f1", ">=", 0.45),
    ("domain", "cv_uplift_over_baseline", ">=", 0.30),
    ("domain", "cv_std_macro_f1", "<=", 0.05),
    ("domain", "generalization_gap_macro_f1", ">=", -0.08),
    ("founded", "cv_mae_improvement_over_baseline_pct", ">=", 0.10),
    ("founded", "holdout_mae", "<=", 10.5),
    ("founded", "holdout_r2", ">=", 0.20),
    ("founded", "holdout_p90_absolute_error", "<=", 25.0),
    ("founded", "generalization_gap_mae", "<=", 2.0),
    ("price_category", "cv_best_macro_f1", ">=", 0.35),
    ("price_category", "cv_uplift_over_baseline", ">=", 0.15),
    ("price_category", "holdout_serving_macro_f1", ">=", 0.35),
    ("price_category", "holdout_serving_micro_f1", ">=", 0.65),
    ("price_category", "holdout_serving_samples_f1", ">=", 0.65),
    ("price_category", "generalization_gap_macro_f1", ">=", -0.07),
    ("price_category", "serving_macro_drop_vs_direct", "<=", 0.02),
]


def check_feature_contract(columns: Iterable[str]) -> None:
    """Raise unless the columns hold every safe feature and no target-like one."""
    present = set(columns)
    forbidden = sorted(present.intersection(FORBIDDEN_FEATURES))
    if forbidden:
        raise ValueError(f"Feature contract violation: target-like columns {forbidden}")
    missing = [c for c in SAFE_FEATURES if c not in present]
    if missing:
        raise ValueError(f"Feature contract violation. Missing inference-safe features: {missing}")


def label_column(label: str) -> str:
    """Label text made safe for use in a column name."""
    return label.replace(" / ", "_").replace(" ", "_").replace("-", "_")
