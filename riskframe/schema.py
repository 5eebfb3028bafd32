"""Feature specs, rule tables and thresholds (plain data).

Operators take column names as parameters; nothing here is tied to one
schema. The constants below are fixed values of the behaviour we
reproduce and must not drift.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    label: str | None = None
    id_cols: tuple[str, ...] = ()

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class RangeRule:
    column: str
    low: float
    high: float


@dataclass(frozen=True)
class InversionRule:
    """``low_col > high_col`` is a contradiction (e.g. diastolic > systolic)."""
    high_col: str
    low_col: str


@dataclass(frozen=True)
class ValidationRules:
    """Record validation: inclusive numeric ranges and closed enums."""
    ranges: tuple[RangeRule, ...] = ()
    enums: tuple[tuple[str, tuple], ...] = field(default_factory=tuple)


# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour we reproduce)
# ---------------------------------------------------------------------------

# Raw contract of the clinical table: required column names.
RAW_COLUMNS = ("id", "age", "gender", "height", "weight", "ap_hi", "ap_lo",
               "cholesterol", "gluc", "smoke", "alco", "active", "cardio")
CLINICAL_NUMERIC = ("age_years", "height", "weight", "ap_hi", "ap_lo", "bmi")
CLINICAL_CATEGORICAL = ("gender", "cholesterol", "gluc", "smoke", "alco", "active")
CLINICAL_LABEL = "cardio"

# Plausible ranges for the quality report (inclusive ends are valid).
CLINICAL_BOUNDS = (
    RangeRule("ap_hi", 80.0, 220.0),
    RangeRule("ap_lo", 40.0, 140.0),
    RangeRule("height", 140.0, 210.0),
    RangeRule("weight", 35.0, 200.0),
    RangeRule("bmi", 14.0, 60.0),
    RangeRule("age_years", 25.0, 75.0),
)
CLINICAL_INVERSION = InversionRule(high_col="ap_hi", low_col="ap_lo")

# Scoring request contract: inclusive ranges and enums.
REQUEST_RULES = ValidationRules(
    ranges=(
        RangeRule("age_years", 18.0, 100.0),
        RangeRule("height", 120.0, 230.0),
        RangeRule("weight", 30.0, 250.0),
        RangeRule("ap_hi", 60.0, 260.0),
        RangeRule("ap_lo", 30.0, 180.0),
    ),
    enums=(
        ("gender", (1, 2)),
        ("cholesterol", (1, 2, 3)),
        ("gluc", (1, 2, 3)),
        ("smoke", (0, 1)),
        ("alco", (0, 1)),
        ("active", (0, 1)),
    ),
)
REQUEST_MAX_RECORDS = 1000

# Quality severities and issue descriptions.
SEVERITY_LOW, SEVERITY_MEDIUM, SEVERITY_HIGH = "baixa", "media", "alta"
DESC_MISSING = "Presenca de valores ausentes"
DESC_DUPLICATES = "Linhas duplicadas em features+target"
DESC_RANGE = "Valores fora do intervalo fisiologico plausivel [{low}, {high}]"
DESC_INVERSION = "Pressao diastolica maior que sistolica (inversao)"
DATASET_COLUMN = "<dataset>"
RANGE_HIGH_SEVERITY_SHARE = 0.01

# Drift: PSI verdict thresholds and labels.
PSI_STABLE = 0.10
PSI_MODERATE = 0.25
VERDICT_STABLE, VERDICT_MODERATE, VERDICT_DRIFT = "estavel", "moderado", "drift"
PSI_BINS = 10
PSI_EPSILON = 1e-6

# Risk bands on the positive-class probability.
RISK_LOW_BELOW = 0.35
RISK_MODERATE_BELOW = 0.65
RISK_LOW, RISK_MODERATE, RISK_HIGH = "baixo", "moderado", "alto"
CLASS_THRESHOLD = 0.5

# Error costs per case.
COST_FALSE_NEGATIVE = 5.0
COST_FALSE_POSITIVE = 1.0

# Run selection weights.
WEIGHT_PERFORMANCE = 0.60
WEIGHT_ROBUSTNESS = 0.25
WEIGHT_EFFICIENCY = 0.15
BASELINE_FAMILY = "dummy"
RUN_FINISHED = "FINISHED"
DIM_TECHNIQUES = ("none", "pca", "lda")
RUN_NAME_SUFFIX = {"none": "raw", "pca": "pca", "lda": "lda"}

# Lifecycle alert table: metric -> allowed drop vs baseline (strict >).
METRIC_ALERT_DROPS = (
    ("tech.accuracy", 0.03),
    ("tech.precision", 0.03),
    ("tech.recall", 0.05),
    ("tech.f1", 0.03),
    ("tech.roc_auc", 0.02),
    ("tech.average_precision", 0.03),
)
RETRAIN_PSI = 0.25
RETRAIN_MIN_FEATURES = 2
RETRAIN_FEATURES = ("ap_hi", "age_years", "bmi", "cholesterol")
RETRAIN_RECALL_DROP = 0.05
RETRAIN_MAX_AGE_DAYS = 182
ROLLING_DAYS = 30
REFERENCE_WINDOW_DAYS = 28
CANARY_SHARE = 0.10
EXPLORATION_SHARE = 0.05

# Derived-column constants.
DAYS_PER_YEAR = 365.25
BMI_CLASS_CUTS = (18.5, 25.0, 30.0)
BMI_CLASS_LABELS = ("abaixo", "normal", "sobrepeso", "obeso")
# Blood-pressure categories, checked highest band first.
BP_CATEGORIES = (
    ("crise", 180.0, 120.0),        # systolic > 180 or diastolic > 120
    ("hipertensao_2", 140.0, 90.0),  # systolic >= 140 or diastolic >= 90
    ("hipertensao_1", 130.0, 80.0),  # systolic 130-139 or diastolic 80-89
    ("elevada", 120.0, 80.0),        # systolic 120-129 and diastolic < 80
    ("normal", None, None),
)
CLEANING_RULES = {
    "ap_hi": (0.0, 300.0),
    "ap_lo": (0.0, 200.0),
    "height": (100.0, 220.0),
    "weight": (30.0, 200.0),
}

# fixed values: points of the learners' searches, and how many of them a random search tries
SEARCH_C = (0.01, 0.1, 1.0, 10.0)
SEARCH_POINTS = {
    "decision_tree": {"maxDepth": (3, 5, 7, 10, 30), "minInstancesPerNode": (1, 2, 5, 10), "impurity": ("gini", "entropy")},
    "random_forest": {"numTrees": (100, 200, 400), "maxDepth": (5, 10, 20, 30), "minInstancesPerNode": (1, 2, 5),
                      "featureSubsetStrategy": ("sqrt", "log2")},
    "xgboost": {"maxIter": (200, 400, 600), "maxDepth": (3, 5, 7), "stepSize": (0.05, 0.1, 0.2),
                "subsamplingRate": (0.7, 0.85, 1.0), "featureSubsetStrategy": ("0.7", "0.85", "1.0")},
}
SEARCH_BUDGETS = {"random_forest": 12, "xgboost": 15}
