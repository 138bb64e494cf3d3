"""Fixed values.

Each of these has to be exactly as stated for results to be right, so they are
kept together and in the open.
"""

from __future__ import annotations

# ---- fixed values: contract -------------------------------------------------
FIELD_TYPES = ("integer", "timestamp", "categorical", "target")
INTEGER_PATTERN = r"^-?[0-9]+$"
POSITIVE_CLASS = 2

# ---- fixed values: text -----------------------------------------------------
# Characters that separate tokens, and those that end a line.
WHITESPACE = (
    r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# ---- fixed values: decisions ------------------------------------------------
APPROVE_BELOW = 0.3
REVIEW_UP_TO = 0.7
DECISION_THRESHOLD = 0.30
CLASSIFY_ABOVE = 0.5

# ---- fixed values: temporal split -------------------------------------------
TRAIN_SHARE = 0.6
TRAIN_AND_CALIBRATION_SHARE = 0.8

# ---- fixed values: drift and feature check ----------------------------------
PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_ALERT = 0.2
KS_ALERT = 0.1
MEAN_SHIFT_STDS = 3.0
MEAN_SHIFT_RELATIVE = 0.30
MISSING_SHARE_CHANGE = 0.20
TARGET_RATE_WARNING = 0.05
TREND_HEAD = 10

# ---- fixed values: serving --------------------------------------------------
RATE_WINDOW_SECONDS = 60
RATE_LIMIT = 60
PREDICTION_TIME_LIMIT = 2.0
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
SCORE_DECIMALS = 6
LATENCY_DECIMALS = 2

# ---- fixed values: finance --------------------------------------------------
LOSS_PER_DEFAULT = 1000.0
PROCESSING_COST = 50.0
APPROVAL_MARGIN = 1.15
REVIEW_MARGIN = 0.8
REVIEW_FAILURE_RATE = 0.5
INTEREST_RATE = 0.15

# ---- fixed values: model ----------------------------------------------------
MODEL_VERSION = "v1"
INVERSE_REGULARISATION = 0.01
MAX_ITERATIONS = 1000
CALIBRATION_BINS = 10

# ---- fixed values: governance policy ----------------------------------------
MINIMUM_ROC_AUC = 0.8
MAXIMUM_CALIBRATION_GAP = 0.1

# ---- fixed values: perturbation ---------------------------------------------
NOISE_FRACTION = 0.05
MISSING_FRACTION = 0.1
LABEL_DELAY_DAYS = 30
SEED = 42
BAD_CATEGORY = "A999"
EXTRA_TOKEN = "X"

# ---- fixed values: ranges a scoring request must keep ------------------------
REQUEST_RANGES = {
    "duration_months": (1, 120),
    "credit_amount": (1, 100000),
    "installment_rate": (1, 4),
    "residence_since": (1, 4),
    "age": (18, 120),
    "existing_credits": (1, 4),
    "num_liable": (1, 2),
}
