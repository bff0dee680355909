"""Fixed values.

Names, patterns, thresholds and message texts that results depend on. They are
data, stated once, and used by the operators.
"""

# Month tokens in calendar order.
MONTH_TOKENS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

# First calendar month of the fiscal year and the century of two-digit years.
FISCAL_START_MONTH = 4
CENTURY = "20"

# Text read as NULL from a sales file.
NULL_TOKENS = ("", "NULL", "null")

# Accepted text forms.
MONTH_PATTERN = "^(" + "|".join(MONTH_TOKENS) + ")-[0-9]{2}$"
FISCAL_YEAR_PATTERN = "^[0-9]{2}-[0-9]{2}$"
NUMBER_PATTERN = (
    r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"
)

# Columns whose NULLs are reported, in report order.
REQUIRED_COLUMNS = ["material_group", "sold_state", "net_sales", "month", "fy"]

# Largest share of invalid rows (percent) in a batch that still passes.
MAX_ERROR_PERCENT = 5.0

# (rule_name, rule_type, column_name, rule_definition)
VALIDATION_RULES = [
    ("MATERIAL_GROUP_EXISTS", "SCHEMA", "MATERIAL_GROUP", "Column must exist and not be null"),
    ("NET_SALES_EXISTS", "SCHEMA", "NET_SALES", "Column must exist"),
    ("MONTH_EXISTS", "SCHEMA", "MONTH", "Column must exist"),
    ("FY_EXISTS", "SCHEMA", "FY", "Column must exist"),
    ("MATERIAL_GROUP_NOT_NULL", "NULL_CHECK", "MATERIAL_GROUP", "MATERIAL_GROUP IS NOT NULL"),
    ("SOLD_STATE_NOT_NULL", "NULL_CHECK", "SOLD_STATE", "SOLD_STATE IS NOT NULL"),
    ("NET_SALES_NOT_NULL", "NULL_CHECK", "NET_SALES", "NET_SALES IS NOT NULL"),
    ("MONTH_NOT_NULL", "NULL_CHECK", "MONTH", "MONTH IS NOT NULL"),
    ("FY_NOT_NULL", "NULL_CHECK", "FY", "FY IS NOT NULL"),
    ("NET_SALES_NUMERIC", "FORMAT", "NET_SALES", "Must be convertible to number"),
    ("MONTH_FORMAT", "FORMAT", "MONTH", "Must match MMM-YY format"),
    ("FY_FORMAT", "FORMAT", "FY", "Must match YY-YY format"),
    ("NET_SALES_POSITIVE", "RANGE", "NET_SALES", "Net sales should be positive after conversion"),
]

# Training: fewest feature rows, and the train share as a fraction.
MIN_TRAINING_ROWS = 10
TRAIN_SHARE = (4, 5)

SHORT_SERIES_NOTE = "fewer rows than training needs"

# Model status values and comparison decisions.
CANDIDATE = "CANDIDATE"
PRODUCTION = "PRODUCTION"
ARCHIVED = "ARCHIVED"
PROMOTE = "PROMOTE"
KEEP_CURRENT = "KEEP_CURRENT"
MIN_IMPROVEMENT_PERCENT = 5.0

# Texts of registry notes and decision reasons.
NEW_MODEL_NOTE = "Newly trained model awaiting comparison"
FIRST_MODEL_NOTE = "First model - auto-promoted to PRODUCTION"
FIRST_MODEL_REASON = "First model - no production to compare"
IMPROVED_REASON = "MAE improved by {pct}%"
SMALL_GAIN_REASON = "Improvement only {pct}% (threshold: {limit}%)"
WORSE_REASON = "Candidate is worse by {pct}%"
NOT_COMPARABLE_REASON = "not comparable"
REPLACED_NOTE = "Replaced by "
PROMOTED_NOTE = "Promoted - "
NOT_PROMOTED_NOTE = "Not promoted - "

# Monitoring.
DRIFT_METRICS = ["Y_MEAN", "Y_STD", "Y_MIN", "Y_MAX", "RECORD_COUNT"]
DRIFT_LABELS = [(10.0, "NORMAL"), (25.0, "WARNING")]
DRIFT_WORST = "CRITICAL"
DRIFT_BASELINE = "BASELINE"
# Quantile sketches: their size, the error of a rank at that size (99 %), and the factor of the two-sample bound at 95 %.
SKETCH_SIZE = 200
SKETCH_RANK_ERROR = 0.0133
CHANCE_FACTOR = 1.358
AGING_DAYS = 30
STALE_DAYS = 90
SUMMARY_METRICS = [
    "PRODUCTION_MODEL",
    "PRODUCTION_MAE",
    "TOTAL_FEATURES",
    "RAW_RECORDS",
    "LATEST_DRIFT_STATUS",
    "MODELS_TRAINED",
]
HEALTH_PHASE = "HEALTH_CHECK"
FULL_RUN_PHASE = "FULL_PIPELINE"

# Definitions of format rules and the kind of check each one names.
FORMAT_DEFINITIONS = {
    "Must be convertible to number": "number",
    "Must match MMM-YY format": "month",
    "Must match YY-YY format": "fiscal_year",
}
