"""Schema metadata, column groups and thresholds of the listing feeds.

Everything here is driver-side metadata: a few short lists of column names.
No operator ever moves data through these structures.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. They must equal the reference's for results to match.
# ---------------------------------------------------------------------------

# The 28 columns every feed is expected to carry, in file order.
EXPECTED_COLUMNS: tuple[str, ...] = (
    "property_id", "source_agency", "feed_date", "sold_let_date",
    "transaction_type", "listing_status", "address", "area",
    "borough", "postcode", "property_type", "tenure",
    "bedrooms", "bathrooms", "sqft", "price", "price_per_sqft",
    "condition", "epc_rating", "heating_type", "garden",
    "parking", "floor_level", "days_on_market", "agent_id",
    "is_chain_free", "longitude", "latitude",
)

# Columns profiled as numbers (negatives, zeros, min / max / avg).
NUMERIC_COLUMNS: tuple[str, ...] = (
    "bedrooms", "bathrooms", "sqft", "price",
    "price_per_sqft", "days_on_market", "longitude", "latitude",
)

# Columns profiled for their date format.
DATE_COLUMNS: tuple[str, ...] = ("feed_date", "sold_let_date")

# Columns profiled for their distinct values.
CATEGORICAL_COLUMNS: tuple[str, ...] = (
    "transaction_type", "listing_status", "property_type",
    "tenure", "condition", "epc_rating", "heating_type",
    "garden", "parking", "is_chain_free",
)

# Columns capitalised word by word during enrichment.
INITCAP_COLUMNS: tuple[str, ...] = (
    "property_type", "condition", "transaction_type", "listing_status",
)

# Leftover crawler columns: dropped by enrichment, ignored by the profiler.
LEFTOVER_COLUMNS: tuple[str, ...] = ("partition_0", "partition_1")

# sqft at or above this value is a placeholder for "unknown".
SQFT_PLACEHOLDER_THRESHOLD = 99998

# The ten agency feeds and their directory slugs.
DEFAULT_SOURCES: tuple[str, ...] = (
    "cbre-living", "cushman-wakefield", "foxtons", "hamptons",
    "jll-residential", "knight-frank", "purple-bricks", "right-move",
    "savills", "strutt-parker",
)

# Quality score: start value and deductions per kind of issue.
SCORE_START = 100
DEDUCT_NULL_IDS = 30
DEDUCT_DUPLICATE_IDS = 20
DEDUCT_MISSING_COLUMNS = 20
DEDUCT_NEGATIVE = 5          # once each for negative price and negative sqft

# Grade thresholds (score >= value), best first; below the last is POOR.
GRADES: tuple[tuple[int, str], ...] = ((90, "EXCELLENT"), (75, "GOOD"), (60, "FAIR"))
GRADE_POOR = "POOR"
GRADE_ERROR = "ERROR"

# Grade icons and null-profile flags.
ICON_OK = "✓"        # check mark: EXCELLENT, GOOD
ICON_WARN = "⚠"      # warning sign: FAIR, and null share above 10 %
ICON_BAD = "✗"       # ballot x: POOR, ERROR
ICON_INFO = "ℹ"      # information sign: null share of 10 % or less
NULL_PCT_WARN_ABOVE = 10

# Go / no-go advice on the average score.
ADVICE_SAFE_AT = 75
ADVICE_REVIEW_AT = 60
ADVICE_SAFE = "SAFE_TO_RUN_ETL"
ADVICE_REVIEW = "REVIEW_BEFORE_ETL"
ADVICE_STOP = "DO_NOT_RUN_ETL"

# Date format labels of the profiler, in the order they are tried.
LABEL_ISO = "YYYY-MM-DD"
LABEL_DMY_SLASH = "DD/MM/YYYY"
LABEL_YMD_SLASH = "YYYY/MM/DD"
LABEL_DMON = "DD Mon YYYY"
LABEL_DMY_DASH = "DD-MM-YYYY"      # only with extended=True
LABEL_EMPTY = "empty"
LABEL_UNKNOWN = "UNKNOWN"

# English month abbreviations, January first.
MONTH_ABBREVIATIONS: tuple[str, ...] = (
    "jan", "feb", "mar", "apr", "may", "jun",
    "jul", "aug", "sep", "oct", "nov", "dec",
)

# Validation messages.
MSG_NO_RECORDS = "VALIDATION FAILED [{source}]: No records found!"
MSG_NULL_IDS = "VALIDATION FAILED [{source}]: {n} null property IDs!"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED_PREFIX = "FAILED: "
STATUS_PROFILED = "PROFILED"

# ---------------------------------------------------------------------------
# Names used by this library.
# ---------------------------------------------------------------------------

SOURCE_COL = "source_name"
KEY_COL = "property_id"
INGESTION_COL = "ingestion_timestamp"
