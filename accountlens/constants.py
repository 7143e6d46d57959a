"""Fixed values the results depend on.

Everything in this module is a business constant that must keep these exact
values for results to match the documented behaviour (segment table, value
sets, weights, thresholds). They are plain data; no logic lives here.
"""

from __future__ import annotations

# --- fixed values: segment definitions, in rank order (0 = best) ------------
# (segment_id, name, color_hex, priority, recommended action)
SEGMENTS = [
    (0, "Champions", "#22c55e", 1,
     "Behoud — proactief contact, exclusieve diensten"),
    (1, "Potentials", "#3b82f6", 2,
     "Ontwikkelen — upsell kansen identificeren"),
    (2, "At Risk", "#f59e0b", 3,
     "Reactiveren — persoonlijk hercontact initiëren"),
    (3, "Lost", "#ef4444", 4,
     "Evalueren — win-back campagne of afschrijven"),
]
MAX_SEGMENTS = len(SEGMENTS)

# --- fixed values: allowed value sets of the table contracts ---------------
VALID_SECTORS = ["tech", "healthcare", "manufacturing", "retail", "finance",
                 "construction", "logistics"]
VALID_SIZES = ["micro", "small", "medium", "large"]
VALID_STATUSES = ["Active", "Inactive", "Prospect"]
VALID_INTERACTION_TYPES = ["call", "email", "meeting", "event", "linkedin"]
VALID_OUTCOMES = ["positive", "neutral", "negative", "no_response"]

# --- fixed values: columns treated as personal data ------------------------
EMPLOYER_PII_COLUMNS = ["company_name", "vat_number", "contact_email", "contact_name"]
INTERACTION_PII_COLUMNS = ["contact_email", "contact_name", "phone_number"]
PSEUDONYM_PREFIX = "anon_"
PSEUDONYM_HEX_CHARS = 16

# --- fixed values: revenue-potential model (size base x sector multiplier) --
SIZE_BASE_REVENUE = {"micro": 5000.0, "small": 20000.0, "medium": 75000.0, "large": 200000.0}
DEFAULT_BASE_REVENUE = 20000.0
SECTOR_MULTIPLIER = {"tech": 1.4, "healthcare": 1.2, "retail": 0.9, "manufacturing": 1.1}
DEFAULT_SECTOR_MULTIPLIER = 1.0

# --- fixed values: RFM weights and priority-score weights ------------------
RFM_WEIGHTS = {"r": 0.30, "f": 0.40, "m": 0.30}
RFM_DIGITS = 4
PRIORITY_WEIGHTS = {"rfm": 0.5, "recency": 0.3, "frequency": 0.2}
PRIORITY_RECENCY_DAYS = 365
PRIORITY_DIGITS = 1

# --- fixed values: K-Means defaults ----------------------------------------
KMEANS_N_SEGMENTS = 4
KMEANS_SEED = 42
KMEANS_N_INIT = 20
KMEANS_MAX_ITER = 500

# --- fixed values: data-quality thresholds ---------------------------------
FRESHNESS_MAX_AGE_DAYS = 730
EMPLOYERS_MIN_ROWS = 10
FREQUENCY_WINDOW_DAYS = 365
MISSING_RATE_ALERT = 0.05

# --- fixed values: KPI measure thresholds ----------------------------------
CHURN_RECENCY_DAYS = 365
CHURN_FREQUENCY_CAP = 24
CHURN_WEIGHTS = {"recency": 0.6, "frequency": 0.4}
CHURN_WINDOW_MONTHS = 12
HIGH_CHURN_THRESHOLD = 70
# (churn score upper bound, revenue floor or None, label) - first match wins
PRIORITY_LABELS = [
    (20, 50000.0, "🟢 Champion"),
    (40, None, "🔵 Potential"),
    (70, None, "🟡 At Risk"),
    (None, None, "🔴 Lost"),
]
ROLLING_WINDOW_MONTHS = 3

# --- fixed values: retention periods (months) ------------------------------
EMPLOYER_RETENTION_MONTHS = 24
INTERACTION_RETENTION_MONTHS = 36

# --- fixed values: CSV cell texts read as null (the pandas default list) ----
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
