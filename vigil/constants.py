"""Fixed values.

Everything in this module must equal the behaviour being reproduced for
results to match (weights, thresholds, lookup sets, defaults).  They are
listed plainly, in their natural order, in one place.
"""

# --- fixed values: source trust -------------------------------------------
SOURCE_RELIABILITY = {
    "nvd": 0.9,
    "abuseipdb": 0.6,
}
DEFAULT_RELIABILITY = 0.5          # fill value for a missing reliability

# --- fixed values: label set, ordinal order Low < Medium < High < Critical --
PRIORITY_LABELS = ["Low", "Medium", "High", "Critical"]
SEVERITY_RANK = {"Low": 0, "Medium": 1, "High": 2, "Critical": 3}
DISPLAY_PRIORITY_ORDER = ["Critical", "High", "Medium", "Low"]

# --- fixed values: countries over-represented in abuse reports ------------
HIGH_RISK_COUNTRIES = [
    "CN", "RU", "BR", "IN", "VN", "KR", "UA", "TR", "IR", "PK",
    "ID", "TH", "NG", "BD", "PH",
]

# --- fixed values: CWE risk tiers ----------------------------------------
CWE_HIGH_RISK = [
    "CWE-78", "CWE-89", "CWE-94", "CWE-77", "CWE-502", "CWE-434", "CWE-611", "CWE-918",
]
CWE_MEDIUM_RISK = [
    "CWE-79", "CWE-352", "CWE-287", "CWE-200", "CWE-22", "CWE-416", "CWE-787",
    "CWE-120", "CWE-125",
]
CWE_GENERIC = ["unknown", "NVD-CWE-Other", "NVD-CWE-noinfo"]
CWE_TIER_SCORE = {"high": 1.0, "medium": 0.6, "named": 0.4, "generic": 0.2}

# --- fixed values: heuristic score weights (sum to 1.00), in summation order
WEIGHTS = [
    ("severity", 0.35),
    ("exploited_flag", 0.18),
    ("report_count_norm", 0.10),
    ("recency_score", 0.08),
    ("source_reliability", 0.07),
    ("cwe_risk", 0.12),
    ("reference_bonus", 0.10),
]
GEO_BOOST = 0.05
GEO_BOOST_MIN_SEVERITY = 4.0

# --- fixed values: label thresholds (score >= threshold) -------------------
THRESHOLDS = [
    ("Critical", 0.72),
    ("High", 0.52),
    ("Medium", 0.38),
]
FALLBACK_LABEL = "Low"

# --- fixed values: feature constants --------------------------------------
RECENCY_E_FOLD_DAYS = 30.0         # exp(-age/30); named "half-life" upstream
UNKNOWN_RECENCY = 0.3              # recency of an unparsable / missing date
REFERENCE_BONUS_FULL_AT = 20       # log1p(n)/log1p(20), capped at 1.0
DESCRIPTION_MAX_CHARS = 500

# --- fixed values: feature vector, in model order ---------------------------
FEATURE_COLS = [
    "severity_raw",
    "report_count_norm",
    "recency_score",
    "source_reliability",
    "exploited_flag",
    "reference_count_norm",
    "high_risk_country",
    "is_cve",
    "is_malicious_ip",
]

# --- fixed values: collection defaults ---------------------------------------
CVE_PAGES_TO_FETCH = 2
CVE_RESULTS_PER_PAGE = 200
IP_CONFIDENCE_MINIMUM = 50
IP_LIMIT = 500

# --- fixed values: training -------------------------------------------------
RANDOM_SEED = 42
TEST_SIZE = 0.25
LOGREG_MAX_ITER = 1000
DTREE_MAX_DEPTH = 6
RF_NUM_TREES = 200
RF_MAX_DEPTH = 10

# --- fixed values: serving -----------------------------------------------------
DEFAULT_PAGE_SIZE = 25
DISPLAY_COLUMNS = [
    ("id", "ID"),
    ("threat_type", "Type"),
    ("title", "Title"),
    ("severity_raw", "Severity"),
    ("predicted_priority", "ML Priority"),
    ("predicted_priority_score", "ML Rank Score"),
    ("heuristic_label", "Heuristic Label"),
    ("source", "Source"),
    ("last_seen", "Last Seen"),
]

# --- fixed values: threat types and sources ----------------------------------
TYPE_CVE = "cve"
TYPE_IP = "malicious_ip"
SOURCE_CVE = "nvd"
SOURCE_IP = "abuseipdb"
