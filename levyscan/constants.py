"""Fixed values of the compliance domain.

Everything here is data that must hold exactly for results to be right: code lists,
patterns, thresholds, column orders and text formats.
"""

# --- fixed values: registration state codes ---------------------------------------
STATE_NAMES = {
    "01": "JAMMU AND KASHMIR",
    "02": "HIMACHAL PRADESH",
    "03": "PUNJAB",
    "04": "CHANDIGARH",
    "05": "UTTARAKHAND",
    "06": "HARYANA",
    "07": "DELHI",
    "08": "RAJASTHAN",
    "09": "UTTAR PRADESH",
    "10": "BIHAR",
    "11": "SIKKIM",
    "12": "ARUNACHAL PRADESH",
    "13": "NAGALAND",
    "14": "MANIPUR",
    "15": "MIZORAM",
    "16": "TRIPURA",
    "17": "MEGHALAYA",
    "18": "ASSAM",
    "19": "WEST BENGAL",
    "20": "JHARKHAND",
    "21": "ODISHA",
    "22": "CHHATTISGARH",
    "23": "MADHYA PRADESH",
    "24": "GUJARAT",
    "25": "DAMAN AND DIU",
    "26": "DADRA AND NAGAR HAVELI",
    "27": "MAHARASHTRA",
    "28": "ANDHRA PRADESH",
    "29": "KARNATAKA",
    "30": "GOA",
    "31": "LAKSHADWEEP ISLANDS",
    "32": "KERALA",
    "33": "TAMIL NADU",
    "34": "PONDICHERRY",
    "35": "ANDAMAN AND NICOBAR ISLANDS",
    "36": "TELANGANA",
    "37": "ANDHRA PRADESH (NEW)",
}

# --- fixed values: patterns and marks ---------------------------------------------
GSTIN_PATTERN = "^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][A-Z0-9]Z[A-Z0-9]$"
TRUE_MARKS = ["✓", "✔", "Y", "Yes", "TRUE", "true"]
FALSE_MARKS = ["✗", "✘", "N", "No", "FALSE", "false"]
DATE_FORMATS = ["dd/MM/yyyy", "yyyy-MM-dd"]
CODE_REMAP = {"FRD-006": "FRD-002"}

# --- fixed values: thresholds -----------------------------------------------------
NAME_MATCH_FLOOR = 0.85
SPIKE_LIMIT = 3
LATE_AFTER_DAYS = 30
FILINGS_REQUIRED = 4
EWB_REQUIRED_ABOVE = 50_000
HIGH_VALUE_ABOVE = 500_000
SUSPICIOUS_BELOW = 70
BOOSTED_THRESHOLD = 0.35

# --- fixed values: bands, highest first, (lower bound, label), then the fallback ---
SEVERITY_BANDS = [(6, "Critical"), (4, "High"), (2, "Medium")]
VENDOR_TIER_BANDS = [(0.20, "Critical"), (0.10, "High"), (0.05, "Medium")]
SCORE_TIER_BANDS = [(0.85, "Critical"), (0.70, "High"), (0.50, "Medium")]
LOWEST_BAND = "Low"

CLEAN_CODE = "CLEAN"

# --- fixed values: model names as the score tables carry them ---------------------
FOREST_NAME = "Random Forest"
BOOSTED_NAME = "XGBoost"

# --- fixed values: column lists ---------------------------------------------------
FILING_QUARTERS = [f"filing_history_q{q}" for q in range(1, 7)]

RULE_FLAGS = [
    "blacklisted",
    "rate_mismatch",
    "value_spike",
    "name_mismatch",
    "duplicate_invoice",
    "missing_ewb",
    "director_overlap_flag",
    "state_mismatch",
    "late_invoice",
    "vendor_non_filer",
]

FEATURES = [
    "name_sim_score",
    "spike_ratio",
    "vendor_age_days",
    "filing_compliance_rate",
    "is_march_invoice",
    "invoice_count_same_vendor_same_day",
    "hsn_rate_delta",
    "director_overlap_flag",
    "blacklisted",
    "rate_mismatch",
    "value_spike",
    "duplicate_invoice",
    "vendor_non_filer",
    "missing_ewb",
    "high_value_invoice_flag",
    "vendor_po_frequency",
    "invoice_to_avg_ratio",
    "rule_fail_count",
]

FLAG_TABLE_COLUMNS = [
    "po_id",
    "vendor_id",
    "po_date",
    "invoice_number",
    "invoice_date",
    "is_gstin_valid",
    "blacklisted",
    "rate_mismatch",
    "value_spike",
    "name_mismatch",
    "duplicate_invoice",
    "director_overlap_flag",
    "vendor_non_filer",
    "missing_ewb",
    "state_mismatch",
    "late_invoice",
    "billing_state",
    "rule_fail_count",
    "rule_score",
    "is_anomalous",
    "severity",
    "anomaly_code",
]

CASE_COLUMNS = [
    "po_id",
    "vendor_id",
    "rule_score",
    "severity",
    "risk_tier",
    "anomaly_rate",
    "blacklisted",
    "rate_mismatch",
    "value_spike",
    "name_mismatch",
    "duplicate_invoice",
    "vendor_non_filer",
    "missing_ewb",
    "state_mismatch",
    "director_overlap_flag",
    "is_anomalous",
]

# --- fixed values: analyst prompt formats, {column} marks a value ------------------
FLAG_PROMPT = """
You are a GST Fraud Detection Analyst.

Purchase Order Details:

PO ID: {po_id}
Vendor ID: {vendor_id}

Rule Score: {rule_score}
Severity: {severity}

Vendor Risk Tier: {risk_tier}
Vendor Anomaly Rate: {anomaly_rate}

Flags:

Blacklisted: {blacklisted}
Rate Mismatch: {rate_mismatch}
Value Spike: {value_spike}
Name Mismatch: {name_mismatch}
Duplicate Invoice: {duplicate_invoice}
Vendor Non Filer: {vendor_non_filer}
Missing EWB: {missing_ewb}
State Mismatch: {state_mismatch}
Director Overlap: {director_overlap_flag}

Return ONLY JSON:

{{
"risk_level":"",
"anomaly_types_detected":[],
"reasoning":"",
"recommended_action":"",
"confidence_score":0
}}
"""

METRIC_PROMPT = """
You are a GST Fraud Detection Expert.

Analyze this purchase order and determine fraud risk.

Purchase Order Data:

PO ID: {po_id}
Vendor ID: {vendor_id}
Rule Score: {rule_score}
Severity: {severity}
Risk Tier: {risk_tier}
Anomaly Rate: {anomaly_rate}
Filing Compliance Rate: {filing_compliance_rate}

Rules:

- Rule Score below 70 = suspicious
- Filing Compliance below 0.5 = risky
- Anomaly Rate above 0.5 = high risk
- Critical Risk Tier increases fraud probability

Return ONLY valid JSON.

Example:

{{
  "risk_level":"High",
  "anomaly_types_detected":["GST Risk"],
  "reasoning":"Low filing compliance and high anomaly rate detected.",
  "recommended_action":"Manual audit required.",
  "confidence_score":"0.91"
}}

Now analyze the record and return ONLY JSON.
"""
