"""Accepted lists, thresholds, texts and formats the results must carry exactly."""

# --- fixed values: accepted lists -------------------------------------------
TAXPAYER_TYPES = ["Individual", "Corporate", "Partnership", "NGO"]
RISK_CATEGORIES = ["Low", "Medium", "High", "Critical"]
RETURN_STATUSES = ["Filed", "Pending", "Overdue", "Amended"]
ASSESSMENT_STATUSES = ["Filed", "Pending", "Overdue", "Under Review", "Amended"]
PAYMENT_STATUSES = ["Completed", "Pending", "Failed", "Reversed"]
PAYMENT_CHANNELS = ["Bank Transfer", "Mobile Money", "Cash", "Cheque", "POS", "Online"]
TAX_TYPES = ["PAYE", "VAT", "Corporate Tax", "Withholding Tax", "Capital Gains", "Property Tax"]

# --- fixed values: text columns coerced to dates when a CSV file is read ------
DATE_COLUMNS = [
    "registration_date", "filing_date", "due_date", "payment_date", "incorporation_date",
    "last_filing_date", "purchase_date", "acquisition_date", "alert_date", "created_at", "updated_at",
]

# --- fixed values: filing ------------------------------------------------------
NOT_FILED, LATE, ON_TIME = "Not Filed", "Late", "On Time"
CHRONIC_LATE_DAYS = 30
LOW_FILING_SHARE = 0.5
SCORE_FLOOR, SCORE_CEILING = 0.1, 0.95

# --- fixed values: revenue -----------------------------------------------------
TARGET_GROWTH = 1.15

# --- fixed values: profile scores ----------------------------------------------
CRITICAL_FRAUD_SCORE = 0.7
SIZE_LIMITS = [(1_000_000, "Small"), (10_000_000, "Medium"), (100_000_000, "Large")]
SIZE_TOP = "Very Large"
EMAIL_POINTS, REGULAR_PAYER_POINTS, MONTH_POINTS, FILING_WEIGHT = 0.2, 0.3, 0.025, 0.5
REGULAR_PAYER_MONTHS = 12

# --- fixed values: alert texts ----------------------------------------------------
VAT_DROP_TYPE = "Sudden VAT Declaration Drop"
VAT_DROP_ACTION = "Review recent VAT returns and request supporting documentation"
PAYE_MISMATCH_TYPE = "PAYE vs Revenue Inconsistency"
PAYE_MISMATCH_ACTION = "Audit PAYE returns against actual employee records"
PAYMENT_TYPE = "Suspicious Payment Patterns"
PAYMENT_ACTION = "Investigate payment methods and transaction patterns"
PEER_TYPE = "Below Peer Tax Contribution"
PEER_ACTION = "Benchmark against similar businesses and conduct detailed audit"
NONCOMPLIANCE_TYPE = "Chronic Non-Compliance"
NONCOMPLIANCE_ACTION = "Escalate to enforcement team for immediate action"
REVENUE_DROP_TYPE = "Sudden Revenue Drop"
CHANNEL_ANOMALY_TYPE = "Payment Channel Anomaly"
BELOW_INDUSTRY_TYPE = "Below Industry Average"
ML_ALERT_TYPE = "ML-Detected High Fraud Risk"
PRIORITY_LIMITS = [(0.8, "Critical"), (0.6, "High"), (0.4, "Medium")]
PRIORITY_BOTTOM = "Low"
MIN_ALERT_SCORE = 0.4

# --- fixed values: transaction checks ----------------------------------------------
VALID, DUPLICATE_WARNING, HIGH_AMOUNT_WARNING = "Valid", "Duplicate Warning", "High Amount Warning"
HIGH_AMOUNT_QUANTILE = 0.95
REASON_HIGH_AMOUNT = "Unusually high amount"
REASON_HOURS = "Transaction outside business hours"
REASON_WEEKEND = "Weekend transaction"
REASON_FLAGGED = "Pre-flagged as risky"
REASON_FALLBACK = "Complex pattern detected"
REASON_AMOUNT_LIMIT = 1_000_000

# --- fixed values: model scores -----------------------------------------------------
FRAUD_BANDS = [(0.3, "Low"), (0.6, "Medium"), (0.8, "High"), (1.0, "Critical")]
COMPLIANCE_BANDS = [(0.3, "0-30%"), (0.5, "30-50%"), (0.7, "50-70%"), (0.9, "70-90%")]
COMPLIANCE_BAND_TOP = "90-100%"
