"""Rule constants shared by the check operators.

Fixed values: these literals must equal the reference's rules exactly
(labels, thresholds, patterns). Thresholds are the defaults of the keyword
arguments of the operators; callers may override them.
"""

from __future__ import annotations

# --- Fixed values: issue labels emitted in the issue_type column -----------
COMPLETENESS_CHECK_NAME = "Patient Record Completeness"
ISSUE_INVALID_DOB = "Invalid DOB"
ISSUE_INVALID_PHONE = "Invalid Phone Format"
ISSUE_INVALID_EMAIL = "Invalid Email Format"
ISSUE_CLAIM_MISMATCH = "Claims Amount Mismatch"
ISSUE_PAYMENT_MISMATCH = "Payment Distribution Mismatch"
ISSUE_SUBMISSION_BEFORE_SERVICE = "Submission Before Service"
ISSUE_PROCESSING_BEFORE_SUBMISSION = "Processing Before Submission"
ISSUE_LONG_PENDING = "Long Pending Claim"
ISSUE_EXPIRED_LICENSE = "Expired License"
ISSUE_DUPLICATE_PATIENT = "Potential Duplicate Patient"
ISSUE_DUPLICATE_CLAIM = "Potential Duplicate Claim"
ISSUE_ORPHAN_PATIENT = "Orphaned Claim - Invalid Patient"
ISSUE_ORPHAN_PROVIDER = "Orphaned Claim - Invalid Provider"
ISSUE_HIGH_AMOUNT = "Unusually High Claim Amount"
ISSUE_HIGH_FREQUENCY = "High Claim Frequency"
ISSUE_STALE_PATIENT = "Stale Patient Record"
ISSUE_INCOMPLETE_DOCUMENTATION = "Incomplete Documentation"
ISSUE_DOCUMENTED_NOT_BILLED = "Documented But Not Billed"

# --- Fixed values: the checker's audit vocabulary ---------------------------
# check_name, check_type, table_name, issue_type per checker method.
CHECKER_PATIENT_COMPLETENESS = ("Patient Completeness", "completeness_check", "patient_records", "incomplete_record")
CHECKER_CLAIMS_DISCREPANCIES = ("Claims Discrepancies", "discrepancy_check", "claims", "amount_mismatch")
CHECKER_TEMPORAL_ANOMALIES = ("Temporal Anomalies", "temporal_check", "claims", "temporal_anomaly")
CHECKER_DUPLICATE_RECORDS = ("Duplicate Records", "duplicate_check", "patient_records", "potential_duplicate")
CHECKER_PROVIDER_CREDENTIALS = ("Provider Credentials", "credential_check", "providers", "expired_license")
ANOMALY_SUBMISSION_BEFORE_SERVICE = "Submission before service"
ANOMALY_PROCESSING_BEFORE_SUBMISSION = "Processing before submission"
MISSING_FIELDS_PREFIX = "Missing fields: "
DISCREPANCY_TOTAL_PREFIX = "Claim total: $"
DISCREPANCY_LINES_PREFIX = ", Line items sum: $"
DISCREPANCY_AMOUNT_PREFIX = ", Discrepancy: $"
DUPLICATES_PREFIX = "Duplicate patients found: "
DUPLICATES_MORE = ", more: "
EXPIRED_PREFIX = "License expired "
EXPIRED_SUFFIX = " days ago"
SEVERITY_MEDIUM = "MEDIUM"
SEVERITY_HIGH = "HIGH"
SEVERITY_CRITICAL = "CRITICAL"
AUDIT_OPEN = "OPEN"
RUN_STATUS_FAIL = "FAIL"
RUN_STATUS_PASS = "PASS"

# --- Fixed values: headings of the report page -------------------------------
REPORT_TITLE = "Healthcare Data Quality Report"
REPORT_GENERATED = "Report Generated:"
REPORT_CHECKS = "Total Checks Performed:"
REPORT_ISSUES = "Total Issues Found:"
REPORT_STATUS = "Overall Status:"
REPORT_CHECK_ISSUES = "Issues Found:"

# --- Fixed values: validation patterns and thresholds -----------------------
# Email pattern of the reference; ``\z`` (end of input) replaces ``$`` because
# Java's ``$`` would also accept a trailing newline.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
NON_DIGIT_PATTERN = r"[^0-9]"
PHONE_DIGITS = 10
MIN_BIRTH_DATE = "1900-01-01"
MAX_AGE_YEARS = 120
AMOUNT_TOLERANCE = "0.01"
PAID_STATUSES = ("PROCESSED", "PAID")
OPEN_STATUSES = ("SUBMITTED", "PENDING")
PENDING_DAYS = 30
HIGH_AMOUNT_THRESHOLD = 50000
FREQUENCY_WINDOW_MONTHS = 12
FREQUENCY_MIN_COUNT = 50
STALE_YEARS = 2
UNDOCUMENTED_DAYS = 7
UNBILLED_DAYS = 14
CRITICAL_DISCREPANCY = 1000
HIGH_MISSING_FIELDS = 2
RECENT_DAYS = 30
REPORT_PREVIEW_ROWS = 10

# --- Fixed values: field lists of the completeness checks, in the reference's order
PATIENT_REQUIRED_FIELDS = ("name", "date_of_birth", "insurance_id", "primary_provider")
PROVIDER_REQUIRED_FIELDS = ("npi_number", "license_number", "specialty", "contact_email")
CONTACT_INFO_FIELD = "contact_info"
