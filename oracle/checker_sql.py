"""DuckDB oracle SQL for the checker's five checks (P01–P05), the audit rows
(W1) and the run counts and summary (P06)."""

from __future__ import annotations

from .checks_sql import AS_OF, D, M, _C06_TOTALS, _PATIENT_INCOMPLETE_WHERE, _PATIENT_MISSING_5, _SAME_PATIENTS

P01 = f"""
SELECT patient_id, name, {D('date_of_birth')} AS date_of_birth, insurance_id, primary_provider,
  contact_phone, contact_email, {_PATIENT_MISSING_5} AS missing_fields
FROM patient_records WHERE {_PATIENT_INCOMPLETE_WHERE}
"""

P02 = f"""
SELECT claim_id, patient_id, provider_id, {M('claim_total_amount')} AS claim_total_amount,
  {M('calculated_total')} AS calculated_total, line_item_count, {M('gap')} AS discrepancy_amount,
  CASE WHEN claim_total_amount <> 0 THEN round(gap / claim_total_amount * 100, 2) END AS discrepancy_percentage
FROM ({_C06_TOTALS}) t WHERE gap >= 0.02
"""

# The labels of a claim's date faults, the first one first; an empty list has none.
_P03_FAULTS = """list_filter([IF(service_date > submission_date, 'Submission before service', NULL),
    IF(submission_date > processing_date, 'Processing before submission', NULL)], lambda f: f IS NOT NULL)"""
_P03_ROWS = f"SELECT * FROM (SELECT *, {_P03_FAULTS} AS faults FROM claims) f WHERE len(faults) > 0"

P03 = f"""
SELECT claim_id, patient_id, {D('service_date')} AS service_date, {D('submission_date')} AS submission_date,
  {D('processing_date')} AS processing_date, faults[1] AS anomaly_type
FROM ({_P03_ROWS}) r
"""

_P04_GROUPS = f"SELECT * FROM ({_SAME_PATIENTS}) m WHERE duplicate_count >= 2 AND member_no = 1"

P04 = f"""
SELECT name, {D('date_of_birth')} AS date_of_birth, duplicate_count, first_id,
  coalesce(array_to_string(ids, ','), '') AS patient_ids
FROM (SELECT name, date_of_birth, duplicate_count, first_id, list_sort(list(patient_id)) AS ids
      FROM ({_SAME_PATIENTS}) m WHERE duplicate_count >= 2 GROUP BY ALL) g
"""

_P05_ROWS = f"""
SELECT provider_id, provider_name, license_number, license_state, license_expiry_date,
  {AS_OF} - license_expiry_date AS days_expired
FROM providers WHERE license_expiry_date < {AS_OF} AND is_active = TRUE
"""

P05 = f"""
SELECT provider_id, provider_name, license_number, license_state, {D('license_expiry_date')} AS license_expiry_date,
  CAST(days_expired AS BIGINT) AS days_expired
FROM ({_P05_ROWS}) p
"""


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(20,2)) AS VARCHAR)"


_ISSUES = f"""
issues AS (
  SELECT 'patient_completeness' AS check_key, 'completeness_check' AS check_type, 'patient_records' AS table_name,
    patient_id AS record_id, 'incomplete_record' AS issue_type,
    'Missing fields: ' || {_PATIENT_MISSING_5.replace("concat_ws(','", "concat_ws(', '")} AS issue_description,
    CASE WHEN (CASE WHEN name IS NULL THEN 1 ELSE 0 END + CASE WHEN date_of_birth IS NULL THEN 1 ELSE 0 END
             + CASE WHEN insurance_id IS NULL THEN 1 ELSE 0 END + CASE WHEN primary_provider IS NULL THEN 1 ELSE 0 END
             + CASE WHEN contact_phone IS NULL AND contact_email IS NULL THEN 1 ELSE 0 END) > 2
         THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    CAST(NULL AS DECIMAL(38,2)) AS amount
  FROM patient_records WHERE {_PATIENT_INCOMPLETE_WHERE}
  UNION ALL
  SELECT 'claims_discrepancies', 'discrepancy_check', 'claims', claim_id, 'amount_mismatch',
    'Claim total: $' || {_money('claim_total_amount')} || ', Line items sum: $' || {_money('calculated_total')}
      || ', Discrepancy: $' || {_money('gap')},
    IF(gap > 1000, 'CRITICAL', 'HIGH'), CAST(gap AS DECIMAL(38,2))
  FROM ({_C06_TOTALS}) t WHERE gap >= 0.02
  UNION ALL
  SELECT 'temporal_anomalies', 'temporal_check', 'claims', claim_id, 'temporal_anomaly', faults[1], 'HIGH', NULL
  FROM ({_P03_ROWS}) r
  UNION ALL
  SELECT 'duplicate_records', 'duplicate_check', 'patient_records', first_id, 'potential_duplicate',
    'Duplicate patients found: ' || first_id || ', more: ' || (duplicate_count - 1), 'MEDIUM',
    CAST(duplicate_count AS DECIMAL(38,2))
  FROM ({_P04_GROUPS}) g
  UNION ALL
  SELECT 'provider_credentials', 'credential_check', 'providers', provider_id, 'expired_license',
    'License expired ' || CAST(days_expired AS VARCHAR) || ' days ago', 'CRITICAL', NULL
  FROM ({_P05_ROWS}) p
)
"""

AUDIT_ISSUES = f"""
WITH {_ISSUES.strip()}
SELECT row_number() OVER (ORDER BY check_type, record_id, issue_type, issue_description, severity, table_name) AS audit_id,
  '2024-02-01 00:00:00' AS check_timestamp, check_type, table_name, record_id, issue_type,
  issue_description, severity, 'OPEN' AS status, CAST(NULL AS VARCHAR) AS assigned_to,
  CAST(NULL AS VARCHAR) AS resolution_notes, CAST(NULL AS VARCHAR) AS resolved_at
FROM issues
"""

RUN_CHECK_COUNTS = f"""
WITH {_ISSUES.strip()},
names AS (
  SELECT * FROM (VALUES ('patient_completeness', 'Patient Completeness'), ('claims_discrepancies', 'Claims Discrepancies'),
    ('temporal_anomalies', 'Temporal Anomalies'), ('duplicate_records', 'Duplicate Records'),
    ('provider_credentials', 'Provider Credentials')) v(check_key, check_name))
SELECT n.check_key, n.check_name, COUNT(i.check_key) AS issues_found
FROM names n LEFT JOIN issues i ON i.check_key = n.check_key
GROUP BY n.check_key, n.check_name
"""

RUN_SUMMARY = f"""
WITH {_ISSUES.strip()}
SELECT '2024-02-01 00:00:00' AS run_timestamp, COUNT(*) AS total_issues_found, CAST(5 AS BIGINT) AS checks_performed,
  CASE WHEN COUNT(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  CAST(COALESCE(SUM(CASE WHEN check_key = 'claims_discrepancies' THEN amount END), 0) AS DOUBLE) AS total_discrepancy,
  CAST(COALESCE(SUM(CASE WHEN check_key = 'duplicate_records' THEN amount END), 0) AS BIGINT) AS total_duplicates
FROM issues
"""

_CLAIM_TABLES = ["patient_records", "providers", "claims", "claims_line_items"]

CHECKER = {
    "checker_patient_completeness": (["patient_records"], P01),
    "checker_claims_discrepancies": (["claims", "claims_line_items"], P02),
    "checker_temporal_anomalies": (["claims"], P03),
    "checker_duplicate_records": (["patient_records"], P04),
    "checker_provider_credentials": (["providers"], P05),
    "audit_issues": (_CLAIM_TABLES, AUDIT_ISSUES),
    "run_check_counts": (_CLAIM_TABLES, RUN_CHECK_COUNTS),
    "run_summary": (_CLAIM_TABLES, RUN_SUMMARY),
}
