"""DuckDB oracle SQL for the metrics."""

from __future__ import annotations

from .checker_sql import _ISSUES
from .checks_sql import (
    AS_OF,
    CLAIM_LINE_MISMATCH,
    INVALID_DOB,
    INVALID_EMAIL,
    INVALID_PHONE,
    PAYMENT_MISMATCH,
    PROCESSED_BEFORE_SUBMISSION,
    SUBMITTED_BEFORE_SERVICE,
)

_P_COMPLETE = ("name IS NOT NULL AND date_of_birth IS NOT NULL AND insurance_id IS NOT NULL "
               "AND primary_provider IS NOT NULL")
_V_COMPLETE = ("npi_number IS NOT NULL AND license_number IS NOT NULL AND specialty IS NOT NULL "
               "AND contact_email IS NOT NULL")


def _pct(part: str, whole: str) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) / {whole} * 100, 2)"


QUALITY_METRICS = f"""
WITH flags AS (
  SELECT 'Patient Records' AS data_type, {_P_COMPLETE} AS complete,
    date_diff('day', created_at::DATE, {AS_OF}) <= 30 AS recent FROM patient_records
  UNION ALL
  SELECT 'Claims', coalesce(status = 'PROCESSED', false), date_diff('day', submission_date, {AS_OF}) <= 30 FROM claims)
SELECT data_type, count(*) AS total_records, count(*) FILTER (complete) AS complete_records,
  {_pct('count(*) FILTER (complete)', 'count(*)')} AS completeness_pct, count(*) FILTER (recent) AS recent_records,
  {_pct('count(*) FILTER (recent)', 'count(*)')} AS recency_pct
FROM flags GROUP BY data_type
"""

_COMPLETENESS_ROWS = f"""
  SELECT 'patient_records' AS table_name, COUNT(*) AS total_records,
    COUNT(CASE WHEN {_P_COMPLETE} THEN 1 END) AS complete_records FROM patient_records
  UNION ALL
  SELECT 'claims', COUNT(*), COUNT(CASE WHEN status = 'PROCESSED' THEN 1 END) FROM claims
  UNION ALL
  SELECT 'providers', COUNT(*), COUNT(CASE WHEN {_V_COMPLETE} THEN 1 END) FROM providers
"""

COMPLETENESS_RATES = f"""
SELECT table_name, total_records, complete_records, {_pct('complete_records', 'total_records')} AS completeness_rate
FROM ({_COMPLETENESS_ROWS}) t
"""

_ACCURACY_ROWS = f"""
  SELECT 'patient_records' AS table_name, (SELECT COUNT(*) FROM patient_records) AS total_records,
    (SELECT COUNT(*) FROM (SELECT patient_id FROM ({INVALID_DOB}) a UNION SELECT patient_id FROM ({INVALID_PHONE}) b
                           UNION SELECT patient_id FROM ({INVALID_EMAIL}) c) u) AS failing_records
  UNION ALL
  SELECT 'claims', (SELECT COUNT(*) FROM claims),
    (SELECT COUNT(*) FROM (SELECT claim_id FROM ({CLAIM_LINE_MISMATCH}) a UNION SELECT claim_id FROM ({PAYMENT_MISMATCH}) b
                           UNION SELECT claim_id FROM ({SUBMITTED_BEFORE_SERVICE}) c
                           UNION SELECT claim_id FROM ({PROCESSED_BEFORE_SUBMISSION}) d) u)
"""

ACCURACY_RATES = f"""
SELECT table_name, total_records, failing_records,
  {_pct('total_records - failing_records', 'total_records')} AS accuracy_rate
FROM ({_ACCURACY_ROWS}) t
"""

_ERROR_ROWS = f"""
  SELECT t.table_name, COUNT(i.table_name) AS findings, t.total_records
  FROM (SELECT 'patient_records' AS table_name, COUNT(*) AS total_records FROM patient_records
        UNION ALL SELECT 'claims', COUNT(*) FROM claims
        UNION ALL SELECT 'providers', COUNT(*) FROM providers) t
  LEFT JOIN issues i ON i.table_name = t.table_name
  GROUP BY t.table_name, t.total_records
"""

ERROR_RATES = f"""
WITH {_ISSUES.strip()}
SELECT table_name, findings, total_records, ROUND(CAST(findings AS DOUBLE) * 1000 / total_records, 2) AS error_rate
FROM ({_ERROR_ROWS}) e
"""

_RESOLUTION_ROWS = """
  SELECT check_type, COUNT(*) AS resolved_count,
    ROUND(AVG(CAST(date_diff('second', check_timestamp, resolved_at) AS DOUBLE) / 3600), 2) AS avg_resolution_hours
  FROM quality_audit_log WHERE status = 'RESOLVED' AND resolved_at IS NOT NULL
  GROUP BY check_type
"""

RESOLUTION_TIMES = _RESOLUTION_ROWS

_TREND_ROWS = """
  SELECT CAST(date_trunc('week', check_timestamp) AS DATE) AS week_start, issue_type, COUNT(*) AS findings
  FROM quality_audit_log GROUP BY 1, 2
"""

WEEKLY_ERROR_TREND = f"""
SELECT CAST(week_start AS VARCHAR) AS week_start, issue_type, findings FROM ({_TREND_ROWS}) w
"""

QUALITY_METRIC_ROWS = f"""
WITH {_ISSUES.strip()},
m AS (
  SELECT 'completeness_rate' AS metric_name, {_pct('complete_records', 'total_records')} AS value,
    'completeness' AS category, table_name AS notes FROM ({_COMPLETENESS_ROWS}) a
  UNION ALL
  SELECT 'accuracy_rate', {_pct('total_records - failing_records', 'total_records')}, 'accuracy', table_name
  FROM ({_ACCURACY_ROWS}) b
  UNION ALL
  SELECT 'error_rate_per_1000', ROUND(CAST(findings AS DOUBLE) * 1000 / total_records, 2), 'error_rate', table_name
  FROM ({_ERROR_ROWS}) c
  UNION ALL
  SELECT 'avg_resolution_hours', avg_resolution_hours, 'resolution_time', check_type FROM ({_RESOLUTION_ROWS}) d
  UNION ALL
  SELECT 'weekly_findings', CAST(findings AS DOUBLE), 'trend', CAST(week_start AS VARCHAR) || ' ' || issue_type
  FROM ({_TREND_ROWS}) e)
SELECT row_number() OVER (ORDER BY metric_name, notes, category) AS metric_id,
  '2024-02-01' AS metric_date, metric_name, CAST(CAST(value AS DECIMAL(20,2)) AS DOUBLE) AS metric_value,
  CAST(NULL AS DOUBLE) AS target_value, category, notes, '2024-02-01 00:00:00' AS created_at
FROM m
"""

_ALL = ["patient_records", "providers", "claims", "claims_line_items", "quality_audit_log"]

METRICS = {
    "weekly_trend_from_partials": (["quality_audit_log"], WEEKLY_ERROR_TREND),
    "resolution_times_from_partials": (["quality_audit_log"], RESOLUTION_TIMES),
    "completeness_from_partials": (["patient_records", "claims", "providers"], COMPLETENESS_RATES),
    "quality_metrics": (["patient_records", "claims"], QUALITY_METRICS),
    "completeness_rates": (["patient_records", "claims", "providers"], COMPLETENESS_RATES),
    "accuracy_rates": (["patient_records", "claims", "claims_line_items"], ACCURACY_RATES),
    "error_rates": (["patient_records", "claims", "providers", "claims_line_items"], ERROR_RATES),
    "resolution_times": (["quality_audit_log"], RESOLUTION_TIMES),
    "weekly_error_trend": (["quality_audit_log"], WEEKLY_ERROR_TREND),
    "quality_metric_rows": (_ALL, QUALITY_METRIC_ROWS),
}
