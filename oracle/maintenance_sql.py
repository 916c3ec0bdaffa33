"""DuckDB oracle SQL for conform (W2), updates (W3), the report preview
(P07) and the investigate look-up (R4)."""

from __future__ import annotations

from .checker_sql import _P03_ROWS, _P04_GROUPS, _P05_ROWS
from .checks_sql import (
    CLAIM_LINE_MISMATCH,
    DOCUMENTED_NOT_BILLED,
    INCOMPLETE_PATIENTS,
    INCOMPLETE_PROVIDERS,
    D,
    M,
    _C06_TOTALS,
    _PATIENT_INCOMPLETE_WHERE,
    _PATIENT_MISSING_5,
)

_NOW = "'2024-02-01 00:00:00'"
_LATER = "'2024-02-01 12:00:00'"


def _claims_select(status: str, processing_date: str, updated_at: str, src: str = "c") -> str:
    return f"""
SELECT {src}.claim_id, {src}.patient_id, {src}.provider_id, {M(f'{src}.claim_total_amount')} AS claim_total_amount,
  {D(f'{src}.service_date')} AS service_date, {D(f'{src}.submission_date')} AS submission_date,
  {D(processing_date)} AS processing_date, {status} AS status,
  CAST(NULL AS VARCHAR) AS denial_reason, CAST(NULL AS VARCHAR) AS procedure_code, CAST(NULL AS VARCHAR) AS diagnosis_code,
  {M(f'{src}.insurance_paid_amount')} AS insurance_paid_amount,
  {M(f'{src}.patient_responsibility')} AS patient_responsibility,
  {M(f'{src}.adjustment_amount')} AS adjustment_amount,
  {_NOW} AS created_at, {updated_at} AS updated_at
"""


CONFORMED_CLAIMS = _claims_select("c.status", "c.processing_date", _NOW) + "FROM claims c"

CONFORMED_ENCOUNTERS = f"""
SELECT encounter_id, patient_id, provider_id, {D('encounter_date')} AS encounter_date, encounter_type,
  CAST(NULL AS VARCHAR) AS chief_complaint, array_to_string(diagnosis_codes, ',') AS diagnosis_codes,
  CAST(NULL AS VARCHAR) AS procedure_codes, documentation_complete, billing_submitted,
  {_NOW} AS created_at, {_NOW} AS updated_at
FROM encounters
"""

CLAIMS_AFTER_PROCESSING = _claims_select(
    "CASE WHEN u.uid IS NOT NULL THEN 'PROCESSED' ELSE c.status END",
    "CASE WHEN u.uid IS NOT NULL THEN DATE '2024-02-01' ELSE c.processing_date END",
    f"CASE WHEN u.uid IS NOT NULL THEN {_LATER} ELSE {_NOW} END",
) + """FROM claims c
LEFT JOIN (SELECT claim_id AS uid FROM claims WHERE status = 'PENDING') u ON u.uid = c.claim_id
"""


def _json(*fields: str, **raw: str) -> str:
    """A JSON record of text columns, in order; ``raw`` gives other columns' text."""
    return "'{' || " + " || ',' || ".join(
        f"""'"{f}":' || coalesce({raw.get(f, f"to_json({f}::VARCHAR)::VARCHAR")}, 'null')""" for f in fields) + " || '}'"


def _cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(20,2)) AS VARCHAR)"


_MISSING_JSON = "'[\"' || " + _PATIENT_MISSING_5.replace("concat_ws(','", "concat_ws('\",\"'") + " || '\"]'"
_GAP_PERCENT = "CASE WHEN claim_total_amount <> 0 THEN " + _cents("round(gap / claim_total_amount * 100, 2)") + " END"

# Per check: its rows as JSON records, the record's id and the order of the report.
_RECORDS = {
    "patient_completeness": (
        "patient_id", "patient_id", f"FROM patient_records WHERE {_PATIENT_INCOMPLETE_WHERE}",
        _json("patient_id", "name", "date_of_birth", "insurance_id", "primary_provider", "contact_phone", "contact_email",
              "missing_fields", missing_fields=_MISSING_JSON)),
    "claims_discrepancies": (
        "claim_id", "gap DESC, claim_id", f"FROM ({_C06_TOTALS}) t WHERE gap >= 0.02",
        _json("claim_id", "patient_id", "provider_id", "claim_total_amount", "calculated_total", "line_item_count",
              "discrepancy_amount", "discrepancy_percentage", claim_total_amount=_cents("claim_total_amount"),
              calculated_total=_cents("calculated_total"), line_item_count="line_item_count::VARCHAR",
              discrepancy_amount=_cents("gap"), discrepancy_percentage=_GAP_PERCENT)),
    "temporal_anomalies": (
        "claim_id", "claim_id", f"FROM ({_P03_ROWS}) r",
        _json("claim_id", "patient_id", "service_date", "submission_date", "processing_date", "anomaly_type",
              anomaly_type="to_json(faults[1])::VARCHAR")),
    "duplicate_records": (
        "first_id", "duplicate_count DESC, first_id", f"FROM ({_P04_GROUPS}) g",
        _json("name", "date_of_birth", "duplicate_count", "first_id", duplicate_count="duplicate_count::VARCHAR")),
    "provider_credentials": (
        "provider_id", "license_expiry_date, provider_id", f"FROM ({_P05_ROWS}) p",
        _json("provider_id", "provider_name", "license_number", "license_state", "license_expiry_date", "days_expired",
              days_expired="days_expired::VARCHAR")),
}

REPORT_PREVIEW = "WITH previews AS (" + " UNION ALL ".join(
    f"SELECT '{key}' AS check_key, {rid} AS record_id, row_number() OVER (ORDER BY {order}) AS preview_rank, "
    f"count(*) OVER () AS issues_found, {record} AS row_json {source}"
    for key, (rid, order, source, record) in _RECORDS.items()) + """),
names AS (
  SELECT * FROM (VALUES ('patient_completeness', 'Patient Completeness'), ('claims_discrepancies', 'Claims Discrepancies'),
    ('temporal_anomalies', 'Temporal Anomalies'), ('duplicate_records', 'Duplicate Records'),
    ('provider_credentials', 'Provider Credentials')) v(check_key, check_name))
SELECT check_key, check_name, issues_found, preview_rank, record_id, row_json
FROM previews JOIN names USING (check_key) WHERE preview_rank <= 10
"""

_ALL = ["patient_records", "providers", "claims", "claims_line_items"]

_LATEST = """
latest AS (
  SELECT audit_id, status, event_time,
    last_value(assigned_to IGNORE NULLS) OVER so_far AS assigned_to, last_value(resolution_notes IGNORE NULLS) OVER so_far AS resolution_notes
  FROM audit_events WINDOW so_far AS (PARTITION BY audit_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING)
  QUALIFY row_number() OVER (PARTITION BY audit_id ORDER BY event_time DESC, event_id DESC) = 1),
log AS (
  SELECT q.audit_id, q.check_timestamp, q.check_type, q.table_name, q.record_id, q.issue_type, CAST(NULL AS VARCHAR) AS issue_description,
    q.severity, coalesce(e.status, 'OPEN') AS status, e.assigned_to, e.resolution_notes,
    CASE e.status WHEN 'RESOLVED' THEN e.event_time END AS resolved_at
  FROM quality_audit_log q LEFT JOIN latest e USING (audit_id))
"""

AUDIT_LOG_CURRENT = f"""
WITH {_LATEST.strip()}
SELECT * REPLACE (CAST(check_timestamp AS VARCHAR) AS check_timestamp, CAST(resolved_at AS VARCHAR) AS resolved_at) FROM log
"""

RESOLUTION_TIMES_FROM_EVENTS = f"""
WITH {_LATEST.strip()}
SELECT check_type, count(*) AS resolved_count,
  round(avg(CAST(date_diff('second', check_timestamp, resolved_at) AS DOUBLE) / 3600), 2) AS avg_resolution_hours
FROM log WHERE status = 'RESOLVED' GROUP BY check_type
"""

_TIMELINE = """
entries AS (
  SELECT audit_id, 'OPEN' AS status, check_timestamp AS since, -1 AS no FROM quality_audit_log
  UNION ALL SELECT audit_id, status, event_time, event_id FROM audit_events WHERE audit_id IN (SELECT audit_id FROM quality_audit_log)),
timeline AS (
  SELECT audit_id, row_number() OVER w AS entry_no, status, since AS valid_from, lead(since) OVER w AS valid_to
  FROM entries WINDOW w AS (PARTITION BY audit_id ORDER BY since, no))
"""

AUDIT_STATUS_TIMELINE = f"""
WITH {_TIMELINE.strip()}
SELECT audit_id, entry_no, status, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM timeline
"""

TIME_IN_STATUS = f"""
WITH {_TIMELINE.strip()}
SELECT status, count(*) AS stays, round(avg(CAST(date_diff('second', valid_from, valid_to) AS DOUBLE) / 3600), 2) AS avg_hours
FROM timeline WHERE valid_to IS NOT NULL GROUP BY status
"""

NEWLY_REPEATED_CLAIMS = f"""
WITH arrived AS (
  SELECT *, day(submission_date) % 3 AS batch_id,
    row_number() OVER (PARTITION BY patient_id, provider_id, service_date, claim_total_amount
                       ORDER BY day(submission_date) % 3, claim_id) AS nth
  FROM claims WHERE submission_date IS NOT NULL),
firsts AS (
  SELECT patient_id, provider_id, service_date, claim_total_amount, batch_id AS since FROM arrived WHERE nth = 2)
SELECT f.patient_id, f.provider_id, {D('f.service_date')} AS service_date, {M('f.claim_total_amount')} AS claim_total_amount,
  count(*) AS n, min(a.claim_id) AS first_id, since AS batch_id
FROM firsts f JOIN arrived a ON a.batch_id <= f.since AND a.patient_id IS NOT DISTINCT FROM f.patient_id
  AND a.provider_id IS NOT DISTINCT FROM f.provider_id AND a.service_date = f.service_date
  AND a.claim_total_amount IS NOT DISTINCT FROM f.claim_total_amount
GROUP BY f.patient_id, f.provider_id, f.service_date, f.claim_total_amount, since
"""
_LOG = ["quality_audit_log", "audit_events"]

MAINTENANCE = {
    "claims_after_stored_update": (["claims"], CLAIMS_AFTER_PROCESSING),
    "newly_repeated_claims": (["claims"], NEWLY_REPEATED_CLAIMS),
    "audit_log_current": (_LOG, AUDIT_LOG_CURRENT),
    "audit_status_timeline": (_LOG, AUDIT_STATUS_TIMELINE),
    "time_in_status": (_LOG, TIME_IN_STATUS),
    "resolution_times_from_events": (_LOG, RESOLUTION_TIMES_FROM_EVENTS),
    "conformed_claims": (["claims"], CONFORMED_CLAIMS),
    "conformed_encounters": (["encounters"], CONFORMED_ENCOUNTERS),
    "claims_after_processing": (["claims"], CLAIMS_AFTER_PROCESSING),
    "report_preview": (_ALL, REPORT_PREVIEW),
    "investigate_claims_billing_validation": (["claims", "claims_line_items"], CLAIM_LINE_MISMATCH),
    "investigate_patient_records_completeness_csv": (
        ["patient_records"], f"SELECT * REPLACE (replace(missing_fields, ',', ', ') AS missing_fields) FROM ({INCOMPLETE_PATIENTS})"),
    "investigate_providers_completeness_csv": (
        ["providers"], f"SELECT * REPLACE (replace(missing_fields, ',', ', ') AS missing_fields) FROM ({INCOMPLETE_PROVIDERS})"),
    "investigate_encounters_billing": (["encounters"], DOCUMENTED_NOT_BILLED),
    **{f"json_{key}": (_ALL, f"SELECT {record} AS record {source}") for key, (_, _, source, record) in _RECORDS.items()},
}
