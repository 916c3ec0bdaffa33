"""DuckDB oracle SQL for the declared constraints (K1–K7)."""

from __future__ import annotations

PK_CLAIMS_LINE_ITEMS = """
SELECT line_item_id, COUNT(*) AS occurrences FROM claims_line_items
GROUP BY line_item_id HAVING COUNT(*) > 1 OR line_item_id IS NULL
"""

PK_CLAIMS = """
SELECT claim_id, COUNT(*) AS occurrences FROM claims
GROUP BY claim_id HAVING COUNT(*) > 1 OR claim_id IS NULL
"""

NOT_NULL_PROVIDERS = """
SELECT provider_id, 'provider_name' AS column_name FROM providers WHERE provider_name IS NULL
"""

UNIQUE_PROVIDER_NPI = """
SELECT npi_number, COUNT(*) AS occurrences FROM providers
WHERE npi_number IS NOT NULL GROUP BY npi_number HAVING COUNT(*) > 1
"""


def _fk(child: str, id_col: str, key: str, parent: str, parent_key: str) -> str:
    return f"""
SELECT c.{id_col}, c.{key} FROM {child} c
WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})
"""


# The status and severity domains and the VARCHAR limits below equal the declared schema's.
DOMAIN_CLAIMS_STATUS = """
SELECT claim_id, status FROM claims
WHERE status NOT IN ('SUBMITTED', 'PENDING', 'PROCESSED', 'DENIED', 'PAID')
"""

DOMAIN_AUDIT_SEVERITY = """
SELECT audit_id, severity FROM quality_audit_log WHERE severity NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')
"""

DOMAIN_AUDIT_STATUS = """
SELECT audit_id, status FROM quality_audit_log
WHERE status NOT IN ('OPEN', 'IN_PROGRESS', 'RESOLVED', 'ACKNOWLEDGED')
"""

# VARCHAR limits of the patient_records columns the fixture carries.
_PATIENT_LIMITS = [("patient_id", 50), ("name", 255), ("insurance_id", 100), ("primary_provider", 255),
                   ("contact_phone", 20), ("contact_email", 255)]

MAX_LENGTH_PATIENT_RECORDS = "\nUNION ALL\n".join(
    f"SELECT patient_id, '{c}' AS column_name, CAST(length({c}) AS BIGINT) AS length, CAST({n} AS BIGINT) AS max_length "
    f"FROM patient_records WHERE length({c}) > {n}"
    for c, n in _PATIENT_LIMITS
)

DECIMAL_RANGE_LINE_TOTALS = """
SELECT claim_id, 'calculated_total' AS column_name, CAST(calculated_total AS VARCHAR) AS value
FROM (SELECT claim_id, SUM(line_item_amount) AS calculated_total FROM claims_line_items GROUP BY claim_id) t
WHERE calculated_total IS NOT NULL AND TRY_CAST(calculated_total AS DECIMAL(10,2)) IS NULL
"""

_CLAIM_LIMITS = [("claim_id", 50), ("patient_id", 50), ("provider_id", 50), ("status", 20)]
_CLAIM_MONEY = ["claim_total_amount", "insurance_paid_amount", "patient_responsibility", "adjustment_amount"]

TABLE_VIOLATIONS_CLAIMS = "\nUNION ALL\n".join(
    [
        "SELECT 'claims' AS table_name, 'primary_key' AS constraint_type, 'claim_id' AS column_name, "
        "claim_id AS record_id, 'occurrences=' || COUNT(*) AS detail FROM claims "
        "GROUP BY claim_id HAVING COUNT(*) > 1 OR claim_id IS NULL",
        "SELECT 'claims', 'not_null', 'service_date', claim_id, NULL FROM claims WHERE service_date IS NULL",
        "SELECT 'claims', 'not_null', 'submission_date', claim_id, NULL FROM claims WHERE submission_date IS NULL",
        "SELECT 'claims', 'foreign_key', 'patient_id', c.claim_id, c.patient_id FROM claims c "
        "WHERE c.patient_id IS NOT NULL AND c.patient_id NOT IN (SELECT patient_id FROM patient_records)",
        "SELECT 'claims', 'foreign_key', 'provider_id', c.claim_id, c.provider_id FROM claims c "
        "WHERE c.provider_id IS NOT NULL AND c.provider_id NOT IN (SELECT provider_id FROM providers)",
        "SELECT 'claims', 'domain', 'status', claim_id, status FROM claims "
        "WHERE status NOT IN ('SUBMITTED', 'PENDING', 'PROCESSED', 'DENIED', 'PAID')",
    ]
    + [
        f"SELECT 'claims', 'max_length', '{c}', claim_id, CAST(length({c}) AS VARCHAR) FROM claims WHERE length({c}) > {n}"
        for c, n in _CLAIM_LIMITS
    ]
    + [
        f"SELECT 'claims', 'decimal_range', '{c}', claim_id, CAST({c} AS VARCHAR) FROM claims "
        f"WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(10,2)) IS NULL"
        for c in _CLAIM_MONEY
    ]
)

_PROVIDER_LIMITS = [("provider_id", 50), ("provider_name", 255), ("specialty", 100), ("npi_number", 10),
                    ("license_number", 50), ("license_state", 2), ("contact_email", 255)]

TABLE_VIOLATIONS_PROVIDERS = "\nUNION ALL\n".join(
    [
        "SELECT 'providers' AS table_name, 'primary_key' AS constraint_type, 'provider_id' AS column_name, "
        "provider_id AS record_id, 'occurrences=' || COUNT(*) AS detail FROM providers "
        "GROUP BY provider_id HAVING COUNT(*) > 1 OR provider_id IS NULL",
        "SELECT 'providers', 'not_null', 'provider_name', provider_id, NULL FROM providers WHERE provider_name IS NULL",
        "SELECT 'providers', 'unique', 'npi_number', npi_number, 'occurrences=' || COUNT(*) FROM providers "
        "WHERE npi_number IS NOT NULL GROUP BY npi_number HAVING COUNT(*) > 1",
    ]
    + [
        f"SELECT 'providers', 'max_length', '{c}', provider_id, CAST(length({c}) AS VARCHAR) FROM providers "
        f"WHERE length({c}) > {n}"
        for c, n in _PROVIDER_LIMITS
    ]
)

TABLE_VIOLATIONS_LINE_ITEMS = "\nUNION ALL\n".join(
    [
        "SELECT 'claims_line_items' AS table_name, 'primary_key' AS constraint_type, 'line_item_id' AS column_name, "
        "CAST(line_item_id AS VARCHAR) AS record_id, 'occurrences=' || COUNT(*) AS detail FROM claims_line_items "
        "GROUP BY line_item_id HAVING COUNT(*) > 1 OR line_item_id IS NULL",
        "SELECT 'claims_line_items', 'foreign_key', 'claim_id', CAST(l.line_item_id AS VARCHAR), l.claim_id "
        "FROM claims_line_items l WHERE l.claim_id IS NOT NULL AND l.claim_id NOT IN (SELECT claim_id FROM claims)",
        "SELECT 'claims_line_items', 'not_null', 'procedure_code', CAST(line_item_id AS VARCHAR), 'column is absent' "
        "FROM claims_line_items",
        "SELECT 'claims_line_items', 'max_length', 'claim_id', CAST(line_item_id AS VARCHAR), "
        "CAST(length(claim_id) AS VARCHAR) FROM claims_line_items WHERE length(claim_id) > 50",
        "SELECT 'claims_line_items', 'decimal_range', 'line_item_amount', CAST(line_item_id AS VARCHAR), "
        "CAST(line_item_amount AS VARCHAR) FROM claims_line_items "
        "WHERE line_item_amount IS NOT NULL AND TRY_CAST(line_item_amount AS DECIMAL(10,2)) IS NULL",
    ]
)

_ENCOUNTER_LIMITS = [("encounter_id", 50), ("patient_id", 50), ("provider_id", 50), ("encounter_type", 50)]

TABLE_VIOLATIONS_ENCOUNTERS = "\nUNION ALL\n".join(
    [
        "SELECT 'encounters' AS table_name, 'primary_key' AS constraint_type, 'encounter_id' AS column_name, "
        "encounter_id AS record_id, 'occurrences=' || COUNT(*) AS detail FROM encounters "
        "GROUP BY encounter_id HAVING COUNT(*) > 1 OR encounter_id IS NULL",
        "SELECT 'encounters', 'not_null', 'encounter_date', encounter_id, NULL FROM encounters WHERE encounter_date IS NULL",
        "SELECT 'encounters', 'foreign_key', 'patient_id', e.encounter_id, e.patient_id FROM encounters e "
        "WHERE e.patient_id IS NOT NULL AND e.patient_id NOT IN (SELECT patient_id FROM patient_records)",
        "SELECT 'encounters', 'foreign_key', 'provider_id', e.encounter_id, e.provider_id FROM encounters e "
        "WHERE e.provider_id IS NOT NULL AND e.provider_id NOT IN (SELECT provider_id FROM providers)",
    ]
    + [
        f"SELECT 'encounters', 'max_length', '{c}', encounter_id, CAST(length({c}) AS VARCHAR) FROM encounters "
        f"WHERE length({c}) > {n}"
        for c, n in _ENCOUNTER_LIMITS
    ]
)

# --- Rows as they arrive ----------------------------------------------------

PK_RAW_CLAIMS = """
SELECT claim_id, max(n) AS occurrences FROM (SELECT claim_id, count(*) OVER (PARTITION BY claim_id) AS n FROM raw_claims) t
WHERE n > 1 OR claim_id IS NULL GROUP BY claim_id
"""

NOT_NULL_RAW_CLAIMS = """
SELECT claim_id, column_name FROM (
  SELECT claim_id, unnest([IF(service_date IS NULL, 'service_date', NULL), IF(submission_date IS NULL, 'submission_date', NULL)])
    AS column_name FROM raw_claims) t
WHERE column_name IS NOT NULL
"""

NOT_NULL_LINE_ITEMS = "SELECT line_item_id, 'procedure_code' AS column_name FROM claims_line_items"

NOT_NULL_RAW_ENCOUNTERS = """
SELECT encounter_id, 'encounter_date' AS column_name FROM raw_encounters WHERE encounter_date IS NULL
"""

DOMAIN_RAW_AUDIT_STATUS = """
SELECT audit_id, status FROM raw_audit_log WHERE NOT list_contains(['ACKNOWLEDGED', 'IN_PROGRESS', 'OPEN', 'RESOLVED'], status)
"""

DECIMAL_RANGE_RAW_CLAIMS = """
SELECT claim_id, 'claim_total_amount' AS column_name, CAST(TRY_CAST(claim_total_amount AS DECIMAL(38,10)) AS VARCHAR) AS value
FROM raw_claims WHERE abs(TRY_CAST(claim_total_amount AS DECIMAL(38,10))) >= 99999999.995
"""

TABLE_VIOLATIONS_RAW_ENCOUNTERS = """
SELECT 'encounters' AS table_name, 'primary_key' AS constraint_type, 'encounter_id' AS column_name, encounter_id AS record_id,
  'occurrences=' || count(*) AS detail FROM raw_encounters GROUP BY encounter_id HAVING count(*) > 1
UNION ALL
SELECT 'encounters', 'foreign_key', 'patient_id', r.encounter_id, r.patient_id
FROM raw_encounters r ANTI JOIN patient_records p ON p.patient_id = r.patient_id
UNION ALL
SELECT 'encounters', 'foreign_key', 'provider_id', NULL, 'not checked: providers is not given'
UNION ALL
SELECT 'encounters', 'not_null', 'encounter_date', encounter_id, NULL FROM raw_encounters WHERE encounter_date IS NULL
UNION ALL
SELECT 'encounters', 'max_length', 'encounter_type', encounter_id, CAST(length(encounter_type) AS VARCHAR)
FROM raw_encounters WHERE length(encounter_type) > 50
"""

# One row per raw claim with the constraints it breaks, in the declared order of the columns.
_CLAIM_TESTS = """
SELECT *, list_filter([
  IF(claim_id IS NULL, {'t': 'not_null', 'c': 'claim_id', 'd': NULL}, NULL),
  IF(claim_total_amount IS NOT NULL AND TRY_CAST(claim_total_amount AS DECIMAL(38,10)) IS NULL,
     {'t': 'type', 'c': 'claim_total_amount', 'd': claim_total_amount}, NULL),
  IF(abs(TRY_CAST(claim_total_amount AS DECIMAL(38,10))) >= 99999999.995,
     {'t': 'decimal_range', 'c': 'claim_total_amount', 'd': claim_total_amount}, NULL),
  IF(service_date IS NULL, {'t': 'not_null', 'c': 'service_date', 'd': NULL}, NULL),
  IF(service_date IS NOT NULL AND TRY_CAST(service_date AS DATE) IS NULL, {'t': 'type', 'c': 'service_date', 'd': service_date}, NULL),
  IF(submission_date IS NULL, {'t': 'not_null', 'c': 'submission_date', 'd': NULL}, NULL),
  IF(status NOT IN ('SUBMITTED', 'PENDING', 'PROCESSED', 'DENIED', 'PAID'), {'t': 'domain', 'c': 'status', 'd': status}, NULL),
  IF(length(procedure_code) > 10, {'t': 'max_length', 'c': 'procedure_code', 'd': CAST(length(procedure_code) AS VARCHAR)}, NULL)
], lambda v: v IS NOT NULL) AS broken FROM raw_claims
"""


def _rejected(table: str, key: str, columns: list[str], tests: str) -> str:
    raw = " || ',' || ".join(f"""'"{c}":' || coalesce(to_json({c})::VARCHAR, 'null')""" for c in columns)
    return f"""
SELECT '{table}' AS table_name, {key} AS record_id,
  array_to_string(list_transform(broken, lambda v: v.c || ': ' || v.t || coalesce(' ' || v.d, '')), ',') AS reasons,
  '{{' || {raw} || '}}' AS raw
FROM ({tests}) t WHERE len(broken) > 0
"""


REJECTED_CLAIMS = _rejected("claims", "claim_id", ["claim_id", "patient_id", "provider_id", "claim_total_amount", "service_date",
                                                   "submission_date", "status", "procedure_code"], _CLAIM_TESTS)

REJECTED_CLAIM_VIOLATIONS = f"""
SELECT 'claims' AS table_name, v.t AS constraint_type, v.c AS column_name, claim_id AS record_id, v.d AS detail
FROM (SELECT claim_id, unnest(broken) AS v FROM ({_CLAIM_TESTS}) t) u
"""

ACCEPTED_CLAIMS = f"""
SELECT claim_id, patient_id, provider_id, CAST(CAST(claim_total_amount AS DECIMAL(10,2)) AS DOUBLE) AS claim_total_amount,
  CAST(CAST(service_date AS DATE) AS VARCHAR) AS service_date, CAST(CAST(submission_date AS DATE) AS VARCHAR) AS submission_date,
  CAST(NULL AS VARCHAR) AS processing_date, status, CAST(NULL AS VARCHAR) AS denial_reason, procedure_code,
  CAST(NULL AS VARCHAR) AS diagnosis_code, CAST(NULL AS DOUBLE) AS insurance_paid_amount,
  CAST(NULL AS DOUBLE) AS patient_responsibility, CAST(0 AS DOUBLE) AS adjustment_amount,
  '2024-02-01 00:00:00' AS created_at, '2024-02-01 00:00:00' AS updated_at
FROM ({_CLAIM_TESTS}) t WHERE len(broken) = 0
"""

_ENCOUNTER_TESTS = """
SELECT *, list_filter([
  IF(encounter_date IS NULL, {'t': 'not_null', 'c': 'encounter_date', 'd': NULL}, NULL),
  IF(length(encounter_type) > 50, {'t': 'max_length', 'c': 'encounter_type', 'd': CAST(length(encounter_type) AS VARCHAR)}, NULL)
], lambda v: v IS NOT NULL) AS broken FROM raw_encounters
"""

REJECTED_ENCOUNTERS = _rejected("encounters", "encounter_id", ["encounter_id", "patient_id", "provider_id", "encounter_date",
                                                               "encounter_type"], _ENCOUNTER_TESTS)

CONSTRAINTS = {
    "pk_raw_claims": (["raw_claims"], PK_RAW_CLAIMS),
    "not_null_raw_claims": (["raw_claims"], NOT_NULL_RAW_CLAIMS),
    "not_null_claims_line_items": (["claims_line_items"], NOT_NULL_LINE_ITEMS),
    "not_null_raw_encounters": (["raw_encounters"], NOT_NULL_RAW_ENCOUNTERS),
    "fk_raw_encounters_patient": (["raw_encounters", "patient_records"],
                                  _fk("raw_encounters", "encounter_id", "patient_id", "patient_records", "patient_id")),
    "domain_raw_audit_status": (["raw_audit_log"], DOMAIN_RAW_AUDIT_STATUS),
    "decimal_range_raw_claims": (["raw_claims"], DECIMAL_RANGE_RAW_CLAIMS),
    "table_violations_raw_encounters": (["raw_encounters", "patient_records"], TABLE_VIOLATIONS_RAW_ENCOUNTERS),
    "accepted_claims": (["raw_claims"], ACCEPTED_CLAIMS),
    "rejected_claims": (["raw_claims"], REJECTED_CLAIMS),
    "rejected_claim_violations": (["raw_claims"], REJECTED_CLAIM_VIOLATIONS),
    "rejected_encounters": (["raw_encounters"], REJECTED_ENCOUNTERS),
    "pk_claims_line_items": (["claims_line_items"], PK_CLAIMS_LINE_ITEMS),
    "pk_claims": (["claims"], PK_CLAIMS),
    "not_null_providers": (["providers"], NOT_NULL_PROVIDERS),
    "unique_provider_npi": (["providers"], UNIQUE_PROVIDER_NPI),
    "fk_claims_patient": (["claims", "patient_records"], _fk("claims", "claim_id", "patient_id", "patient_records", "patient_id")),
    "fk_claims_provider": (["claims", "providers"], _fk("claims", "claim_id", "provider_id", "providers", "provider_id")),
    "fk_line_items_claim": (["claims_line_items", "claims"], _fk("claims_line_items", "line_item_id", "claim_id", "claims", "claim_id")),
    "fk_encounters_patient": (["encounters", "patient_records"], _fk("encounters", "encounter_id", "patient_id", "patient_records", "patient_id")),
    "domain_claims_status": (["claims"], DOMAIN_CLAIMS_STATUS),
    "domain_audit_severity": (["quality_audit_log"], DOMAIN_AUDIT_SEVERITY),
    "domain_audit_status": (["quality_audit_log"], DOMAIN_AUDIT_STATUS),
    "max_length_patient_records": (["patient_records"], MAX_LENGTH_PATIENT_RECORDS),
    "decimal_range_line_totals": (["claims_line_items"], DECIMAL_RANGE_LINE_TOTALS),
    "table_violations_claims": (["claims", "patient_records", "providers"], TABLE_VIOLATIONS_CLAIMS),
    "table_violations_providers": (["providers"], TABLE_VIOLATIONS_PROVIDERS),
    "table_violations_claims_line_items": (["claims_line_items", "claims"], TABLE_VIOLATIONS_LINE_ITEMS),
    "table_violations_encounters": (["encounters", "patient_records", "providers"], TABLE_VIOLATIONS_ENCOUNTERS),
}
