"""DuckDB derivation of the healthcare test tables, as CTE bodies.

Written independently of the DataFrame derivation in
``dqspark.sources.fixtures``; the oracle queries prepend the CTEs they need.
"""

from __future__ import annotations

PATIENT_RECORDS = """
SELECT 'P'||k AS patient_id,
 CASE WHEN k2%17=0 THEN NULL ELSE 'Name '||k2 END AS name,
 CASE WHEN k2%19=0 THEN NULL WHEN k2%29=0 THEN DATE '2030-01-01' WHEN k2%31=0 THEN DATE '1890-05-05'
      WHEN k2%37=0 THEN DATE '1901-06-06' ELSE DATE '1930-01-01'+CAST((k2*37)%25000 AS INT) END AS date_of_birth,
 CASE WHEN k%13=0 THEN NULL ELSE 'I'||k END AS insurance_id,
 CASE WHEN k%11=0 THEN NULL ELSE 'D'||(k%10) END AS primary_provider,
 CASE WHEN k%7=0 THEN NULL WHEN k%9=0 THEN '555-0' WHEN k%43=0 THEN '+1 (555) 123-4567 ext 89'
      ELSE '(555) 123-'||CAST(1000+k%9000 AS VARCHAR) END AS contact_phone,
 CASE WHEN k%5=0 THEN NULL WHEN k%8=0 THEN 'user'||k||'.example.com' ELSE 'user'||k||'@example.com' END AS contact_email,
 CAST(DATE '2024-02-01'-CAST((k*17)%2000+1000 AS INT) AS TIMESTAMP) AS created_at,
 CAST(DATE '2024-02-01'-CAST((k*13)%1500 AS INT) AS TIMESTAMP) AS updated_at,
 DATE '2024-02-01'-CAST((k*11)%900 AS INT) AS last_visit_date,
 CASE WHEN k%41=0 THEN NULL ELSE k%10<>3 END AS is_active
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey%23=1 THEN c_custkey-1 ELSE c_custkey END AS k2 FROM customer) t
"""

PROVIDERS = """
SELECT 'D'||s_suppkey AS provider_id, CASE WHEN s_suppkey%10=9 THEN NULL ELSE s_name END AS provider_name,
 CASE WHEN s_suppkey%4=3 THEN NULL ELSE 'Cardiology' END AS specialty,
 CASE WHEN s_suppkey%5=1 THEN NULL WHEN s_suppkey%8=0 THEN '1000000000' ELSE CAST(1000000000+s_suppkey AS VARCHAR) END AS npi_number,
 CASE WHEN s_suppkey%7=2 THEN NULL ELSE 'L'||s_suppkey END AS license_number, 'CA' AS license_state,
 DATE '2024-02-01'+CAST((s_suppkey*97)%1000-300 AS INT) AS license_expiry_date,
 CASE WHEN s_suppkey%9=4 THEN NULL ELSE 'd'||s_suppkey||'@example.com' END AS contact_email,
 s_suppkey%6<>5 AS is_active
FROM supplier
"""

CLAIMS_LINE_ITEMS = """
SELECT CASE WHEN l_partkey%83=0 THEN 'C-missing' ELSE 'C'||l_orderkey END AS claim_id,
 l_orderkey*10+l_linenumber AS line_item_id,
 CAST(CAST(CAST(ROUND(l_extendedprice*100) AS BIGINT)%1200000 AS DECIMAL(10,0))*CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS line_item_amount
FROM lineitem
"""

CLAIMS = """
SELECT cid AS claim_id, patient_id, provider_id, claim_total_amount, service_date, submission_date,
 CASE WHEN status IN ('SUBMITTED','PENDING') THEN NULL WHEN k%33=0 THEN submission_date-3 ELSE submission_date+5 END AS processing_date,
 status,
 CAST(claim_total_amount-20 AS DECIMAL(10,2)) AS insurance_paid_amount,
 CAST(20 AS DECIMAL(10,2)) AS patient_responsibility,
 CASE WHEN k%6=0 THEN NULL WHEN k%23=0 THEN CAST(5 AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS adjustment_amount
FROM (
 SELECT k, cid,
  CASE WHEN k%101=0 THEN NULL WHEN k%97=0 THEN 'P-missing-'||k WHEN k%3=1 THEN 'P7' ELSE 'P'||o_custkey END AS patient_id,
  CASE WHEN k%89=0 THEN 'D-missing' ELSE 'D'||(k%10) END AS provider_id,
  CAST(CASE WHEN k%53=0 THEN NULL WHEN k%59=0 THEN 0
       ELSE COALESCE(lt,500)+CASE WHEN k%37=0 THEN 150.25 WHEN k%43=0 THEN 2500 WHEN k%47=0 THEN 0.01 ELSE 0 END END AS DECIMAL(10,2)) AS claim_total_amount,
  CAST(o_orderdate AS DATE)+8210 AS service_date,
  CAST(o_orderdate AS DATE)+8210+CASE WHEN k%31=0 THEN -2 ELSE CAST(k%10 AS INT) END AS submission_date,
  CASE WHEN k%71=0 THEN 'VOID' WHEN k%79=0 THEN NULL WHEN k%5=0 THEN 'SUBMITTED' WHEN k%5=1 THEN 'PENDING'
       WHEN k%5=2 THEN 'PROCESSED' WHEN k%5=3 THEN 'DENIED' ELSE 'PAID' END AS status
 FROM (SELECT o_orderkey AS k, 'C'||o_orderkey AS cid, o_custkey, o_orderdate FROM orders
       UNION ALL
       SELECT o_orderkey, 'C'||o_orderkey||'-dup', o_custkey, o_orderdate FROM orders WHERE o_orderkey%61=0) o
 LEFT JOIN (SELECT claim_id, SUM(line_item_amount) AS lt FROM claims_line_items GROUP BY claim_id) l
   ON l.claim_id='C'||k
) x
"""

ENCOUNTERS = """
SELECT 'E'||event_id AS encounter_id, 'P'||user_id AS patient_id, 'D'||(event_id%10) AS provider_id,
 CAST(ts AS DATE) AS encounter_date, event_type AS encounter_type,
 string_split('E11,I10', ',') AS diagnosis_codes,
 event_id%3<>0 AS documentation_complete, event_id%4<>0 AS billing_submitted
FROM events
"""

QUALITY_AUDIT_LOG = """
SELECT event_id AS audit_id, ts AS check_timestamp,
 CASE WHEN event_type='view' THEN 'completeness_check' WHEN event_type='error' THEN 'temporal_check' ELSE 'discrepancy_check' END AS check_type,
 CASE WHEN event_type='view' THEN 'patient_records' ELSE 'claims' END AS table_name,
 'R'||user_id AS record_id, event_type AS issue_type,
 CASE WHEN event_id%61=0 THEN 'SEVERE' WHEN event_id%4=0 THEN 'LOW' WHEN event_id%4=1 THEN 'MEDIUM'
      WHEN event_id%4=2 THEN 'HIGH' ELSE 'CRITICAL' END AS severity,
 CASE WHEN event_id%3=0 THEN 'RESOLVED' WHEN event_id%3=1 THEN 'OPEN' ELSE 'ACKNOWLEDGED' END AS status,
 CASE WHEN event_id%3=0 THEN ts + INTERVAL '1' HOUR * CAST(event_id%72 AS INT) END AS resolved_at
FROM events
"""

# Dependency order: claims reads claims_line_items.
RAW_CLAIMS = """
SELECT CASE WHEN k%211=0 THEN NULL ELSE 'C'||k END AS claim_id, 'P'||o_custkey AS patient_id, 'D'||(k%10) AS provider_id,
 CASE WHEN k%113=0 THEN '123456789.00' WHEN k%127=0 THEN 'n/a' WHEN k%131=0 THEN '12.345' ELSE (k%90000)||'.50' END AS claim_total_amount,
 CASE WHEN k%137=0 THEN '2024-02-30' WHEN k%139=0 THEN NULL ELSE CAST(d AS VARCHAR) END AS service_date,
 CAST(d+CAST(k%10 AS INT) AS VARCHAR) AS submission_date, CASE WHEN k%149=0 THEN 'VOID' ELSE 'PENDING' END AS status,
 CASE WHEN k%151=0 THEN 'PROCEDURE-'||k ELSE 'PC'||(k%1000) END AS procedure_code
FROM (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE)+8210 AS d,
        unnest(CASE WHEN o_orderkey%67=0 THEN [0,1] ELSE [0] END) AS copy FROM orders) t
"""

RAW_ENCOUNTERS = """
SELECT 'E'||e AS encounter_id, CASE WHEN e%53=0 THEN 'P-none' ELSE 'P'||user_id END AS patient_id,
 CASE WHEN e%59=0 THEN 'D-none' ELSE 'D'||(1+e%9) END AS provider_id,
 CASE WHEN e%61=0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS encounter_date,
 CASE WHEN e%67=0 THEN repeat('visit ', 12) ELSE event_type END AS encounter_type
FROM (SELECT event_id AS e, user_id, ts, event_type, unnest(CASE WHEN event_id%71=0 THEN [0,1] ELSE [0] END) AS copy FROM events) t
"""

RAW_AUDIT_LOG = """
SELECT CAST(event_id AS VARCHAR) AS audit_id, CASE WHEN event_id%2=0 THEN 'LOW' ELSE 'HIGH' END AS severity,
 CASE WHEN event_id%73=0 THEN 'CLOSED' ELSE 'OPEN' END AS status
FROM events
"""

AUDIT_EVENTS = """
SELECT audit_id, x.event_id, x.status, x.event_time, x.assigned_to, x.resolution_notes
FROM (SELECT event_id AS audit_id, unnest(list_filter([
    CASE WHEN event_id%3=0 THEN {'event_id': event_id*10+1, 'status': 'IN_PROGRESS', 'event_time': ts + INTERVAL 1 HOUR,
      'assigned_to': 'A'||(event_id%7), 'resolution_notes': NULL::VARCHAR} END,
    CASE WHEN event_id%3=0 THEN {'event_id': event_id*10+2, 'status': 'RESOLVED', 'event_time': ts + to_hours(2+event_id%72),
      'assigned_to': NULL::VARCHAR, 'resolution_notes': 'checked'} END,
    CASE WHEN event_id%15=0 THEN {'event_id': event_id*10+3, 'status': 'OPEN', 'event_time': ts + INTERVAL 100 HOUR,
      'assigned_to': NULL::VARCHAR, 'resolution_notes': 'seen again'} END,
    CASE WHEN event_id%5=1 THEN {'event_id': event_id*10+4, 'status': 'ACKNOWLEDGED', 'event_time': ts + INTERVAL 3 HOUR,
      'assigned_to': NULL::VARCHAR, 'resolution_notes': NULL::VARCHAR} END,
    CASE WHEN event_id%25=1 THEN {'event_id': event_id*10+5, 'status': 'RESOLVED', 'event_time': ts + INTERVAL 3 HOUR,
      'assigned_to': NULL::VARCHAR, 'resolution_notes': NULL::VARCHAR} END], lambda v: v IS NOT NULL)) AS x FROM events) t
"""

CTES = {
    "patient_records": PATIENT_RECORDS,
    "providers": PROVIDERS,
    "claims_line_items": CLAIMS_LINE_ITEMS,
    "claims": CLAIMS,
    "encounters": ENCOUNTERS,
    "quality_audit_log": QUALITY_AUDIT_LOG,
    "audit_events": AUDIT_EVENTS,
    "raw_claims": RAW_CLAIMS,
    "raw_encounters": RAW_ENCOUNTERS,
    "raw_audit_log": RAW_AUDIT_LOG,
}
_DEPS = {"claims": ["claims_line_items"]}


def with_tables(tables: list[str], body: str) -> str:
    """``WITH`` clause defining ``tables`` (plus dependencies), then ``body``."""
    need: list[str] = []
    for t in tables:
        for d in _DEPS.get(t, []) + [t]:
            if d not in need:
                need.append(d)
    order = [t for t in CTES if t in need]
    ctes = ",\n".join(f"{t} AS ({CTES[t].strip()})" for t in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        # The body's own CTEs follow the table CTEs in the same WITH clause.
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
