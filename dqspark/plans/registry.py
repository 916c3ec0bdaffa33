"""``investigate(table, check_type)`` (R4): look up a check by table and kind.

The reference's documented usage is ``investigate_discrepancies(table='claims',
check_type='billing_validation')`` followed by a CSV export; here the
registry maps (table, check type) to the operator and returns its lazy
detail DataFrame, which ``sinks.export_csv`` writes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame

from ..functions.exprs import as_date
from ..operators import claims as C
from ..operators import encounters as E
from ..operators import patients as P
from ..operators import providers as V

Investigation = Callable[[SimpleNamespace, dt.date], DataFrame]

INVESTIGATIONS: dict[tuple[str, str], Investigation] = {
    ("claims", "billing_validation"): lambda t, d: C.claim_line_mismatch(t.claims, t.claims_line_items),
    ("claims", "payment_validation"): lambda t, d: C.payment_mismatch(t.claims),
    ("claims", "temporal_validation"): lambda t, d: C.temporal_anomalies(t.claims),
    ("claims", "pending_claims"): lambda t, d: C.long_pending_claims(t.claims, d),
    ("claims", "duplicates"): lambda t, d: C.duplicate_claims(t.claims),
    ("claims", "orphan_patient"): lambda t, d: C.orphan_claims_patient(t.claims, t.patient_records),
    ("claims", "orphan_provider"): lambda t, d: C.orphan_claims_provider(t.claims, t.providers),
    ("claims", "high_amount"): lambda t, d: C.high_amount_claims(t.claims),
    ("claims", "high_frequency"): lambda t, d: C.frequent_claimants(t.claims, t.patient_records, d),
    ("patient_records", "completeness"): lambda t, d: P.incomplete_patients(t.patient_records),
    ("patient_records", "dob_validation"): lambda t, d: P.invalid_dob(t.patient_records, d),
    ("patient_records", "phone_validation"): lambda t, d: P.invalid_phone(t.patient_records),
    ("patient_records", "email_validation"): lambda t, d: P.invalid_email(t.patient_records),
    ("patient_records", "duplicates"): lambda t, d: P.duplicate_patients(t.patient_records),
    ("patient_records", "freshness"): lambda t, d: P.stale_patients(t.patient_records, d),
    ("providers", "credentials"): lambda t, d: V.expired_licenses(t.providers, d),
    ("providers", "completeness"): lambda t, d: V.incomplete_providers(t.providers),
    ("encounters", "documentation"): lambda t, d: E.incomplete_encounters(t.encounters, d),
    ("encounters", "billing"): lambda t, d: E.documented_not_billed(t.encounters, d),
}


def investigate(tables, table: str, check_type: str, as_of: dt.date | str | None = None) -> DataFrame:
    """Detail rows of the check registered for (``table``, ``check_type``).
    ``tables`` has the healthcare tables as attributes or dict entries."""
    t = SimpleNamespace(**tables) if isinstance(tables, dict) else tables
    try:
        fn = INVESTIGATIONS[(table, check_type)]
    except KeyError:
        known = ", ".join(f"{a}/{b}" for a, b in sorted(INVESTIGATIONS))
        raise KeyError(f"no check for {table}/{check_type}; known: {known}") from None
    return fn(t, as_date(as_of))
