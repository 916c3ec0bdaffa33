"""All row-local checks of a table in one pass.

``flag_tables`` scans each table once. Every row is tested against all rules
of its table and carries the names of those it breaks (``failed_checks``); rows
that break none are dropped at the scan's task. Claims meet their line totals
in the same pass. The flagged rows are few and are written once, so any
number of checks, exports and previews read them instead of the tables:
``flagged_checks`` splits them into the single checks' detail rows.

``tallies`` is the pass for runs that only count: one scan of each table gives
its totals, its complete and failing records and the five checks' findings.
Distinct counts (failing ids, duplicate keys) go through the same exchange as
the plain counts, as tagged rows counted per key before they are shuffled.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import any_of, pct
from ..operators import claims as C
from ..operators import encounters as E
from ..operators import patients as P
from ..operators import providers as V
from ..operators.metrics import PROCESSED_STATUS, patients_complete, providers_complete
from ..session import checkpoint_dir

FAILED = "failed_checks"

COLUMNS = {
    "patient_records": ["patient_id", "name", "date_of_birth", "insurance_id", "primary_provider", "contact_phone",
                        "contact_email", "created_at", "updated_at", "last_visit_date", "is_active"],
    "providers": ["provider_id", "provider_name", "specialty", "npi_number", "license_number", "license_state",
                  "license_expiry_date", "contact_email", "is_active"],
    "encounters": ["encounter_id", "patient_id", "provider_id", "encounter_date", "encounter_type",
                   "documentation_complete", "billing_submitted"],
}
CLAIM_EXTRA = ["service_date", "submission_date", "processing_date", "status", "insurance_paid_amount",
               "patient_responsibility", "adjustment_amount"]


def row_rules(as_of: dt.date | str) -> dict[str, list[tuple[str, Column]]]:
    """Per table, the name and predicate of each row-local check. Claims are
    ``claim_line_totals`` rows."""
    return {
        "patient_records": [
            ("incomplete_patients", P.incomplete_patient_condition()), ("invalid_dob", P.invalid_dob_condition(as_of)),
            ("invalid_phone", P.invalid_phone_condition()), ("invalid_email", P.invalid_email_condition()),
            ("stale_patients", P.stale_patient_condition(as_of)), ("missing_field_counts", P.missing_field_condition())],
        "claims": [
            ("claim_line_mismatch", C.claim_line_mismatch_condition()), ("payment_mismatch", C.payment_mismatch_condition()),
            ("submitted_before_service", C.submitted_before_service_condition()),
            ("processed_before_submission", C.processed_before_submission_condition()),
            ("long_pending_claims", C.long_pending_condition(as_of)), ("high_amount_claims", C.high_amount_condition())],
        "providers": [
            ("expired_licenses", V.expired_license_condition(as_of)), ("incomplete_providers", V.incomplete_provider_condition())],
        "encounters": [
            ("incomplete_encounters", E.undocumented_condition(as_of)), ("documented_not_billed", E.unbilled_condition(as_of))],
    }


def _details(as_of: dt.date | str) -> dict[str, tuple[str, callable]]:
    """Each check's table, and its projection of flagged rows."""
    return {
        "incomplete_patients": ("patient_records", P.incomplete_patients),
        "invalid_dob": ("patient_records", lambda d: P.invalid_dob(d, as_of)),
        "invalid_phone": ("patient_records", P.invalid_phone),
        "invalid_email": ("patient_records", P.invalid_email),
        "stale_patients": ("patient_records", lambda d: P.stale_patients(d, as_of)),
        "missing_field_counts": ("patient_records", P.missing_field_counts),
        "claim_line_mismatch": ("claims", C.mismatched_totals),
        "payment_mismatch": ("claims", C.payment_mismatch),
        "submitted_before_service": ("claims", C.submitted_before_service),
        "processed_before_submission": ("claims", C.processed_before_submission),
        "long_pending_claims": ("claims", lambda d: C.long_pending_claims(d, as_of)),
        "high_amount_claims": ("claims", C.high_amount_claims),
        "expired_licenses": ("providers", lambda d: V.expired_licenses(d, as_of)),
        "incomplete_providers": ("providers", V.incomplete_providers),
        "incomplete_encounters": ("encounters", lambda d: E.incomplete_encounters(d, as_of)),
        "documented_not_billed": ("encounters", lambda d: E.documented_not_billed(d, as_of)),
    }


def _namespace(tables) -> SimpleNamespace:
    return SimpleNamespace(**tables) if isinstance(tables, dict) else tables


def flag(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows that break a rule, with the names of all rules they break."""
    broken = [F.coalesce(cond, F.lit(False)) for _, cond in rules]
    names = F.array_compact(F.array(*[F.when(b, F.lit(name)) for (name, _), b in zip(rules, broken)]))
    return df.filter(any_of(broken)).withColumn(FAILED, names)


def flag_tables(tables, as_of: dt.date | str, only: set[str] | None = None, materialize: bool = True) -> dict[str, DataFrame]:
    """The flagged rows of each given table, from one scan of it; ``only``
    restricts the rules. With ``materialize`` they are written once
    (a reliable checkpoint)."""
    t, out = _namespace(tables), {}
    for name, rules in row_rules(as_of).items():
        chosen = [(n, c) for n, c in rules if only is None or n in only]
        if not chosen or not hasattr(t, name):
            continue
        if name == "claims":
            rows = C.claim_line_totals(t.claims, t.claims_line_items, CLAIM_EXTRA)
        else:
            table = getattr(t, name)
            rows = table.select(*[c for c in COLUMNS[name] if c in table.columns])
        out[name] = flag(rows, chosen)
    if materialize:
        for name, df in out.items():
            checkpoint_dir(df.sparkSession)
            out[name] = df.checkpoint(eager=True)
    return out


def flagged_checks(flagged: dict[str, DataFrame], as_of: dt.date | str) -> dict[str, DataFrame]:
    """The detail rows of every row-local check, as its own operator gives them."""
    return {check: project(flagged[table].filter(F.array_contains(FAILED, check)))
            for check, (table, project) in _details(as_of).items() if table in flagged}


# --- counting runs ---------------------------------------------------------------

def _int(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0).cast("bigint")


def _counted(df: DataFrame, measures: dict[str, Column], keyed: dict[str, tuple[Column, list[Column]]]) -> DataFrame:
    """One row: every measure's sum, ``total_records``, and per tag of ``keyed``
    (condition, key columns) the number of distinct keys (``<tag>_keys``), of
    keys held by several rows (``<tag>_repeated``) and of rows under those
    (``<tag>_repeated_rows``). One exchange of partially aggregated rows."""
    width = max(len(keys) for _, keys in keyed.values())

    def row(tag: str, keys: list[Column], on: bool) -> Column:
        values = [c if on else F.lit(0).cast("bigint").cast(t) for c, t in zip(measures.values(), types)]
        filled = [k.cast("string") for k in keys] + [F.lit(None).cast("string")] * (width - len(keys))
        return F.struct(F.lit(tag).alias("tag"), *[k.alias(f"k{i}") for i, k in enumerate(filled)],
                        *[v.alias(n) for n, v in zip(measures, values)])

    types = [f.dataType for f in df.select(*[c.alias(n) for n, c in measures.items()]).schema.fields]
    rows = [row("all", [], True)] + [F.when(cond, row(tag, keys, False)) for tag, (cond, keys) in keyed.items()]
    exploded = df.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
    per_key = exploded.groupBy("tag", *[f"k{i}" for i in range(width)]).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in measures])
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("tag") == "all", F.col("n"))), F.lit(0)).alias("total_records"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
        *[c for tag in keyed for mine in [F.col("tag") == tag] for c in (
            F.count_if(mine).alias(f"{tag}_keys"), F.count_if(mine & (F.col("n") > 1)).alias(f"{tag}_repeated"),
            F.coalesce(F.sum(F.when(mine & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias(f"{tag}_repeated_rows"))])


def tallies(tables, as_of: dt.date | str) -> DataFrame:
    """One row per table and measure (``table_name, measure, value``): the
    counts behind P06, M1, M2 and M3, from one scan of each table."""
    t = _namespace(tables)
    bad_patient = P.invalid_dob_condition(as_of) | P.invalid_phone_condition() | P.invalid_email_condition()
    patients = _counted(
        t.patient_records,
        {"complete": _int(patients_complete()), "incomplete": _int(P.incomplete_patient_condition())},
        {"failing": (bad_patient & F.col("patient_id").isNotNull(), [F.col("patient_id")]),
         "same": (P.duplicate_key_condition(), [F.col("name"), F.col("date_of_birth")])})
    bad_claim = (C.claim_line_mismatch_condition() | C.payment_mismatch_condition()
                 | C.submitted_before_service_condition() | C.processed_before_submission_condition())
    mismatch = C.claim_line_mismatch_condition()
    claims = _counted(
        C.claim_line_totals(t.claims, t.claims_line_items, CLAIM_EXTRA),
        {"complete": _int(F.col("status") == PROCESSED_STATUS), "mismatched": _int(mismatch),
         "temporal": _int(C.temporal_anomaly_condition()),
         "discrepancy": F.when(mismatch, C.line_difference()).otherwise(F.lit(0)).cast("decimal(28,2)")},
        {"failing": (bad_claim & F.col("claim_id").isNotNull(), [F.col("claim_id")])})
    providers = t.providers.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(providers_complete()).alias("complete"),
        F.count_if(V.expired_license_condition(as_of)).alias("expired"))

    def long(name: str, wide: DataFrame) -> DataFrame:
        return wide.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("measure"), F.col(c).cast("decimal(38,2)").alias("value"))
            for c in wide.columns])).alias("r")).select("r.*")

    return long("patient_records", patients).unionByName(long("claims", claims)).unionByName(long("providers", providers))


# Findings of each of the five checks: (check key, table, measure).
FINDING_MEASURES = [
    ("patient_completeness", "patient_records", "incomplete"), ("claims_discrepancies", "claims", "mismatched"),
    ("temporal_anomalies", "claims", "temporal"), ("duplicate_records", "patient_records", "same_repeated"),
    ("provider_credentials", "providers", "expired")]


def _value(table: str, measure: str, kind: str = "bigint") -> Column:
    mine = (F.col("table_name") == table) & (F.col("measure") == measure)
    return F.coalesce(F.sum(F.when(mine, F.col("value"))), F.lit(0)).cast(kind)


def run_counts(counted: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """P06 from ``tallies``: per-check counts (``names``: check key to its
    name) and the summary row."""
    wide = counted.agg(*[_value(t, m).alias(key) for key, t, m in FINDING_MEASURES],
                       _value("claims", "discrepancy", "decimal(38,2)").alias("total_discrepancy"),
                       _value("patient_records", "same_repeated_rows").alias("total_duplicates"))
    counts = wide.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("check_key"), F.lit(names[k]).alias("check_name"), F.col(k).alias("issues_found"))
        for k, _, _ in FINDING_MEASURES])).alias("r")).select("r.*")
    total = sum((F.col(k) for k, _, _ in FINDING_MEASURES), F.lit(0).cast("bigint"))
    summary = wide.select(
        total.alias("total_issues_found"), F.lit(len(FINDING_MEASURES)).cast("bigint").alias("checks_performed"),
        F.when(total > 0, F.lit(R.RUN_STATUS_FAIL)).otherwise(F.lit(R.RUN_STATUS_PASS)).alias("status"),
        "total_discrepancy", "total_duplicates")
    return counts, summary


def _by_table(counted: DataFrame) -> DataFrame:
    """Per table: total, complete, failing and findings."""
    def of(measure: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col("value"))), F.lit(0)).cast("bigint")

    mine = F.lit(False)
    for _, table, measure in FINDING_MEASURES:
        mine = mine | ((F.col("table_name") == table) & (F.col("measure") == measure))
    return counted.groupBy("table_name").agg(
        of("total_records").alias("total_records"), of("complete").alias("complete_records"),
        of("failing_keys").alias("failing_records"),
        F.coalesce(F.sum(F.when(mine, F.col("value"))), F.lit(0)).cast("bigint").alias("findings"))


def _per_1000(findings: str, records: str) -> Column:
    return F.round(F.try_divide(F.col(findings).cast("double") * 1000, F.col(records).cast("double")), 2)


def error_rates(counted: DataFrame) -> DataFrame:
    """M3 from ``tallies``."""
    return _by_table(counted).select("table_name", "findings", "total_records", _per_1000("findings", "total_records").alias("error_rate"))


def rate_values(counted: DataFrame) -> DataFrame:
    """M1, M2 and M3 as ``metric_name, value, category, notes``, in one pass of
    ``tallies``. The accuracy rules cover patients and claims."""
    ruled = F.col("table_name").isin("patient_records", "claims")
    rows = [
        F.struct(F.lit("completeness_rate").alias("metric_name"), pct(F.col("complete_records"), F.col("total_records")).alias("value"),
                 F.lit("completeness").alias("category")),
        F.when(ruled, F.struct(F.lit("accuracy_rate").alias("metric_name"),
                               pct(F.col("total_records") - F.col("failing_records"), F.col("total_records")).alias("value"),
                               F.lit("accuracy").alias("category"))),
        F.struct(F.lit("error_rate_per_1000").alias("metric_name"), _per_1000("findings", "total_records").alias("value"),
                 F.lit("error_rate").alias("category")),
    ]
    return _by_table(counted).select(F.explode(F.array_compact(F.array(*rows))).alias("r"), F.col("table_name").alias("notes")).select("r.*", "notes")
