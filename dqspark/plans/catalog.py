"""Named queries over a test-data directory: one per implemented operator.

Each entry takes ``(spark, sf_dir)``, derives the healthcare tables from the
Parquet sources there and applies one operator with the fixture reference
date. ``__spark_entry__`` exposes these through the contract projection.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import ts_lit
from ..operators import claims as C
from ..operators import constraints as K
from ..operators import encounters as E
from ..operators import findings as FND
from ..operators import metrics as MT
from ..operators import partials as D
from ..operators import patients as P
from ..operators import providers as V
from ..operators import resolution as H
from ..operators.key_counts import add_batch
from ..operators.updates import BUCKET, apply_updates, store_by_key, update_stored
from ..session import new_folder
from ..sources.fixtures import FIXTURE_AS_OF, load_fixtures
from ..sources.intake import take_in
from ..sources.readers import conform
from ..sources.schemas import AUDIT_STATUSES, CLAIM_STATUSES, PATIENT_RECORDS, SEVERITIES
from . import fused
from .checker import count_checks, run_all_checks
from .registry import investigate
from .sinks import csv_ready, json_records, report_preview

AS_OF = dt.date.fromisoformat(FIXTURE_AS_OF)

RUN_TS = dt.datetime.combine(AS_OF, dt.time())

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_fixtures(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


CHECK_QUERIES: dict[str, Query] = {
    "patient_completeness_summary": _q(lambda t: P.patient_completeness_summary(t.patient_records)),
    "incomplete_patients": _q(lambda t: P.incomplete_patients(t.patient_records)),
    "invalid_dob": _q(lambda t: P.invalid_dob(t.patient_records, AS_OF)),
    "invalid_phone": _q(lambda t: P.invalid_phone(t.patient_records)),
    "invalid_email": _q(lambda t: P.invalid_email(t.patient_records)),
    "claim_line_mismatch": _q(lambda t: C.claim_line_mismatch(t.claims, t.claims_line_items)),
    "payment_mismatch": _q(lambda t: C.payment_mismatch(t.claims)),
    "submitted_before_service": _q(lambda t: C.submitted_before_service(t.claims)),
    "processed_before_submission": _q(lambda t: C.processed_before_submission(t.claims)),
    "long_pending_claims": _q(lambda t: C.long_pending_claims(t.claims, AS_OF)),
    "expired_licenses": _q(lambda t: V.expired_licenses(t.providers, AS_OF)),
    "incomplete_providers": _q(lambda t: V.incomplete_providers(t.providers)),
    "duplicate_patients": _q(lambda t: P.duplicate_patients(t.patient_records)),
    "duplicate_claims": _q(lambda t: C.duplicate_claims(t.claims)),
    "duplicate_patient_groups": _q(lambda t: P.duplicate_patient_groups(t.patient_records).groups),
    "duplicate_claim_groups": _q(lambda t: C.duplicate_claim_groups(t.claims).groups),
    "orphan_claims_patient": _q(lambda t: C.orphan_claims_patient(t.claims, t.patient_records)),
    "orphan_claims_provider": _q(lambda t: C.orphan_claims_provider(t.claims, t.providers)),
    "high_amount_claims": _q(lambda t: C.high_amount_claims(t.claims)),
    "frequent_claimants": _q(lambda t: C.frequent_claimants(t.claims, t.patient_records, AS_OF)),
    "stale_patients": _q(lambda t: P.stale_patients(t.patient_records, AS_OF)),
    "incomplete_encounters": _q(lambda t: E.incomplete_encounters(t.encounters, AS_OF)),
    "documented_not_billed": _q(lambda t: E.documented_not_billed(t.encounters, AS_OF)),
    "missing_field_counts": _q(lambda t: P.missing_field_counts(t.patient_records)),
    "claim_discrepancies_inner": _q(lambda t: C.claim_discrepancies_inner(t.claims, t.claims_line_items)),
}


# --- The checker (P01–P06) and its audit rows (W1) --------------------------


AUDIT_CONTRACT_COLUMNS = [
    "audit_id", "check_timestamp", "check_type", "table_name", "record_id", "issue_type",
    "issue_description", "severity", "status", "assigned_to", "resolution_notes", "resolved_at",
]

CHECKER_QUERIES: dict[str, Query] = {
    "checker_patient_completeness": _q(lambda t: FND.check_patient_completeness(t.patient_records).details),
    "checker_claims_discrepancies": _q(
        lambda t: FND.check_claims_discrepancies(t.claims, t.claims_line_items).details),
    "checker_temporal_anomalies": _q(lambda t: FND.check_temporal_anomalies(t.claims).details),
    "checker_duplicate_records": _q(lambda t: FND.duplicate_record_lists(t.patient_records)),
    "checker_provider_credentials": _q(lambda t: FND.check_provider_credentials(t.providers, AS_OF).details),
    # run_id is a label; the comparison covers every other audit column.
    "audit_issues": _q(lambda t: run_all_checks(t, AS_OF, materialize=True).audit.select(*AUDIT_CONTRACT_COLUMNS)),
    "run_check_counts": _q(lambda t: count_checks(t, AS_OF)[0]),
    "run_summary": _q(lambda t: count_checks(t, AS_OF)[1].select(ts_lit(AS_OF).alias("run_timestamp"), "*")),
}


# --- Declared constraints (K1–K7) -------------------------------------------


CONSTRAINT_QUERIES: dict[str, Query] = {
    "pk_claims_line_items": _q(lambda t: K.check_primary_key(t.claims_line_items, "line_item_id")),
    "pk_claims": _q(lambda t: K.check_primary_key(t.claims, "claim_id")),
    "not_null_providers": _q(lambda t: K.check_not_null(t.providers, ["provider_name"], "provider_id")),
    "unique_provider_npi": _q(lambda t: K.check_unique(t.providers, "npi_number")),
    "fk_claims_patient": _q(
        lambda t: K.check_foreign_key(t.claims, t.patient_records, "patient_id", None, "claim_id")),
    "fk_claims_provider": _q(
        lambda t: K.check_foreign_key(t.claims, t.providers, "provider_id", None, "claim_id")),
    "fk_line_items_claim": _q(
        lambda t: K.check_foreign_key(t.claims_line_items, t.claims, "claim_id", None, "line_item_id")),
    "fk_encounters_patient": _q(
        lambda t: K.check_foreign_key(t.encounters, t.patient_records, "patient_id", None, "encounter_id")),
    "domain_claims_status": _q(lambda t: K.check_domain(t.claims, "status", CLAIM_STATUSES, "claim_id")),
    "domain_audit_severity": _q(lambda t: K.check_domain(t.quality_audit_log, "severity", SEVERITIES, "audit_id")),
    "domain_audit_status": _q(lambda t: K.check_domain(t.quality_audit_log, "status", AUDIT_STATUSES, "audit_id")),
    "max_length_patient_records": _q(
        lambda t: K.check_max_length(t.patient_records, PATIENT_RECORDS.max_lengths, "patient_id")),
    "decimal_range_line_totals": _q(
        lambda t: K.check_decimal_range(
            t.claims_line_items.groupBy("claim_id").agg(F.sum("line_item_amount").alias("calculated_total")),
            ["calculated_total"], 10, 2, "claim_id")),
    "table_violations_claims": _q(
        lambda t: K.check_table(t.claims, "claims",
                                {"patient_records": t.patient_records, "providers": t.providers})),
    "table_violations_providers": _q(lambda t: K.check_table(t.providers, "providers")),
    "table_violations_claims_line_items": _q(
        lambda t: K.check_table(t.claims_line_items, "claims_line_items", {"claims": t.claims})),
    # Over rows as they arrive, before they are typed.
    "pk_raw_claims": _q(lambda t: K.check_primary_key(t.raw_claims, "claim_id")),
    "not_null_raw_claims": _q(lambda t: K.check_not_null(t.raw_claims, ["service_date", "submission_date"], "claim_id")),
    "not_null_claims_line_items": _q(lambda t: K.check_not_null(t.claims_line_items, ["procedure_code"], "line_item_id")),
    "not_null_raw_encounters": _q(lambda t: K.check_not_null(t.raw_encounters, ["encounter_date"], "encounter_id")),
    "fk_raw_encounters_patient": _q(
        lambda t: K.check_foreign_key(t.raw_encounters, t.patient_records, "patient_id", None, "encounter_id")),
    "domain_raw_audit_status": _q(lambda t: K.check_domain(t.raw_audit_log, "status", AUDIT_STATUSES, "audit_id")),
    "decimal_range_raw_claims": _q(lambda t: K.check_decimal_range(
        t.raw_claims.select("claim_id", F.col("claim_total_amount").try_cast("decimal(38,10)").alias("claim_total_amount")),
        ["claim_total_amount"], 10, 2, "claim_id")),
    "table_violations_raw_encounters": _q(
        lambda t: K.check_table(t.raw_encounters, "encounters", {"patient_records": t.patient_records})),
    "accepted_claims": _q(lambda t: take_in(t.raw_claims, "claims", now=RUN_TS).accepted),
    "rejected_claims": _q(lambda t: take_in(t.raw_claims, "claims", now=RUN_TS).rejected),
    "rejected_claim_violations": _q(lambda t: take_in(t.raw_claims, "claims", now=RUN_TS).violations),
    "rejected_encounters": _q(lambda t: take_in(t.raw_encounters, "encounters", now=RUN_TS).rejected),
    "table_violations_encounters": _q(
        lambda t: K.check_table(t.encounters, "encounters",
                                {"patient_records": t.patient_records, "providers": t.providers})),
}


# --- Metrics (R3, M1–M6) ----------------------------------------------------


def _log_by_days(t):
    """Partials of the log's even and odd days, added up."""
    even = F.dayofmonth("check_timestamp") % 2 == 0
    return D.merge(*[D.log_partials(t.quality_audit_log.filter(c)) for c in (even, ~even)])


METRIC_QUERIES: dict[str, Query] = {
    "weekly_trend_from_partials": _q(lambda t: D.weekly_trend(_log_by_days(t))),
    "resolution_times_from_partials": _q(lambda t: D.resolution_times(_log_by_days(t))),
    "completeness_from_partials": _q(lambda t: D.completeness_rates(
        D.merge(D.record_partials(t.patient_records, t.claims, t.providers)))),
    "quality_metrics": _q(lambda t: MT.quality_metrics(t.patient_records, t.claims, AS_OF)),
    "completeness_rates": _q(lambda t: MT.completeness_rates(t.patient_records, t.claims, t.providers)),
    "accuracy_rates": _q(lambda t: MT.accuracy_rates(t.patient_records, t.claims, t.claims_line_items, AS_OF)),
    "error_rates": _q(lambda t: fused.error_rates(fused.tallies(t, AS_OF))),
    "resolution_times": _q(lambda t: MT.resolution_times(t.quality_audit_log)),
    "weekly_error_trend": _q(lambda t: MT.weekly_error_trend(t.quality_audit_log)),
    "quality_metric_rows": _q(lambda t: MT.metric_rows(
        AS_OF, rates=fused.rate_values(fused.tallies(t, AS_OF)),
        resolution=MT.resolution_times(t.quality_audit_log), trend=MT.weekly_error_trend(t.quality_audit_log))),
}


# --- Table maintenance, report and look-up (W2, W3, P07, R4) ----------------


UPDATE_TS = dt.datetime.combine(AS_OF, dt.time(12))


def _processed_pending(t):
    """W3 over the whole claims table: every PENDING claim is processed on
    the reference date; the trigger stamps the updated rows."""
    base = conform(t.claims, "claims", now=RUN_TS)
    updates = t.claims.filter(F.col("status") == "PENDING").select(
        "claim_id", F.lit("PROCESSED").alias("status"), F.lit(AS_OF).alias("processing_date"))
    return apply_updates(base, updates, "claim_id", now=UPDATE_TS)


def _findings(t):
    """The log's findings as they were written: open, unassigned."""
    return conform(t.quality_audit_log.drop("status", "resolved_at"), "quality_audit_log", now=RUN_TS)


KEY_BUCKETS = 16


def _stored_update(t):
    """W3 on a stored table, folder by folder, read back."""
    spark, path = t.claims.sparkSession, new_folder(t.claims.sparkSession, "claims")
    store_by_key(conform(t.claims, "claims", now=RUN_TS), path, "claim_id", KEY_BUCKETS)
    updates = t.claims.filter(F.col("status") == "PENDING").select(
        "claim_id", F.lit("PROCESSED").alias("status"), F.lit(AS_OF).alias("processing_date"))
    update_stored(spark, path, updates, "claim_id", KEY_BUCKETS, now=UPDATE_TS, table="claims")
    return spark.read.parquet(path).drop(BUCKET)


def _arrivals(t):
    """C14 as claims arrive in three batches: the keys that repeat from each on."""
    spark, path, out = t.claims.sparkSession, new_folder(t.claims.sparkSession, "key-counts"), None
    for b in range(3):
        arrived = t.claims.filter(F.dayofmonth("submission_date") % 3 == b)
        new = add_batch(spark, path, arrived, b, C.DUPLICATE_CLAIM_KEYS, "claim_id").withColumn("batch_id", F.lit(b))
        out = new if out is None else out.unionByName(new)
    return out


MAINTENANCE_QUERIES: dict[str, Query] = {
    "claims_after_stored_update": _q(_stored_update),
    "newly_repeated_claims": _q(_arrivals),
    "audit_log_current": _q(lambda t: H.current_log(_findings(t), t.audit_events)),
    "audit_status_timeline": _q(lambda t: H.status_timeline(_findings(t), t.audit_events)),
    "time_in_status": _q(lambda t: H.time_in_status(H.status_timeline(_findings(t), t.audit_events))),
    "resolution_times_from_events": _q(lambda t: MT.resolution_times(H.current_log(_findings(t), t.audit_events))),
    "conformed_claims": _q(lambda t: conform(t.claims, "claims", now=RUN_TS)),
    "conformed_encounters": _q(lambda t: conform(t.encounters, "encounters", now=RUN_TS)),
    "claims_after_processing": _q(_processed_pending),
    "report_preview": _q(lambda t: report_preview(run_all_checks(t, AS_OF, materialize=True))),
    "investigate_claims_billing_validation": _q(lambda t: investigate(t, "claims", "billing_validation", AS_OF)),
    # As ``export_csv`` writes them: arrays joined to text.
    "investigate_patient_records_completeness_csv": _q(
        lambda t: csv_ready(investigate(t, "patient_records", "completeness", AS_OF))),
    "investigate_providers_completeness_csv": _q(lambda t: csv_ready(investigate(t, "providers", "completeness", AS_OF))),
    "investigate_encounters_billing": _q(lambda t: investigate(t, "encounters", "billing", AS_OF)),
    # As ``export_json`` writes them: one record per finding.
    "json_patient_completeness": _q(lambda t: json_records(FND.check_patient_completeness(t.patient_records).details)),
    "json_claims_discrepancies": _q(lambda t: json_records(FND.check_claims_discrepancies(t.claims, t.claims_line_items).details)),
    "json_temporal_anomalies": _q(lambda t: json_records(FND.check_temporal_anomalies(t.claims).details)),
    "json_duplicate_records": _q(lambda t: json_records(FND.check_duplicate_records(t.patient_records).details)),
    "json_provider_credentials": _q(lambda t: json_records(FND.check_provider_credentials(t.providers, AS_OF).details)),
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (CHECK_QUERIES, CHECKER_QUERIES, CONSTRAINT_QUERIES, METRIC_QUERIES, MAINTENANCE_QUERIES):
        out.update(group)
    return out
