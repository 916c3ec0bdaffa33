"""Checks over ``claims`` and ``claims_line_items``.

Amounts stay DECIMAL(10,2) end to end: the tolerance tests sit exactly on a
cent boundary (a difference of 0.01 is *not* reported), which floating point
would blur.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import date_lit, days_between, money
from .core import DuplicateGroups, before, duplicates, orphans


def line_totals(lines: DataFrame) -> DataFrame:
    """Per-claim line sum and count. Partially aggregated map-side, so a hot
    claim id (or the NULL id) costs one row per map task before the shuffle."""
    return lines.groupBy("claim_id").agg(
        F.sum("line_item_amount").alias("_line_sum"),
        F.count("line_item_id").alias("_line_count"),
    )


def claim_line_totals(claims: DataFrame, lines: DataFrame, extra_cols: list[str] | None = None) -> DataFrame:
    """Claims left-joined to their pre-aggregated line totals.

    The reference joins first and groups on six claim columns afterwards;
    since ``claim_id`` is the claims key (check it with
    ``check_primary_key`` on untrusted input) aggregating the lines first is
    the same result and shuffles one row per claim instead of one per line.
    """
    cols = ["claim_id", "patient_id", "provider_id", "claim_total_amount"] + (extra_cols or [])
    totals = line_totals(lines)
    joined = claims.select(*cols).join(totals, "claim_id", "left")
    return joined.select(
        *cols,
        F.coalesce(F.col("_line_sum"), money(0)).alias("calculated_total"),
        F.coalesce(F.col("_line_count"), F.lit(0).cast("bigint")).alias("line_item_count"),
    )


def _discrepancy_pct(diff, total):
    return F.round(diff / F.nullif(total, money(0)) * 100, 2)


def claim_line_mismatch(claims: DataFrame, lines: DataFrame, tolerance=R.AMOUNT_TOLERANCE,
                        sort: bool = False, with_service_columns: bool = True,
                        with_issue_type: bool = True) -> DataFrame:
    """Claims whose line items do not add up to the claim total.

    A claim with no lines has a calculated total of 0 and a count of 0; a
    difference strictly above ``tolerance`` is reported; the percentage is
    of the claim total, NULL when that total is 0; a NULL total is never
    reported. ``sort=True`` orders by the
    largest discrepancy first (the reference's ORDER BY).
    """
    extra = ["service_date", "status"] if with_service_columns else []
    return mismatched_totals(claim_line_totals(claims, lines, extra), tolerance, sort, with_service_columns, with_issue_type)


def mismatched_totals(t: DataFrame, tolerance=R.AMOUNT_TOLERANCE, sort: bool = False, with_service_columns: bool = True,
                      with_issue_type: bool = True) -> DataFrame:
    """C06 over ``claim_line_totals`` rows."""
    extra = ["service_date", "status"] if with_service_columns else []
    diff = line_difference()
    out_cols = ["claim_id", "patient_id", "provider_id"] + extra + [
        "claim_total_amount", "calculated_total", "line_item_count",
        diff.alias("discrepancy_amount"),
        _discrepancy_pct(diff, F.col("claim_total_amount")).alias("discrepancy_percentage"),
    ]
    if with_issue_type:
        out_cols.append(F.lit(R.ISSUE_CLAIM_MISMATCH).alias("issue_type"))
    out = t.filter(claim_line_mismatch_condition(tolerance)).select(*out_cols)
    return out.orderBy(F.col("discrepancy_amount").desc()) if sort else out


def line_difference():
    """The amount C06 compares, over ``claim_line_totals`` rows."""
    return F.abs(F.col("claim_total_amount") - F.col("calculated_total"))


def claim_line_mismatch_condition(tolerance=R.AMOUNT_TOLERANCE):
    """Row predicate of C06 over ``claim_line_totals`` rows."""
    return line_difference() > money(tolerance)


def _parts():
    return (
        F.coalesce(F.col("insurance_paid_amount"), money(0))
        + F.coalesce(F.col("patient_responsibility"), money(0))
        + F.coalesce(F.col("adjustment_amount"), money(0))
    )


def payment_mismatch_condition(statuses=R.PAID_STATUSES, tolerance=R.AMOUNT_TOLERANCE):
    """Row predicate of C07."""
    return F.col("status").isin(*statuses) & (F.abs(F.col("claim_total_amount") - _parts()) > money(tolerance))


def submitted_before_service_condition():
    """Row predicate of C08."""
    return F.col("submission_date") < F.col("service_date")


def processed_before_submission_condition():
    """Row predicate of C09."""
    p = F.col("processing_date")
    return p.isNotNull() & (p < F.col("submission_date"))


def payment_mismatch(claims: DataFrame, statuses=R.PAID_STATUSES, tolerance=R.AMOUNT_TOLERANCE) -> DataFrame:
    """Processed or paid claims whose total differs from insurer +
    patient + adjustment parts (a missing part counts as 0)."""
    parts = _parts()
    diff = F.abs(F.col("claim_total_amount") - parts)
    return claims.filter(payment_mismatch_condition(statuses, tolerance)).select(
        "claim_id", "patient_id", "provider_id", "claim_total_amount", "insurance_paid_amount",
        "patient_responsibility", "adjustment_amount", parts.alias("sum_of_parts"),
        diff.alias("difference"), F.lit(R.ISSUE_PAYMENT_MISMATCH).alias("issue_type"),
    )


def submitted_before_service(claims: DataFrame) -> DataFrame:
    """Submission dated before the service (negative day difference)."""
    return claims.filter(submitted_before_service_condition()).select(
        "claim_id", "patient_id", "service_date", "submission_date",
        days_between(F.col("submission_date"), F.col("service_date")).alias("days_difference"),
        F.lit(R.ISSUE_SUBMISSION_BEFORE_SERVICE).alias("issue_type"),
    )


def processed_before_submission(claims: DataFrame) -> DataFrame:
    """Processing dated before submission."""
    return claims.filter(processed_before_submission_condition()).select(
        "claim_id", "patient_id", "submission_date", "processing_date",
        F.lit(R.ISSUE_PROCESSING_BEFORE_SUBMISSION).alias("issue_type"),
    )


def temporal_anomaly_condition():
    """Row predicate of P03: C08 or C09."""
    return submitted_before_service_condition() | processed_before_submission_condition()


def anomaly_type():
    """P03's label; the submission test wins when both hold."""
    sub, proc = F.col("submission_date"), F.col("processing_date")
    return (F.when(submitted_before_service_condition(), F.lit(R.ANOMALY_SUBMISSION_BEFORE_SERVICE))
            .when(proc < sub, F.lit(R.ANOMALY_PROCESSING_BEFORE_SUBMISSION)))


def temporal_anomalies(claims: DataFrame) -> DataFrame:
    """P03 core: C08 and C09 in one pass, one row per claim."""
    return claims.filter(temporal_anomaly_condition()).select(
        "claim_id", "patient_id", "service_date", "submission_date", "processing_date",
        anomaly_type().alias("anomaly_type"),
    )


def long_pending_condition(as_of: dt.date | str | None = None, days: int = R.PENDING_DAYS, statuses=R.OPEN_STATUSES):
    """Row predicate of C10."""
    return F.col("status").isin(*statuses) & before("submission_date", as_of, days)


def high_amount_condition(threshold=R.HIGH_AMOUNT_THRESHOLD):
    """Row predicate of C17."""
    return F.col("claim_total_amount") > money(threshold)


def long_pending_claims(claims: DataFrame, as_of: dt.date | str | None = None, days: int = R.PENDING_DAYS,
                        statuses=R.OPEN_STATUSES, sort: bool = False) -> DataFrame:
    """Open claims submitted more than ``days`` days before ``as_of``;
    ``sort=True``: oldest first."""
    out = claims.filter(long_pending_condition(as_of, days, statuses)).select(
        "claim_id", "patient_id", "provider_id", "submission_date", "status",
        days_between(date_lit(as_of), F.col("submission_date")).alias("days_pending"),
        F.lit(R.ISSUE_LONG_PENDING).alias("issue_type"),
    )
    return out.orderBy("submission_date") if sort else out


# What makes two claims the same.
DUPLICATE_CLAIM_KEYS = ["patient_id", "provider_id", "service_date", "claim_total_amount"]


def duplicate_claim_groups(claims: DataFrame) -> DuplicateGroups:
    return duplicates(claims, DUPLICATE_CLAIM_KEYS, "claim_id")


def duplicate_claims(claims: DataFrame) -> DataFrame:
    """C14: claims equal on patient, provider, service date and amount, one row
    per claim, numbered within their group; NULL keys group together."""
    return duplicate_claim_groups(claims).members().select(
        "patient_id", "provider_id", "service_date", "claim_total_amount", "duplicate_count",
        "first_id", "member_no", "claim_id", F.lit(R.ISSUE_DUPLICATE_CLAIM).alias("issue_type"),
    )


def orphan_claims_patient(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Claims whose patient does not exist, a NULL patient included."""
    return orphans(claims.select("claim_id", "patient_id", "service_date"), patients, "patient_id").select(
        "claim_id", "patient_id", "service_date", F.lit(R.ISSUE_ORPHAN_PATIENT).alias("issue_type"),
    )


def orphan_claims_provider(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims whose provider does not exist, a NULL provider included."""
    return orphans(claims.select("claim_id", "provider_id", "service_date"), providers, "provider_id").select(
        "claim_id", "provider_id", "service_date", F.lit(R.ISSUE_ORPHAN_PROVIDER).alias("issue_type"),
    )


def high_amount_claims(claims: DataFrame, threshold=R.HIGH_AMOUNT_THRESHOLD, sort: bool = False) -> DataFrame:
    """C17: claim totals strictly above ``threshold``; ``sort=True``: largest first."""
    out = claims.filter(high_amount_condition(threshold)).select(
        "claim_id", "patient_id", "provider_id", "service_date", "claim_total_amount",
        F.lit(R.ISSUE_HIGH_AMOUNT).alias("issue_type"),
    )
    return out.orderBy(F.col("claim_total_amount").desc()) if sort else out


def frequent_claimants(claims: DataFrame, patients: DataFrame, as_of: dt.date | str | None = None,
                       window_months: int = R.FREQUENCY_WINDOW_MONTHS,
                       min_count: int = R.FREQUENCY_MIN_COUNT, sort: bool = False) -> DataFrame:
    """Patients with more than ``min_count`` claims serviced since
    ``as_of`` minus the window (no upper bound). Claims are counted per
    patient before the join (partial aggregation absorbs a hot patient); the
    inner join then drops orphan and NULL patients."""
    since = F.add_months(date_lit(as_of), -window_months)
    counts = (
        claims.filter(F.col("service_date") >= since)
        .groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.min("service_date").alias("first_claim_date"),
            F.max("service_date").alias("last_claim_date"),
        )
        .filter(F.col("claim_count") > min_count)
    )
    p = patients.select("patient_id", "name", "date_of_birth")
    out = counts.join(p, "patient_id", "inner").select(
        "patient_id", "name", "date_of_birth", "claim_count", "first_claim_date", "last_claim_date",
        F.lit(R.ISSUE_HIGH_FREQUENCY).alias("issue_type"),
    )
    return out.orderBy(F.col("claim_count").desc()) if sort else out


def claim_discrepancies_inner(claims: DataFrame, lines: DataFrame, tolerance=R.AMOUNT_TOLERANCE,
                              sort: bool = False) -> DataFrame:
    """R2: the reference's documented variant of C06 with an inner join: claims without any
    line are not reported; the percentage is NULL for a zero total."""
    totals = lines.groupBy("claim_id").agg(F.sum("line_item_amount").alias("calculated_total"))
    t = claims.select("claim_id", "claim_total_amount").join(totals, "claim_id", "inner")
    diff = F.abs(F.col("calculated_total") - F.col("claim_total_amount"))
    out = t.filter(diff > money(tolerance)).select(
        "claim_id", "calculated_total", "claim_total_amount", diff.alias("discrepancy"),
        _discrepancy_pct(diff, F.col("claim_total_amount")).alias("discrepancy_pct"),
    )
    return out.orderBy(F.col("discrepancy").desc()) if sort else out
