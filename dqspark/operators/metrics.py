"""Quality metrics.

Every metric is a global or per-key aggregate: partial aggregation on each
task, a small final merge, no data-sized state on the driver. Percentages
use ``pct`` (NULL instead of a division error on an empty table).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import all_of, as_timestamp, date_lit, pct, ts_lit
from . import claims as C
from . import patients as P
from .numbering import ordered

# The data_type labels of the reference's metrics query.
PATIENT_DATA_TYPE = "Patient Records"
CLAIMS_DATA_TYPE = "Claims"
PROCESSED_STATUS = "PROCESSED"


def patients_complete():
    return all_of([F.col(f).isNotNull() for f in R.PATIENT_REQUIRED_FIELDS])


def providers_complete():
    return all_of([F.col(f).isNotNull() for f in R.PROVIDER_REQUIRED_FIELDS])


def quality_metrics(patients: DataFrame, claims: DataFrame, as_of: dt.date | str | None = None, days: int = R.RECENT_DAYS) -> DataFrame:
    """The reference's documented two-row metrics table.

    Patients are complete with the four required fields and recent when
    created within ``days`` days of ``as_of``; claims are complete when
    PROCESSED and recent by submission date. No active filter.
    """
    since = F.date_sub(date_lit(as_of), days)
    p = patients.agg(
        F.lit(PATIENT_DATA_TYPE).alias("data_type"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(patients_complete()).alias("complete_records"),
        F.count_if(F.col("created_at") >= since.cast("timestamp_ntz")).alias("recent_records"),
    )
    c = claims.agg(
        F.lit(CLAIMS_DATA_TYPE).alias("data_type"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("status") == PROCESSED_STATUS).alias("complete_records"),
        F.count_if(F.col("submission_date") >= since).alias("recent_records"),
    )
    return p.unionByName(c).select(
        "data_type", "total_records", "complete_records",
        pct(F.col("complete_records"), F.col("total_records")).alias("completeness_pct"),
        "recent_records",
        pct(F.col("recent_records"), F.col("total_records")).alias("recency_pct"),
    )


def completeness_rates(patients: DataFrame, claims: DataFrame, providers: DataFrame) -> DataFrame:
    """M1: share of records with all required fields, per table (patients:
    the four required fields; providers: the four credential fields; claims:
    the reference's documented rule, status PROCESSED)."""
    def rate(df, table, cond):
        return df.agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(cond).alias("complete_records"),
        )
    out = (
        rate(patients, "patient_records", patients_complete())
        .unionByName(rate(claims, "claims", F.col("status") == PROCESSED_STATUS))
        .unionByName(rate(providers, "providers", providers_complete()))
    )
    return out.withColumn("completeness_rate", pct(F.col("complete_records"), F.col("total_records")))


def accuracy_rates(patients: DataFrame, claims: DataFrame, lines: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """M2: share of records passing the validation rules, per table:
    patients by C03–C05, claims by C06–C09.

    One pass per table: the rules' row predicates are OR-ed and the failing
    ids counted distinct (a record failing several rules counts once), so
    the table is scanned once instead of once per rule. Claims are read
    joined to their pre-aggregated line totals, which C06 needs.
    """
    bad_patient = (P.invalid_dob_condition(as_of) | P.invalid_phone_condition()
                   | P.invalid_email_condition())
    p = patients.agg(
        F.lit("patient_records").alias("table_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.when(bad_patient, F.col("patient_id"))).alias("failing_records"),
    )
    cols = ["service_date", "submission_date", "processing_date", "status",
            "insurance_paid_amount", "patient_responsibility", "adjustment_amount"]
    bad_claim = (C.claim_line_mismatch_condition() | C.payment_mismatch_condition()
                 | C.submitted_before_service_condition() | C.processed_before_submission_condition())
    c = C.claim_line_totals(claims, lines, cols).agg(
        F.lit("claims").alias("table_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.when(bad_claim, F.col("claim_id"))).alias("failing_records"),
    )
    return p.unionByName(c).withColumn(
        "accuracy_rate", pct(F.col("total_records") - F.col("failing_records"), F.col("total_records"))
    )


def error_rates(audit: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """M3: findings per 1000 records, per table, from audit rows."""
    findings = audit.groupBy("table_name").agg(F.count(F.lit(1)).alias("findings"))
    totals = None
    for name, df in tables.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_records"))
        totals = part if totals is None else totals.unionByName(part)
    out = totals.join(findings, "table_name", "left").select(
        "table_name", F.coalesce(F.col("findings"), F.lit(0).cast("bigint")).alias("findings"), "total_records",
    )
    return out.withColumn(
        "error_rate",
        F.round(F.try_divide(F.col("findings").cast("double") * 1000, F.col("total_records").cast("double")), 2),
    )


def resolution_times(audit_log: DataFrame) -> DataFrame:
    """M4: mean hours from check to resolution over RESOLVED audit rows,
    per check type."""
    hours = F.timestamp_diff("SECOND", F.col("check_timestamp"), F.col("resolved_at")) / 3600.0
    return (
        audit_log.filter((F.col("status") == "RESOLVED") & F.col("resolved_at").isNotNull())
        .groupBy("check_type")
        .agg(F.count(F.lit(1)).alias("resolved_count"), F.round(F.avg(hours), 2).alias("avg_resolution_hours"))
    )


def weekly_error_trend(audit_log: DataFrame) -> DataFrame:
    """M5: findings per week (weeks start on Monday) and issue type."""
    week = F.to_date(F.date_trunc("week", F.col("check_timestamp")))
    return audit_log.groupBy(week.alias("week_start"), "issue_type").agg(F.count(F.lit(1)).alias("findings"))


# A weekly count may pass the ten digits the declared schema gives a metric.
METRIC_TYPE = "decimal(20,2)"
METRIC_ORDER = ["metric_name", "notes", "category"]


def metric_rows(as_of: dt.date | str, run_ts: dt.datetime | str | None = None,
                completeness: DataFrame | None = None, accuracy: DataFrame | None = None,
                errors: DataFrame | None = None, resolution: DataFrame | None = None,
                trend: DataFrame | None = None, targets: dict[str, float] | None = None,
                rates: DataFrame | None = None, last_id: int = 0) -> DataFrame:
    """M6: M1–M5 as ``quality_metrics`` rows.

    ``metric_name`` names the measure, ``notes`` the table, check type or
    week/issue it is about; ``target_value`` comes from ``targets`` keyed by
    metric name (NULL when absent: the reference defines no targets). ``rates``
    holds such values already (``metric_name, value, category, notes``), as
    one pass of the fused run gives them. ``metric_id`` is the serial after
    ``last_id``, in ``METRIC_ORDER``; the rows are written once to fix it.
    """
    ts = as_timestamp(run_ts if run_ts is not None else as_of)
    parts = [] if rates is None else [rates.select("metric_name", "value", "category", "notes")]
    if completeness is not None:
        parts.append(completeness.select(F.lit("completeness_rate").alias("metric_name"),
                                         F.col("completeness_rate").alias("value"),
                                         F.lit("completeness").alias("category"), F.col("table_name").alias("notes")))
    if accuracy is not None:
        parts.append(accuracy.select(F.lit("accuracy_rate").alias("metric_name"), F.col("accuracy_rate").alias("value"),
                                     F.lit("accuracy").alias("category"), F.col("table_name").alias("notes")))
    if errors is not None:
        parts.append(errors.select(F.lit("error_rate_per_1000").alias("metric_name"), F.col("error_rate").alias("value"),
                                   F.lit("error_rate").alias("category"), F.col("table_name").alias("notes")))
    if resolution is not None:
        parts.append(resolution.select(F.lit("avg_resolution_hours").alias("metric_name"),
                                       F.col("avg_resolution_hours").alias("value"),
                                       F.lit("resolution_time").alias("category"), F.col("check_type").alias("notes")))
    if trend is not None:
        parts.append(trend.select(
            F.lit("weekly_findings").alias("metric_name"), F.col("findings").cast("double").alias("value"),
            F.lit("trend").alias("category"),
            F.concat(F.col("week_start").cast("string"), F.lit(" "), F.col("issue_type")).alias("notes")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    target = F.lit(None).cast(METRIC_TYPE)
    for name, value in (targets or {}).items():
        target = F.when(F.col("metric_name") == name, F.lit(value).cast(METRIC_TYPE)).otherwise(target)
    day = date_lit(as_of)
    return ordered(out, METRIC_ORDER, "metric_id", last_id + 1).select(
        "metric_id",
        day.alias("metric_date"),
        "metric_name",
        F.col("value").cast(METRIC_TYPE).alias("metric_value"),
        target.alias("target_value"),
        "category",
        "notes",
        ts_lit(ts).alias("created_at"),
    )
