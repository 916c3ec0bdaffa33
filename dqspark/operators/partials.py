"""Metrics from additive daily partials (M1, M4, M5, M6).

A day's findings and records are reduced once to a few sums. Sums of any
split of the days, added up, give the same rates, hours and weeks as one pass
over all rows: a week or a year is rolled up without reading findings again,
and a day that changes is reduced and replaced alone (``day`` partitions,
dynamic overwrite).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pct
from .metrics import PROCESSED_STATUS, patients_complete, providers_complete

LOG_KEYS = ["day", "table_name", "check_type", "issue_type"]
LOG_SUMS = ["findings", "resolved", "resolved_seconds"]
RECORD_KEYS = ["day", "table_name"]
RECORD_SUMS = ["total_records", "complete_records"]


def log_partials(log: DataFrame) -> DataFrame:
    """Per day of the check, table, check type and issue type: findings, those
    resolved, and the seconds until they were."""
    resolved = (F.col("status") == "RESOLVED") & F.col("resolved_at").isNotNull()
    seconds = F.timestamp_diff("SECOND", F.col("check_timestamp"), F.col("resolved_at"))
    return log.groupBy(F.to_date("check_timestamp").alias("day"), *LOG_KEYS[1:]).agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(resolved).alias("resolved"),
        F.coalesce(F.sum(F.when(resolved, seconds)), F.lit(0)).alias("resolved_seconds"))


def _records(df: DataFrame, table: str, day: Column, complete: Column) -> DataFrame:
    return df.groupBy(day.cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(complete).alias("complete_records")).select(
        "day", F.lit(table).alias("table_name"), *RECORD_SUMS)


def record_partials(patients: DataFrame, claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Per day and table: records and complete ones (M1). Patients count on the
    day they were created, claims when submitted; providers on no day unless
    they have ``created_at``."""
    created = F.col("created_at") if "created_at" in providers.columns else F.lit(None)
    return (_records(patients, "patient_records", F.to_date("created_at"), patients_complete())
            .unionByName(_records(claims, "claims", F.col("submission_date"), F.col("status") == PROCESSED_STATUS))
            .unionByName(_records(providers, "providers", created, providers_complete())))


def merge(*parts: DataFrame) -> DataFrame:
    """Partials of several days, runs or stores as one."""
    sums = LOG_SUMS if "findings" in parts[0].columns else RECORD_SUMS
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*[c for c in parts[0].columns if c not in sums]).agg(*[F.sum(c).alias(c) for c in sums])


def store(partials: DataFrame, path: str) -> None:
    """Write partials by day; days written before are replaced, others stay."""
    (partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def weekly_trend(partials: DataFrame) -> DataFrame:
    """M5 of ``log_partials``: findings per week (from Monday) and issue type."""
    return partials.groupBy(F.to_date(F.date_trunc("week", "day")).alias("week_start"), "issue_type").agg(
        F.sum("findings").alias("findings"))


def resolution_times(partials: DataFrame) -> DataFrame:
    """M4 of ``log_partials``: mean hours to resolution per check type."""
    hours = F.sum("resolved_seconds") / 3600.0 / F.sum("resolved")
    return partials.filter("resolved > 0").groupBy("check_type").agg(
        F.sum("resolved").alias("resolved_count"), F.round(hours, 2).alias("avg_resolution_hours"))


def completeness_rates(partials: DataFrame) -> DataFrame:
    """M1 of ``record_partials``."""
    return partials.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in RECORD_SUMS]).withColumn(
        "completeness_rate", pct(F.col("complete_records"), F.col("total_records")))
