"""The checker's five checks as findings (P01–P05) and audit rows.

Each check yields a ``CheckResult``: the detail rows, plus an issue
projection with one audit row per detail row (check_type, table_name,
record_id, issue_type, issue_description, severity). Projections are plain
column expressions over the details, so building the audit log adds no
shuffle: a run's audit rows are the ``unionByName`` of five projections,
appended in one job instead of one INSERT and commit per finding.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import money, money_text, ts_lit
from . import claims as C
from . import patients as P
from . import providers as V
from .numbering import ordered

ISSUE_COLUMNS = ["check_type", "table_name", "record_id", "issue_type", "issue_description", "severity"]


@dataclass(frozen=True)
class CheckResult:
    """One check of a run.

    ``base`` holds the detail rows, unsorted; ``details`` applies the
    reference's ORDER BY when the check was built with ``sort=True``;
    ``issues`` projects ``base`` to audit columns. ``checkpointed()`` saves
    ``base`` once so details, issues, exports and previews all read it.
    """

    key: str
    check_name: str
    base: DataFrame
    issue_columns: tuple
    order: tuple = ()
    # summary column -> (issue column summed into it, result type)
    totals: dict[str, tuple[str, str]] = field(default_factory=dict)
    # the rows behind each finding, where a finding stands for several
    members: Callable[[], DataFrame] | None = None

    @property
    def details(self) -> DataFrame:
        return self.base.orderBy(*self.order) if self.order else self.base

    @property
    def issues(self) -> DataFrame:
        return self.base.select(*self.issue_columns)

    def checkpointed(self) -> "CheckResult":
        """Reliable checkpoint of ``base`` into ``spark.checkpoint.dir``."""
        return replace(self, base=self.base.checkpoint(eager=True))


def _issue_cols(vocab: tuple[str, str, str, str], record_id: Column, description: Column,
                severity: Column, amount: Column | None = None) -> list[Column]:
    _, check_type, table_name, issue_type = vocab
    return [
        F.lit(check_type).alias("check_type"),
        F.lit(table_name).alias("table_name"),
        record_id.cast("string").alias("record_id"),
        F.lit(issue_type).alias("issue_type"),
        description.alias("issue_description"),
        severity.alias("severity"),
        (amount if amount is not None else F.lit(None)).cast("decimal(38,2)").alias("_amount"),
    ]


def _discrepancy_issue_cols() -> list[Column]:
    """P02's audit columns over rows with claim_total_amount,
    calculated_total and discrepancy_amount."""
    disc = F.col("discrepancy_amount")
    description = F.concat(
        F.lit(R.DISCREPANCY_TOTAL_PREFIX), money_text(F.col("claim_total_amount")),
        F.lit(R.DISCREPANCY_LINES_PREFIX), money_text(F.col("calculated_total")),
        F.lit(R.DISCREPANCY_AMOUNT_PREFIX), money_text(disc),
    )
    return _issue_cols(
        R.CHECKER_CLAIMS_DISCREPANCIES, F.col("claim_id"), description,
        F.when(disc > money(R.CRITICAL_DISCREPANCY), F.lit(R.SEVERITY_CRITICAL)).otherwise(F.lit(R.SEVERITY_HIGH)),
        amount=disc,
    )


def _temporal_issue_cols() -> list[Column]:
    """P03's audit columns over rows with anomaly_type."""
    return _issue_cols(R.CHECKER_TEMPORAL_ANOMALIES, F.col("claim_id"), F.col("anomaly_type"), F.lit(R.SEVERITY_HIGH))


def check_patient_completeness(patients: DataFrame) -> CheckResult:
    """C02 with contact columns, no timestamps, unsorted; HIGH when more
    than two fields are missing, else MEDIUM."""
    base = P.incomplete_patients(patients, sort=False, with_contact_columns=True, with_timestamps=False)
    mf = F.col("missing_fields")
    cols = _issue_cols(
        R.CHECKER_PATIENT_COMPLETENESS, F.col("patient_id"),
        F.concat(F.lit(R.MISSING_FIELDS_PREFIX), F.array_join(mf, ", ")),
        F.when(F.size(mf) > R.HIGH_MISSING_FIELDS, F.lit(R.SEVERITY_HIGH)).otherwise(F.lit(R.SEVERITY_MEDIUM)),
    )
    return CheckResult("patient_completeness", R.CHECKER_PATIENT_COMPLETENESS[0], base, tuple(cols))


def check_claims_discrepancies(claims: DataFrame, lines: DataFrame, sort: bool = False) -> CheckResult:
    """C06 without service date, status and label; CRITICAL above 1000,
    else HIGH. The run summary adds ``total_discrepancy``."""
    return check_line_totals(C.claim_line_totals(claims, lines), sort)


def check_line_totals(totals: DataFrame, sort: bool = False) -> CheckResult:
    """P02 over ``claim_line_totals`` rows."""
    base = C.mismatched_totals(totals, with_service_columns=False, with_issue_type=False)
    # Audit rows come from the unsorted rows: the sort is for presentation only.
    order = (F.col("discrepancy_amount").desc(),) if sort else ()
    return CheckResult("claims_discrepancies", R.CHECKER_CLAIMS_DISCREPANCIES[0], base,
                       tuple(_discrepancy_issue_cols()), order,
                       {"total_discrepancy": ("_amount", "decimal(38,2)")})


def check_temporal_anomalies(claims: DataFrame) -> CheckResult:
    """C08 and C09 in one pass; HIGH."""
    base = C.temporal_anomalies(claims)
    return CheckResult("temporal_anomalies", R.CHECKER_TEMPORAL_ANOMALIES[0], base, tuple(_temporal_issue_cols()))


def check_duplicate_records(patients: DataFrame, sort: bool = False) -> CheckResult:
    """One finding per group of C13, keyed on its smallest id; MEDIUM. The
    run summary adds ``total_duplicates``. The text names the smallest id and
    how many more there are; the members are rows of their own."""
    groups = P.duplicate_patient_groups(patients)
    base = groups.groups.select("name", "date_of_birth", "duplicate_count", "first_id")
    more = (F.col("duplicate_count") - 1).cast("string")
    cols = _issue_cols(
        R.CHECKER_DUPLICATE_RECORDS, F.col("first_id"),
        F.concat(F.lit(R.DUPLICATES_PREFIX), F.col("first_id"), F.lit(R.DUPLICATES_MORE), more), F.lit(R.SEVERITY_MEDIUM),
        amount=F.col("duplicate_count"),
    )
    order = (F.col("duplicate_count").desc(), F.col("name"), F.col("date_of_birth")) if sort else ()
    return CheckResult("duplicate_records", R.CHECKER_DUPLICATE_RECORDS[0], base, tuple(cols), order,
                       {"total_duplicates": ("_amount", "bigint")}, groups.members)


def duplicate_record_lists(patients: DataFrame) -> DataFrame:
    """P04's details with every group's ids (``patient_ids``, sorted), as the
    reference returns them."""
    return P.duplicate_patient_groups(patients).listed("patient_ids").select(
        "name", "date_of_birth", "duplicate_count", "first_id", "patient_ids")


def check_provider_credentials(providers: DataFrame, as_of: dt.date | str | None = None, sort: bool = False) -> CheckResult:
    """C11 without label, ordered by expiry; CRITICAL."""
    base = V.expired_licenses(providers, as_of, with_issue_type=False, sort=False)
    cols = _issue_cols(
        R.CHECKER_PROVIDER_CREDENTIALS, F.col("provider_id"),
        F.concat(F.lit(R.EXPIRED_PREFIX), F.col("days_expired").cast("string"), F.lit(R.EXPIRED_SUFFIX)),
        F.lit(R.SEVERITY_CRITICAL),
    )
    order = (F.col("license_expiry_date").asc(),) if sort else ()
    return CheckResult("provider_credentials", R.CHECKER_PROVIDER_CREDENTIALS[0], base, tuple(cols), order)


def audit_issues(results: list[CheckResult], run_ts: dt.datetime | str, run_id: str | None = None,
                 last_id: int | None = None) -> DataFrame:
    """Audit-log rows for every finding of ``results``."""
    union = None
    for r in results:
        part = r.issues.select(*ISSUE_COLUMNS)
        union = part if union is None else union.unionByName(part)
    return audit_rows(union, run_ts, run_id, last_id)


AUDIT_ORDER = ["check_type", "record_id", "issue_type", "issue_description", "severity", "table_name"]


def audit_rows(issues: DataFrame, run_ts: dt.datetime | str, run_id: str | None = None,
               last_id: int | Column | None = None) -> DataFrame:
    """Issue rows → ``quality_audit_log`` rows (plus ``run_id``).

    ``check_timestamp`` is the run timestamp, ``status`` 'OPEN', the
    assignment/resolution columns NULL. With ``last_id`` (the log's largest id,
    0 for an empty log) ``audit_id`` is the serial that follows it, in
    ``AUDIT_ORDER``: dense, unique, and distinct for equal findings; the rows
    are written once to fix it. Without it (streams, whose batches must not
    wait for each other) it is a hash of run and finding.
    """
    run = run_id or str(run_ts)
    if last_id is None:
        rows = issues.withColumn("audit_id", F.xxhash64(F.lit(run), "check_type", "record_id", "issue_description"))
    else:
        first = last_id + 1
        rows = ordered(issues.select(*ISSUE_COLUMNS), AUDIT_ORDER, "audit_id", first)
    return rows.select(
        "audit_id",
        ts_lit(run_ts).alias("check_timestamp"),
        *ISSUE_COLUMNS,
        F.lit(R.AUDIT_OPEN).alias("status"),
        F.lit(None).cast("string").alias("assigned_to"),
        F.lit(None).cast("string").alias("resolution_notes"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(run).alias("run_id"),
    )
