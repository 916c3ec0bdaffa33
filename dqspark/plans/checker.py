"""``run_all_checks`` (P06): the checker's five checks, audit rows, summary.

Plan shape: the five issue projections are unioned into one DataFrame with a
``check_key`` tag and an ``_amount`` column (P02's discrepancy, P04's group
size). The per-check counts and the two totals come from ONE aggregation
over that union — partial aggregation on every task, a single-row final
merge — so the run needs no driver-side loop over results.

With ``materialize=True`` the rows the checks find are written once, one pass
per table (``fused.flag_tables``: a reliable checkpoint into the session's
shared ``spark.checkpoint.dir``): the audit append, the summary, the exports
and the report preview then read the saved rows instead of the tables, and a
lost executor costs a re-read, not a re-run. Duplicate keys are counted in a
pass of their own, over the three key columns.

``count_checks`` is the run that only counts: one scan of each table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import as_timestamp, ts_lit
from ..operators import findings as FND
from ..session import checkpoint_dir
from . import fused


@dataclass(frozen=True)
class RunResult:
    checks: dict[str, FND.CheckResult]
    check_counts: DataFrame   # check_key, check_name, issues_found
    summary: DataFrame        # one row
    findings: DataFrame       # issue rows tagged with their check
    run_ts: dt.datetime
    run_id: str
    last_audit_id: int = 0

    @cached_property
    def audit(self) -> DataFrame:
        """W1 rows of this run, numbered."""
        return FND.audit_rows(self.findings, self.run_ts, self.run_id, self.last_audit_id)


CHECK_NAMES = {
    "patient_completeness": R.CHECKER_PATIENT_COMPLETENESS[0], "claims_discrepancies": R.CHECKER_CLAIMS_DISCREPANCIES[0],
    "temporal_anomalies": R.CHECKER_TEMPORAL_ANOMALIES[0], "duplicate_records": R.CHECKER_DUPLICATE_RECORDS[0],
    "provider_credentials": R.CHECKER_PROVIDER_CREDENTIALS[0]}

# The row-local rules the five checks rest on.
CHECKER_RULES = {"incomplete_patients", "claim_line_mismatch", "submitted_before_service", "processed_before_submission",
                 "expired_licenses"}


def _namespace(tables) -> SimpleNamespace:
    return SimpleNamespace(**tables) if isinstance(tables, dict) else tables


def build_checks(tables, as_of: dt.date | str | None = None) -> dict[str, FND.CheckResult]:
    """The five checks of the reference's checker, in its order. ``tables``
    is anything with ``patient_records``, ``providers``, ``claims`` and
    ``claims_line_items`` attributes (e.g. ``HealthcareTables``) or a dict."""
    t = _namespace(tables)
    checks = [
        FND.check_patient_completeness(t.patient_records),
        FND.check_claims_discrepancies(t.claims, t.claims_line_items),
        FND.check_temporal_anomalies(t.claims),
        FND.check_duplicate_records(t.patient_records),
        FND.check_provider_credentials(t.providers, as_of),
    ]
    return {c.key: c for c in checks}


def saved_checks(tables, as_of: dt.date | str | None = None) -> dict[str, FND.CheckResult]:
    """The same checks over rows written once: flagged rows of one pass per
    table, and the groups of duplicate keys."""
    t = _namespace(tables)
    flagged = fused.flag_tables(t, as_of, only=CHECKER_RULES)
    checks = [
        FND.check_patient_completeness(flagged["patient_records"]),
        FND.check_line_totals(flagged["claims"]),
        FND.check_temporal_anomalies(flagged["claims"]),
        FND.check_duplicate_records(t.patient_records).checkpointed(),
        FND.check_provider_credentials(flagged["providers"], as_of),
    ]
    return {c.key: c for c in checks}


def count_checks(tables, as_of: dt.date | str | None = None) -> tuple[DataFrame, DataFrame]:
    """P06 without details: counts per check and the summary row, from one
    scan of each table."""
    return fused.run_counts(fused.tallies(tables, as_of), CHECK_NAMES)


def _tagged_union(checks: dict[str, FND.CheckResult]) -> DataFrame:
    union = None
    for key, c in checks.items():
        part = c.issues.select(F.lit(key).alias("check_key"), *FND.ISSUE_COLUMNS, "_amount")
        union = part if union is None else union.unionByName(part)
    return union


def summarize(checks: dict[str, FND.CheckResult], findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-check counts (one row per check, zeros included) and the run
    summary, both from one aggregation over the tagged findings."""
    keys = list(checks)
    aggs = [F.count_if(F.col("check_key") == k).alias(f"n_{i}") for i, k in enumerate(keys)]
    totals = []
    for key, c in checks.items():
        for name, (col, dtype) in c.totals.items():
            totals.append(
                F.coalesce(F.sum(F.when(F.col("check_key") == key, F.col(col))), F.lit(0)).cast(dtype).alias(name)
            )
    wide = findings.agg(*aggs, *totals)
    stack = ", ".join(f"'{k}', '{checks[k].check_name}', n_{i}" for i, k in enumerate(keys))
    counts = wide.selectExpr(f"stack({len(keys)}, {stack}) AS (check_key, check_name, issues_found)")
    total = sum((F.col(f"n_{i}") for i in range(len(keys))), F.lit(0).cast("bigint"))
    summary = wide.select(
        total.alias("total_issues_found"),
        F.lit(len(keys)).cast("bigint").alias("checks_performed"),
        F.when(total > 0, F.lit(R.RUN_STATUS_FAIL)).otherwise(F.lit(R.RUN_STATUS_PASS)).alias("status"),
        *[F.col(n) for c in checks.values() for n in c.totals],
    )
    return counts, summary


def run_all_checks(tables, as_of: dt.date | str | None = None, run_ts: dt.datetime | str | None = None,
                   run_id: str | None = None, materialize: bool = False, last_audit_id: int = 0) -> RunResult:
    """P06. The summary and the audit rows carry the run's timestamp; audit ids
    follow ``last_audit_id``, the log's largest. The audit rows are written
    once to number them, when ``audit`` is first asked for; nothing else
    executes until an action, unless ``materialize`` saves the rows found."""
    ts = as_timestamp(run_ts if run_ts is not None else as_of)
    if materialize:
        checkpoint_dir(_namespace(tables).claims.sparkSession)
        checks = saved_checks(tables, as_of)
    else:
        checks = build_checks(tables, as_of)
    findings = _tagged_union(checks)
    counts, summary = summarize(checks, findings)
    summary = summary.select(ts_lit(ts).alias("run_timestamp"), *summary.columns)
    return RunResult(checks, counts, summary, findings, ts, run_id or ts.isoformat(), last_audit_id)
