"""The fused run: the single checks' rows from one pass per table, counts from
one scan of each, and serial ids over several runs."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dqspark.operators import claims as C
from dqspark.operators import encounters as E
from dqspark.operators import metrics as MT
from dqspark.operators import patients as P
from dqspark.operators import providers as V
from dqspark.operators.findings import ISSUE_COLUMNS, audit_rows
from dqspark.operators.numbering import ordered
from dqspark.plans import fused
from dqspark.plans.checker import CHECK_NAMES, count_checks, run_all_checks
from dqspark.sources.readers import read_table

AS_OF = dt.date(2024, 2, 1)
NAMES = ("patient_records", "providers", "claims", "claims_line_items", "encounters")


def rows(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


def single_checks(t):
    return {
        "incomplete_patients": P.incomplete_patients(t.patient_records), "invalid_dob": P.invalid_dob(t.patient_records, AS_OF),
        "invalid_phone": P.invalid_phone(t.patient_records), "invalid_email": P.invalid_email(t.patient_records),
        "stale_patients": P.stale_patients(t.patient_records, AS_OF), "missing_field_counts": P.missing_field_counts(t.patient_records),
        "claim_line_mismatch": C.claim_line_mismatch(t.claims, t.claims_line_items), "payment_mismatch": C.payment_mismatch(t.claims),
        "submitted_before_service": C.submitted_before_service(t.claims),
        "processed_before_submission": C.processed_before_submission(t.claims),
        "long_pending_claims": C.long_pending_claims(t.claims, AS_OF), "high_amount_claims": C.high_amount_claims(t.claims),
        "expired_licenses": V.expired_licenses(t.providers, AS_OF), "incomplete_providers": V.incomplete_providers(t.providers),
        "incomplete_encounters": E.incomplete_encounters(t.encounters, AS_OF),
        "documented_not_billed": E.documented_not_billed(t.encounters, AS_OF),
    }


@pytest.mark.parametrize("materialize", [True, False])
def test_flagged_checks_equal_the_single_operators(tables, materialize):
    split = fused.flagged_checks(fused.flag_tables(tables, AS_OF, materialize=materialize), AS_OF)
    want = single_checks(tables)
    assert set(split) == set(want)
    for name, df in want.items():
        assert split[name].columns == df.columns, name
        assert rows(split[name]) == rows(df), name
        assert df.count() > 0, name


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    for n in NAMES:
        getattr(tables, n).write.parquet(os.path.join(root, n))
    return root, {n: read_table(spark, os.path.join(root, n), n) for n in NAMES}


def scans(df, root):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {n: plan.count(f"[file:{os.path.join(root, n)}]") for n in NAMES}


def test_counting_runs_scan_each_table_once(stored):
    root, t = stored
    once = {"patient_records": 1, "providers": 1, "claims": 1, "claims_line_items": 1, "encounters": 0}
    counted = fused.tallies(t, AS_OF)
    for df in (counted, fused.error_rates(counted), fused.rate_values(counted), *fused.run_counts(counted, CHECK_NAMES)):
        assert scans(df, root) == once
    flagged = fused.flag_tables(t, AS_OF, materialize=False)
    assert scans(flagged["claims"], root) == {**dict.fromkeys(NAMES, 0), "claims": 1, "claims_line_items": 1}
    assert scans(flagged["patient_records"], root)["patient_records"] == 1


def test_counts_equal_the_single_operators(tables):
    counted = fused.tallies(tables, AS_OF)
    run = run_all_checks(tables, AS_OF)
    counts, summary = count_checks(tables, AS_OF)
    assert rows(counts) == rows(run.check_counts)
    assert rows(summary) == rows(run.summary.drop("run_timestamp"))
    three = {n: getattr(tables, n) for n in ("patient_records", "claims", "providers")}
    assert rows(fused.error_rates(counted)) == rows(MT.error_rates(run.audit, three))
    values = {(r["metric_name"], r["notes"]): r["value"] for r in fused.rate_values(counted).collect()}
    for df, name in ((MT.completeness_rates(tables.patient_records, tables.claims, tables.providers), "completeness_rate"),
                     (MT.accuracy_rates(tables.patient_records, tables.claims, tables.claims_line_items, AS_OF), "accuracy_rate")):
        for r in df.collect():
            assert values.pop((name, r["table_name"])) == r[name]
    assert {k[0] for k in values} == {"error_rate_per_1000"} and len(values) == 3


def test_failing_ids_count_once_and_null_ids_not(spark, tables):
    bad = tables.claims.filter(C.submitted_before_service_condition()).limit(1)
    null_id = bad.withColumn("claim_id", F.lit(None).cast("string"))
    claims = tables.claims.unionByName(bad).unionByName(bad).unionByName(null_id)
    t = {"patient_records": tables.patient_records, "providers": tables.providers, "claims": claims, "claims_line_items": tables.claims_line_items}
    got = {(r["table_name"], r["measure"]): r["value"] for r in fused.tallies(t, AS_OF).collect()}
    want = {r["table_name"]: r for r in MT.accuracy_rates(tables.patient_records, claims, tables.claims_line_items, AS_OF).collect()}
    assert got["claims", "failing_keys"] == want["claims"]["failing_records"]
    assert got["claims", "total_records"] == want["claims"]["total_records"]


def test_tallies_of_empty_tables_are_zero(tables):
    empty = {n: getattr(tables, n).limit(0) for n in NAMES}
    counts, summary = count_checks(empty, AS_OF)
    assert {r["issues_found"] for r in counts.collect()} == {0} and counts.count() == 5
    assert summary.first().asDict() == {"total_issues_found": 0, "checks_performed": 5, "status": "PASS", "total_discrepancy": 0, "total_duplicates": 0}
    assert all(r["value"] is None for r in fused.rate_values(fused.tallies(empty, AS_OF)).collect())


def test_serial_ids_are_dense_also_for_equal_findings(spark):
    issue = ("c", "t", "r", "i", "same text", "HIGH")
    issues = spark.createDataFrame([issue] * 50 + [("b", "t", None, "i", None, "LOW")], ", ".join(f"{c} string" for c in ISSUE_COLUMNS))
    first = audit_rows(issues.repartition(7), "2024-02-01 00:00:00", "a", last_id=0)
    second = audit_rows(issues.repartition(3), "2024-02-01 00:00:00", "b", last_id=51)
    ids = sorted(r["audit_id"] for r in first.unionByName(second).collect())
    assert ids == list(range(1, 103))
    assert first.filter("check_type = 'b'").first()["audit_id"] == 1      # in the order of the check
    assert ordered(issues.limit(0), ["check_type"], "n").count() == 0


def test_a_weekly_count_beyond_ten_digits_is_kept(spark):
    trend = spark.createDataFrame([(dt.date(2024, 1, 1), "x", 4_000_000_000)], "week_start date, issue_type string, findings long")
    row = MT.metric_rows(AS_OF, trend=trend, last_id=9).first()
    assert row["metric_value"] == 4_000_000_000 and row["metric_id"] == 10
