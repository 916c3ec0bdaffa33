"""Run-level behaviour: invariants between checks, plans
(§5.4), sinks, updates, conform and the incremental stream."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from dqspark.operators import claims as C
from dqspark.operators import constraints as K
from dqspark.operators.updates import apply_updates
from dqspark.plans import sinks
from dqspark.plans.checker import run_all_checks
from dqspark.plans.daily_run import last_id
from dqspark.plans.registry import investigate
from dqspark.sources.readers import conform, read_table

from .conftest import SMALL

AS_OF = dt.date(2024, 2, 1)


def _ids(df, col):
    return {r[0] for r in df.select(col).collect()}


def test_summary_total_equals_audit_rows(spark, tables):
    run = run_all_checks(tables, AS_OF)
    s = run.summary.first()
    assert s["total_issues_found"] == run.audit.count()
    assert s["status"] == "FAIL" and s["checks_performed"] == 5
    counts = {r["check_key"]: r["issues_found"] for r in run.check_counts.collect()}
    assert sum(counts.values()) == s["total_issues_found"]
    assert counts["temporal_anomalies"] == run.checks["temporal_anomalies"].details.count()


def test_materialized_run_matches_lazy_run(spark, tables):
    lazy = run_all_checks(tables, AS_OF).summary.first()
    saved = run_all_checks(tables, AS_OF, materialize=True).summary.first()
    assert lazy == saved


def test_temporal_rows_are_the_union_of_c08_and_c09(tables):
    t = tables
    union = _ids(C.submitted_before_service(t.claims), "claim_id") | _ids(C.processed_before_submission(t.claims), "claim_id")
    both = _ids(C.submitted_before_service(t.claims), "claim_id") & _ids(C.processed_before_submission(t.claims), "claim_id")
    p03 = C.temporal_anomalies(t.claims)
    assert p03.count() == len(union) and _ids(p03, "claim_id") == union
    assert both, "fixture should hold claims with both anomalies"


def test_foreign_key_violations_are_orphans(tables):
    fk = _ids(K.check_foreign_key(tables.claims, tables.patient_records, "patient_id", None, "claim_id"), "claim_id")
    orphan = _ids(C.orphan_claims_patient(tables.claims, tables.patient_records), "claim_id")
    assert fk < orphan


def test_inner_discrepancies_within_c06(tables):
    r2 = _ids(C.claim_discrepancies_inner(tables.claims, tables.claims_line_items), "claim_id")
    c06 = _ids(C.claim_line_mismatch(tables.claims, tables.claims_line_items), "claim_id")
    assert r2 <= c06


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_orphan_checks_plan_as_anti_joins(spark):
    q = entry.queries()
    for name in ("orphan_claims_patient", "orphan_claims_provider"):
        df = q[name](spark, SMALL)
        df.collect()
        assert "LeftAnti" in _plan(df)


def test_no_python_evaluation_in_any_plan(spark):
    for name, fn in entry.queries().items():
        text = fn(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_filters_reach_the_parquet_scan(spark, tables, scratch):
    path = os.path.join(scratch, "claims")
    tables.claims.write.parquet(path)
    stored = read_table(spark, path, "claims")
    plan = C.high_amount_claims(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(claim_total_amount), GreaterThan(claim_total_amount,50000.00)]" in plan
    pending = C.long_pending_claims(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(submission_date,2024-01-02)" in pending
    assert "ReadSchema: struct<claim_id:string,patient_id:string,provider_id:string,submission_date:date,status:string>" in pending


def test_audit_sink_is_idempotent_per_run(spark, tables, scratch):
    path = os.path.join(scratch, "audit")
    run = run_all_checks(tables, AS_OF, run_id="r1")
    n = run.audit.count()
    sinks.append_audit(run.audit, path)
    sinks.append_audit(run.audit, path)            # a retried job
    assert spark.read.parquet(path).count() == n
    # a new run repeats findings, under the ids that follow
    sinks.append_audit(run_all_checks(tables, AS_OF, run_id="r2", last_audit_id=last_id(spark, path, "audit_id", "r2")).audit, path)
    log = spark.read.parquet(path)
    assert log.count() == 2 * n
    assert sorted(r["audit_id"] for r in log.select("audit_id").collect()) == list(range(1, 2 * n + 1))


def test_report_preview_and_exports(spark, tables, scratch):
    run = run_all_checks(tables, AS_OF)
    prev = sinks.report_preview(run, n=3).collect()
    per_check = {}
    for r in prev:
        per_check.setdefault(r["check_key"], []).append(r["preview_rank"])
        json.loads(r["row_json"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 3 for v in per_check.values())
    out = os.path.join(scratch, "json")
    sinks.export_json(run, out)
    assert spark.read.json(os.path.join(out, "summary")).first()["status"] == "FAIL"
    assert spark.read.json(os.path.join(out, "claims_discrepancies")).count() == \
        run.checks["claims_discrepancies"].details.count()
    csv_path = os.path.join(scratch, "csv")
    details = investigate(tables, "patient_records", "completeness", AS_OF)
    sinks.export_csv(details, csv_path)
    back = spark.read.option("header", "true").csv(csv_path)
    assert back.count() == details.count() and "missing_fields" in back.columns


def test_apply_updates_trigger_and_inserts(spark):
    base = spark.createDataFrame(
        [("c1", "PENDING", Decimal("1.00"), dt.datetime(2020, 1, 1)),
         ("c2", "PAID", Decimal("2.00"), dt.datetime(2020, 1, 1))],
        "claim_id string, status string, claim_total_amount decimal(10,2), updated_at timestamp_ntz")
    upd = spark.createDataFrame([("c1", "PENDING", None), ("c9", "PAID", Decimal("9.00"))],
                                "claim_id string, status string, claim_total_amount decimal(10,2)")
    now = dt.datetime(2024, 2, 1, 12)
    out = {r["claim_id"]: r for r in apply_updates(base, upd, "claim_id", now).collect()}
    # unchanged values still stamp updated_at; explicit NULL is written
    assert out["c1"]["updated_at"] == now and out["c1"]["claim_total_amount"] is None
    assert out["c2"]["updated_at"] == dt.datetime(2020, 1, 1)
    assert "c9" not in out
    out2 = {r["claim_id"]: r for r in apply_updates(base, upd, "claim_id", now, insert_missing=True,
                                                     table="claims").collect()}
    assert out2["c9"]["status"] == "PAID" and out2["c9"]["updated_at"] == now


def test_conform_defaults_keep_explicit_nulls(spark):
    df = spark.createDataFrame([("c1", None)], "claim_id string, adjustment_amount decimal(10,2)")
    lines = spark.createDataFrame([("c1",)], "claim_id string")
    now = dt.datetime(2024, 2, 1)
    row = conform(df, "claims", now=now).first()
    assert row["adjustment_amount"] is None and row["created_at"] == now and row["status"] is None
    line = conform(lines.withColumn("line_item_id", F.lit(1)), "claims_line_items").first()
    assert line["quantity"] == 1
    enc = conform(spark.createDataFrame([("e1",)], "encounter_id string"), "encounters", now=now).first()
    assert enc["documentation_complete"] is False and enc["billing_submitted"] is False


def test_incremental_stream_matches_batch(spark, tables, scratch):
    from dqspark.operators.findings import check_patient_completeness
    from dqspark.streaming.incremental import start_audit_stream

    src = os.path.join(scratch, "src")
    patients = tables.patient_records
    patients.repartition(3).write.parquet(src)
    q = start_audit_stream(spark, "patient_records", src, os.path.join(scratch, "sink"),
                           os.path.join(scratch, "ckpt"), AS_OF, max_files_per_trigger=1)
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "sink"))
    want = check_patient_completeness(patients).issues
    assert got.select("run_id").distinct().count() >= 2
    assert sorted(_ids(got, "record_id")) == sorted(_ids(want, "record_id"))
    assert got.count() == want.count()


def test_daily_run_writes_every_output(spark, tables, scratch):
    from dqspark.plans.daily_run import daily_run, load_tables

    root = os.path.join(scratch, "tables")
    for name in ("patient_records", "providers", "claims", "claims_line_items", "encounters", "quality_audit_log"):
        getattr(tables, name).write.parquet(os.path.join(root, name))
    stored = load_tables(spark, root)
    assert stored.claims.columns[:3] == ["claim_id", "patient_id", "provider_id"] and len(stored.claims.columns) == 16
    out = os.path.join(scratch, "out")
    run = daily_run(stored, AS_OF, out, run_id="day1")
    total = run.summary.first()["total_issues_found"]
    assert spark.read.parquet(os.path.join(out, "quality_audit_log")).count() == total
    metrics = spark.read.parquet(os.path.join(out, "quality_metrics"))
    assert {r["category"] for r in metrics.collect()} >= {"completeness", "accuracy", "error_rate", "trend"}
    assert spark.read.parquet(os.path.join(out, "report_preview")).count() <= 50
    daily_run(stored, AS_OF, out, run_id="day1")          # retry of the same run: no duplicates
    assert spark.read.parquet(os.path.join(out, "quality_audit_log")).count() == total


def test_same_day_runs_add_rows_and_a_retry_replaces_only_itself(spark, tables, scratch):
    from dqspark.plans.daily_run import daily_run, load_tables

    root = os.path.join(scratch, "same")
    for name in ("patient_records", "providers", "claims", "claims_line_items", "encounters"):
        getattr(tables, name).write.parquet(os.path.join(root, name))
    uri = f"file://{root}"
    first = daily_run(load_tables(spark, uri), AS_OF, uri, run_id="a")
    total = first.summary.first()["total_issues_found"]
    stored = load_tables(spark, uri)
    assert stored.quality_audit_log.count() == total          # found through a URI too
    daily_run(stored, AS_OF, uri)                              # another run of the day, a new id
    daily_run(load_tables(spark, uri), AS_OF, uri, run_id="a")  # retry, log read and written in one folder
    log = spark.read.parquet(os.path.join(root, "quality_audit_log"))
    assert log.count() == 2 * total and log.select("run_id").distinct().count() == 2
    metrics = spark.read.parquet(os.path.join(root, "quality_metrics"))
    by_run = metrics.groupBy("run_id").pivot("category").count().collect()
    assert len(by_run) == 2 and all(r["trend"] for r in by_run)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_tables(spark, uri, audit_log=f"{uri}/no_such_log")


def test_csv_and_json_sources_use_the_declared_schema(spark, tables, scratch):
    path = os.path.join(scratch, "claims_csv")
    tables.claims.write.option("header", "true").csv(path)
    back = read_table(spark, path, "claims", fmt="csv")
    assert dict(back.dtypes)["claim_total_amount"] == "decimal(10,2)"
    assert dict(back.dtypes)["service_date"] == "date"
    # columns absent from the file stay absent; conform adds them with defaults
    assert "created_at" not in back.columns and back.count() == tables.claims.count()
    got = back.select("claim_id", "claim_total_amount").exceptAll(tables.claims.select("claim_id", "claim_total_amount"))
    assert got.count() == 0


def test_html_report_is_bounded_and_complete(spark, tables, scratch):
    run = run_all_checks(tables, AS_OF)
    page = sinks.render_html_report(run, "2024-02-01T00:00:00", n=2)
    for name in ("Patient Completeness", "Claims Discrepancies", "Temporal Anomalies", "Duplicate Records",
                 "Provider Credentials", "FAIL"):
        assert name in page
    assert page.count("<tr>") <= 5 * 3
    out = os.path.join(scratch, "report")
    sinks.write_html_report(run, out, "2024-02-01T00:00:00")
    text = "\n".join(r["value"] for r in spark.read.text(out).collect())
    assert text.startswith("<!DOCTYPE html>") and "Total Issues Found" in text


def test_line_totals_aggregate_before_the_join(spark, tables):
    df = C.claim_line_mismatch(tables.claims, tables.claims_line_items)
    plan = _plan(df)
    assert "partial_sum(line_item_amount" in plan and "LeftOuter" in plan
    # the join's line side is the aggregate, not the raw lines
    join_at = plan.index("LeftOuter")
    assert "HashAggregate(keys=[claim_id" in plan[join_at:]


def test_findings_are_unsorted_unless_asked(spark, tables):
    plain = _plan(C.long_pending_claims(tables.claims, AS_OF))
    ordered = _plan(C.long_pending_claims(tables.claims, AS_OF, sort=True))
    assert "Sort [" not in plain and "rangepartitioning" not in plain
    assert "Sort [submission_date" in ordered


def test_results_do_not_depend_on_the_session_time_zone(spark):
    names = ["incomplete_patients", "stale_patients", "quality_metrics", "weekly_error_trend",
             "resolution_times", "audit_issues", "claims_after_processing"]
    q = entry.queries()
    base = {n: sorted(map(tuple, q[n](spark, SMALL).collect()), key=repr) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Sao_Paulo", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for n in names:
                assert sorted(map(tuple, q[n](spark, SMALL).collect()), key=repr) == base[n], (zone, n)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_results_do_not_depend_on_ansi_mode(spark):
    names = ["patient_completeness_summary", "claim_line_mismatch", "payment_mismatch", "accuracy_rates",
             "run_summary", "table_violations_claims", "conformed_claims"]
    q = entry.queries()
    base = {n: sorted(map(tuple, q[n](spark, SMALL).collect()), key=repr) for n in names}
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false" if old == "true" else "true")
        for n in names:
            assert sorted(map(tuple, q[n](spark, SMALL).collect()), key=repr) == base[n], n
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_bucketed_claims_and_lines_need_no_shuffle(spark, tables, scratch):
    from dqspark.sources.readers import read_stored, store_bucketed

    store_bucketed(tables.claims, "dq_claims_b", "claim_id", 8, os.path.join(scratch, "claims_b"))
    store_bucketed(tables.claims_line_items, "dq_lines_b", "claim_id", 8, os.path.join(scratch, "lines_b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = C.claim_line_mismatch(read_stored(spark, "dq_claims_b"), read_stored(spark, "dq_lines_b"))
        rows = df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(claim_id" not in plan
        assert rows == C.claim_line_mismatch(tables.claims, tables.claims_line_items).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS dq_claims_b")
        spark.sql("DROP TABLE IF EXISTS dq_lines_b")


def test_incremental_claims_stream_matches_batch(spark, tables, scratch):
    from dqspark.operators.findings import check_temporal_anomalies
    from dqspark.streaming.incremental import start_audit_stream

    src = os.path.join(scratch, "claims_src")
    tables.claims.repartition(4).write.parquet(src)
    sink = os.path.join(scratch, "claims_sink")
    q = start_audit_stream(spark, "claims", src, sink, os.path.join(scratch, "claims_ckpt"), AS_OF,
                           max_files_per_trigger=2)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    want = check_temporal_anomalies(tables.claims).issues
    assert got.count() == want.count()
    assert got.select("record_id", "issue_description").exceptAll(
        want.select("record_id", "issue_description")).count() == 0


def test_updates_stamp_only_tables_with_the_trigger(spark):
    base = spark.createDataFrame([("a1", "OPEN", dt.datetime(2020, 1, 1))],
                                 "audit_id string, status string, updated_at timestamp_ntz")
    upd = spark.createDataFrame([("a1", "RESOLVED")], "audit_id string, status string")
    now = dt.datetime(2024, 2, 1, 12)
    row = apply_updates(base, upd, "audit_id", now, table="quality_audit_log").first()
    assert row["status"] == "RESOLVED" and row["updated_at"] == dt.datetime(2020, 1, 1)
    row = apply_updates(base, upd, "audit_id", now).first()
    assert row["updated_at"] == now


def test_table_constraints_scan_the_table_once_for_row_rules(spark, tables, scratch):
    path = os.path.join(scratch, "claims_k")
    tables.claims.write.parquet(path)
    stored = read_table(spark, path, "claims")
    df = K.check_table(stored, "claims", {"patient_records": tables.patient_records, "providers": tables.providers})
    plan = df._jdf.queryExecution().executedPlan().toString()
    # primary key count, two foreign-key anti joins, one pass for every row rule
    assert plan.count(f"[file:{path}]") == 4


def test_accuracy_rates_read_each_table_once(spark, tables, scratch):
    from dqspark.operators import metrics as MT

    paths = {}
    for name in ("patient_records", "claims", "claims_line_items"):
        paths[name] = os.path.join(scratch, name)
        getattr(tables, name).write.parquet(paths[name])
    stored = {n: read_table(spark, p, n) for n, p in paths.items()}
    df = MT.accuracy_rates(stored["patient_records"], stored["claims"], stored["claims_line_items"], AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert all(plan.count(f"[file:{p}]") == 1 for p in paths.values())
    assert df.count() == 2


def test_investigate_unknown_pair_lists_known_ones(tables):
    import pytest

    with pytest.raises(KeyError) as err:
        investigate(tables, "claims", "no_such_check", AS_OF)
    assert "claims/billing_validation" in str(err.value)
    assert investigate(tables, "providers", "credentials", AS_OF).columns[0] == "provider_id"


def test_only_the_report_preview_limits_rows(spark):
    for name, fn in entry.queries().items():
        text = fn(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        has_limit = "GlobalLimit" in text or "LocalLimit" in text
        assert has_limit == (name == "report_preview"), name


def test_bench_prints_one_json_line():
    import subprocess
    import sys as _sys

    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_REPEAT="1", BENCH_CPUS="2",
               BENCH_QUERIES="invalid_phone,expired_licenses")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([_sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"invalid_phone", "expired_licenses"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-3


def test_malformed_json_fails_the_read(spark, scratch):
    from dqspark.sources.readers import read_table

    path = os.path.join(scratch, "claims.json")
    with open(path, "w") as f:
        f.write(json.dumps({"claim_id": "C1", "claim_total_amount": "oops"}) + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_table(spark, path, "claims", "json").collect()
