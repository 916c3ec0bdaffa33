"""Hand cases on tiny frames: the boundaries and PostgreSQL semantics the
operators must keep (SURVEY §1.3 and §5.2)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dqspark.functions.exprs import age_years, date_lit
from dqspark.operators import claims as C
from dqspark.operators import encounters as E
from dqspark.operators import findings as FND
from dqspark.operators import patients as P
from dqspark.operators import providers as V
from dqspark.operators.core import duplicates

AS_OF = dt.date(2024, 2, 1)
D = dt.date

PATIENT_SCHEMA = ("patient_id string, name string, date_of_birth date, insurance_id string, "
                  "primary_provider string, contact_phone string, contact_email string, "
                  "created_at timestamp_ntz, updated_at timestamp_ntz, last_visit_date date, is_active boolean")
CLAIM_SCHEMA = ("claim_id string, patient_id string, provider_id string, claim_total_amount decimal(10,2), "
                "service_date date, submission_date date, processing_date date, status string, "
                "insurance_paid_amount decimal(10,2), patient_responsibility decimal(10,2), "
                "adjustment_amount decimal(10,2)")
LINE_SCHEMA = "claim_id string, line_item_id long, line_item_amount decimal(10,2)"


def patient(pid, name="N", dob=D(1980, 1, 1), ins="I", prov="D1", phone="(555) 123-4567",
            email="a@b.org", active=True, updated=dt.datetime(2023, 6, 1)):
    return (pid, name, dob, ins, prov, phone, email, dt.datetime(2020, 1, 1), updated, D(2023, 1, 1), active)


def claim(cid, total="100.00", pid="P1", prov="D1", service=D(2023, 6, 1), submission=D(2023, 6, 2),
          processing=None, status="PAID", paid=None, resp=None, adj=None):
    dec = lambda x: None if x is None else Decimal(x)
    return (cid, pid, prov, dec(total), service, submission, processing, status, dec(paid), dec(resp), dec(adj))


def ids(df, col):
    return sorted(r[0] for r in df.select(col).collect())


@pytest.mark.parametrize("dob,expected", [
    (D(2000, 2, 29), 23),          # leap-day birth, before the birthday in 2024
    (D(1904, 2, 1), 120),          # exactly 120 today: not over
    (D(1904, 2, 2), 119),
    (D(1903, 2, 1), 121),
    (D(2030, 1, 1), -5),           # future: sign restored, truncated toward zero
    (D(2024, 2, 2), 0),
])
def test_age_years(spark, dob, expected):
    got = spark.range(1).select(age_years(F.lit(dob), date_lit(AS_OF)).alias("a")).first()["a"]
    assert got == expected


def test_age_leap_day_anniversary(spark):
    got = spark.range(1).select(age_years(F.lit(D(2000, 2, 29)), F.lit(D(2001, 2, 28))).alias("a")).first()["a"]
    assert got == 0


def test_invalid_dob_boundaries(spark):
    df = spark.createDataFrame([
        patient("future", dob=D(2024, 2, 2)), patient("today", dob=AS_OF),
        patient("old", dob=D(1899, 12, 31)), patient("age124", dob=D(1900, 1, 1)),
        patient("age120", dob=D(1904, 2, 1)), patient("age121", dob=D(1903, 1, 31)),
        patient("nodob", dob=None), patient("inactive_future", dob=D(2025, 1, 1), active=False),
    ], PATIENT_SCHEMA)
    assert ids(P.invalid_dob(df, AS_OF), "patient_id") == ["age121", "age124", "future", "inactive_future", "old"]


def test_phone_and_email_rules(spark):
    df = spark.createDataFrame([
        patient("ok"), patient("short", phone="555-0"), patient("ext", phone="+1 (555) 123-4567 ext 89"),
        patient("nophone", phone=None), patient("inactive", phone="1", active=False),
        patient("nl", email="a@b.org\n"), patient("noat", email="ab.org"), patient("tld1", email="a@b.c"),
    ], PATIENT_SCHEMA)
    assert ids(P.invalid_phone(df), "patient_id") == ["ext", "short"]
    # A trailing newline must not pass (Java's $ would accept it).
    assert ids(P.invalid_email(df), "patient_id") == ["nl", "noat", "tld1"]


def test_missing_fields_and_completeness(spark):
    df = spark.createDataFrame([
        patient("full"), patient("two", name=None, ins=None),
        patient("three", name=None, ins=None, prov=None), patient("contact", phone=None, email=None),
        patient("inactive", name=None, active=False), patient("nullactive", name=None, active=None),
    ], PATIENT_SCHEMA)
    rows = {r["patient_id"]: r["missing_fields"] for r in P.incomplete_patients(df).collect()}
    assert rows == {"two": ["name", "insurance_id"], "three": ["name", "insurance_id", "primary_provider"],
                    "contact": ["contact_info"]}
    sev = {r["record_id"]: r["severity"] for r in FND.check_patient_completeness(df).issues.collect()}
    assert sev == {"two": "MEDIUM", "three": "HIGH", "contact": "MEDIUM"}
    s = P.patient_completeness_summary(df).first()
    # contact is counted but does not lower the percentage
    assert (s["total_records"], s["missing_all_contact"], s["completeness_percentage"]) == (4, 1, 50.0)


def test_completeness_summary_on_empty_table(spark):
    df = spark.createDataFrame([], PATIENT_SCHEMA)
    s = P.patient_completeness_summary(df).first()
    assert s["total_records"] == 0 and s["completeness_percentage"] is None


def test_claim_line_mismatch_cent_boundary(spark):
    claims = spark.createDataFrame([
        claim("exact", "100.00"), claim("cent", "100.01"), claim("two", "100.02"),
        claim("nolines", "5.00"), claim("nolines0", "0.00"), claim("nulltotal", None), claim("zero", "0.00"),
    ], CLAIM_SCHEMA)
    lines = spark.createDataFrame([
        ("exact", 1, Decimal("60.00")), ("exact", 2, Decimal("40.00")),
        ("cent", 3, Decimal("100.00")), ("two", 4, Decimal("100.00")),
        ("nulltotal", 5, Decimal("1.00")), ("zero", 6, Decimal("3.00")), (None, 7, Decimal("9.00")),
    ], LINE_SCHEMA)
    out = {r["claim_id"]: r for r in C.claim_line_mismatch(claims, lines).collect()}
    assert sorted(out) == ["nolines", "two", "zero"]
    assert out["nolines"]["line_item_count"] == 0 and out["nolines"]["calculated_total"] == Decimal("0.00")
    assert out["two"]["discrepancy_amount"] == Decimal("0.02")
    assert out["zero"]["discrepancy_percentage"] is None
    # the inner-join variant does not see claims without lines
    assert ids(C.claim_discrepancies_inner(claims, lines), "claim_id") == ["two", "zero"]


def test_claims_discrepancy_severity_at_1000(spark):
    claims = spark.createDataFrame([claim("a", "1000.00"), claim("b", "1000.01")], CLAIM_SCHEMA)
    lines = spark.createDataFrame([], LINE_SCHEMA)
    res = FND.check_claims_discrepancies(claims, lines)
    sev = {r["record_id"]: (r["severity"], r["issue_description"]) for r in res.issues.collect()}
    assert sev["a"][0] == "HIGH" and sev["b"][0] == "CRITICAL"
    assert sev["a"][1] == "Claim total: $1000.00, Line items sum: $0.00, Discrepancy: $1000.00"


def test_payment_mismatch_nulls_count_as_zero(spark):
    claims = spark.createDataFrame([
        claim("ok", "100.00", paid="80.00", resp="20.00"), claim("adjnull", "100.00", paid="80.00", resp="20.00", adj=None),
        claim("off", "100.00", paid="80.00", resp="19.98"), claim("cent", "100.00", paid="80.00", resp="19.99"),
        claim("denied", "100.00", paid="0.00", status="DENIED"), claim("allnull", "100.00", status="PROCESSED"),
    ], CLAIM_SCHEMA)
    assert ids(C.payment_mismatch(claims), "claim_id") == ["allnull", "off"]


def test_temporal_rules(spark):
    claims = spark.createDataFrame([
        claim("both", service=D(2023, 6, 5), submission=D(2023, 6, 1), processing=D(2023, 5, 1)),
        claim("proc", service=D(2023, 6, 1), submission=D(2023, 6, 3), processing=D(2023, 6, 2)),
        claim("fine", service=D(2023, 6, 1), submission=D(2023, 6, 3), processing=None),
    ], CLAIM_SCHEMA)
    assert [r["days_difference"] for r in C.submitted_before_service(claims).collect()] == [-4]
    assert ids(C.processed_before_submission(claims), "claim_id") == ["both", "proc"]
    kinds = {r["claim_id"]: r["anomaly_type"] for r in C.temporal_anomalies(claims).collect()}
    assert kinds == {"both": "Submission before service", "proc": "Processing before submission"}


def test_day_thresholds_are_strict(spark):
    claims = spark.createDataFrame([
        claim("d30", status="PENDING", submission=D(2024, 1, 2)),   # exactly 30 days
        claim("d31", status="SUBMITTED", submission=D(2024, 1, 1)),
        claim("paid", status="PAID", submission=D(2023, 1, 1)),
    ], CLAIM_SCHEMA)
    out = C.long_pending_claims(claims, AS_OF).collect()
    assert [(r["claim_id"], r["days_pending"]) for r in out] == [("d31", 31)]
    enc = spark.createDataFrame([
        ("e7", D(2024, 1, 25), False, False), ("e8", D(2024, 1, 24), False, False),
        ("e14", D(2024, 1, 18), True, False), ("e15", D(2024, 1, 17), True, False),
        ("enull", D(2023, 1, 1), None, None),
    ], "encounter_id string, encounter_date date, documentation_complete boolean, billing_submitted boolean")
    enc = enc.withColumn("patient_id", F.lit("P")).withColumn("provider_id", F.lit("D")) \
             .withColumn("encounter_type", F.lit("visit"))
    assert ids(E.incomplete_encounters(enc, AS_OF), "encounter_id") == ["e8"]
    assert ids(E.documented_not_billed(enc, AS_OF), "encounter_id") == ["e15"]


def test_frequent_claimants_threshold(spark):
    rows = [claim(f"a{i}", pid="A", service=D(2023, 3, 1)) for i in range(50)]
    rows += [claim(f"b{i}", pid="B", service=D(2023, 3, 1)) for i in range(51)]
    rows += [claim(f"c{i}", pid="C", service=D(2023, 1, 31)) for i in range(60)]   # outside the year
    rows += [claim(f"x{i}", pid="X", service=D(2023, 3, 1)) for i in range(60)]    # orphan patient
    claims = spark.createDataFrame(rows, CLAIM_SCHEMA)
    patients = spark.createDataFrame([patient("A"), patient("B"), patient("C")], PATIENT_SCHEMA)
    out = C.frequent_claimants(claims, patients, AS_OF).collect()
    assert [(r["patient_id"], r["claim_count"]) for r in out] == [("B", 51)]


def test_stale_patients_two_years(spark):
    df = spark.createDataFrame([
        patient("edge", updated=dt.datetime(2022, 2, 1)), patient("old", updated=dt.datetime(2022, 1, 31, 23, 59)),
        patient("inactive", updated=dt.datetime(2010, 1, 1), active=False),
    ], PATIENT_SCHEMA)
    out = P.stale_patients(df, AS_OF).collect()
    assert [(r["patient_id"], r["days_since_update"]) for r in out] == [("old", 731)]


def test_orphans_keep_null_keys_but_foreign_keys_do_not(spark):
    from dqspark.operators.constraints import check_foreign_key

    claims = spark.createDataFrame([claim("c1", pid="P1"), claim("c2", pid=None), claim("c3", pid="P9")], CLAIM_SCHEMA)
    patients = spark.createDataFrame([patient("P1")], PATIENT_SCHEMA)
    assert ids(C.orphan_claims_patient(claims, patients), "claim_id") == ["c2", "c3"]
    assert ids(check_foreign_key(claims, patients, "patient_id", None, "claim_id"), "claim_id") == ["c3"]


def test_duplicates_group_null_keys_and_number_every_member(spark):
    rows = [claim(f"n{i}", pid=None, service=D(2023, 1, 1), total="5.00") for i in range(2)]
    rows += [claim(f"h{i:02d}", pid="HOT", service=D(2023, 1, 1), total="5.00") for i in range(25)]
    rows += [claim("single", pid="S")]
    claims = spark.createDataFrame(rows, CLAIM_SCHEMA).repartition(5)
    out = [(r["patient_id"], r["duplicate_count"], r["first_id"], r["member_no"], r["claim_id"]) for r in C.duplicate_claims(claims).collect()]
    want = [(None, 2, "n0", i + 1, f"n{i}") for i in range(2)] + [("HOT", 25, "h00", i + 1, f"h{i:02d}") for i in range(25)]
    assert sorted(out, key=str) == sorted(want, key=str)
    groups = {r["patient_id"]: (r["duplicate_count"], r["first_id"]) for r in C.duplicate_claim_groups(claims).groups.collect()}
    assert groups == {None: (2, "n0"), "HOT": (25, "h00")}


def test_no_task_holds_a_large_group(spark):
    """Members of one group lie in many range partitions and are numbered across them."""
    df = spark.range(20_000).selectExpr("'same' AS k", "id")
    groups = duplicates(df, ["k"], "id")
    members = groups.members()
    assert members.agg(F.count("*"), F.min("member_no"), F.max("member_no"), F.count_distinct("member_no")).first()[:] == (20_000, 1, 20_000, 20_000)
    assert members.filter("member_no <> id + 1").count() == 0
    from dqspark.operators.numbering import ordered
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # else small parts are joined
    try:
        placed = ordered(df, ["k", "id"], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000
    assert all(f"{f}(" not in members._jdf.queryExecution().toString() for f in ("collect_list", "sort_array"))


@pytest.mark.parametrize("size", [2, 4, 150])
def test_duplicate_findings_have_one_shape_at_every_size(spark, size):
    from dqspark.plans.checker import count_checks, run_all_checks
    from dqspark.plans.sinks import json_records, report_preview

    people = [patient(f"p{i:03d}", name="Same Name") for i in range(size)] + [patient(f"q{i}", name="Twin") for i in range(2)]
    tables = {
        "patient_records": spark.createDataFrame(people, PATIENT_SCHEMA),
        "claims": spark.createDataFrame([], CLAIM_SCHEMA),
        "claims_line_items": spark.createDataFrame([], LINE_SCHEMA),
        "providers": spark.createDataFrame(
            [], "provider_id string, provider_name string, specialty string, npi_number string, license_number string, "
                "license_state string, license_expiry_date date, contact_email string, is_active boolean"),
    }
    for run in (run_all_checks(tables, AS_OF), run_all_checks(tables, AS_OF, materialize=True)):
        found = {r["check_key"]: r["issues_found"] for r in run.check_counts.collect()}
        assert found["duplicate_records"] == 2
        assert run.summary.first()["total_duplicates"] == size + 2
        audit = run.audit.filter("check_type = 'duplicate_check'").orderBy("audit_id").collect()
        assert [(r["audit_id"], r["record_id"], r["issue_description"]) for r in audit] == [
            (1, "p000", f"Duplicate patients found: p000, more: {size - 1}"), (2, "q0", "Duplicate patients found: q0, more: 1")]
        preview = report_preview(run).filter("check_key = 'duplicate_records'").orderBy("preview_rank").collect()
        assert sorted(r["record_id"] for r in preview) == ["p000", "q0"]
        check = run.checks["duplicate_records"]
        assert check.details.columns == ["name", "date_of_birth", "duplicate_count", "first_id"]
        assert check.details.count() == json_records(check.details).count() == 2
        assert sorted(r["patient_id"] for r in check.members().collect()) == sorted(p[0] for p in people)
    counts, summary = count_checks(tables, AS_OF)
    assert {r["check_key"]: r["issues_found"] for r in counts.collect()} == found
    assert summary.first().asDict() == {k: v for k, v in run.summary.first().asDict().items() if k != "run_timestamp"}


def test_duplicate_record_details_list_every_id(spark):
    from dqspark.operators import findings as FND

    people = ([patient(f"p{i:03d}", name="Same Name") for i in reversed(range(150))] + [patient("q1", name="Twin"), patient("q0", name="Twin")]
              + [patient("q0", name="Again")] * 2 + [patient("s", name="Single"), patient("n0", name=None), patient("n1", name=None)])
    out = FND.duplicate_record_lists(spark.createDataFrame(people, PATIENT_SCHEMA))
    assert out.columns == ["name", "date_of_birth", "duplicate_count", "first_id", "patient_ids"]
    assert {r["name"]: (r["duplicate_count"], r["first_id"], r["patient_ids"]) for r in out.collect()} == {
        "Same Name": (150, "p000", [f"p{i:03d}" for i in range(150)]), "Twin": (2, "q0", ["q0", "q1"]), "Again": (2, "q0", ["q0", "q0"])}


def test_expired_licenses_and_incomplete_providers(spark):
    df = spark.createDataFrame([
        ("D1", "a", "Cardiology", "1", "L1", "CA", D(2024, 1, 31), "x@y.org", True),
        ("D2", "b", None, "2", "L2", "CA", AS_OF, None, True),
        ("D3", "c", "Cardiology", None, None, "CA", D(2020, 1, 1), "x@y.org", False),
    ], "provider_id string, provider_name string, specialty string, npi_number string, license_number string, "
       "license_state string, license_expiry_date date, contact_email string, is_active boolean")
    out = V.expired_licenses(df, AS_OF).collect()
    assert [(r["provider_id"], r["days_expired"]) for r in out] == [("D1", 1)]
    inc = {r["provider_id"]: r["missing_fields"] for r in V.incomplete_providers(df).collect()}
    assert inc == {"D2": ["specialty", "contact_email"]}
    issue = FND.check_provider_credentials(df, AS_OF).issues.first()
    assert issue["issue_description"] == "License expired 1 days ago" and issue["severity"] == "CRITICAL"


def test_sort_option_applies_reference_order(spark):
    claims = spark.createDataFrame([claim("a", "60000.00"), claim("b", "90000.00"), claim("c", "70000.00")],
                                   CLAIM_SCHEMA)
    assert [r["claim_id"] for r in C.high_amount_claims(claims, sort=True).collect()] == ["b", "c", "a"]


def test_incomplete_patients_desc_puts_null_created_first(spark):
    rows = [patient("old", name=None), patient("new", name=None), patient("nocreated", name=None)]
    rows[1] = rows[1][:7] + (dt.datetime(2023, 1, 1),) + rows[1][8:]
    rows[2] = rows[2][:7] + (None,) + rows[2][8:]
    df = spark.createDataFrame(rows, PATIENT_SCHEMA)
    assert [r["patient_id"] for r in P.incomplete_patients(df, sort=True).collect()] == ["nocreated", "new", "old"]


def test_all_fields_missing(spark):
    df = spark.createDataFrame([patient("none", name=None, dob=None, ins=None, prov=None, phone=None, email=None)],
                               PATIENT_SCHEMA)
    row = FND.check_patient_completeness(df).issues.first()
    assert row["severity"] == "HIGH"
    assert row["issue_description"] == ("Missing fields: name, date_of_birth, insurance_id, primary_provider, "
                                        "contact_info")
    assert P.missing_field_counts(df).first()["missing_fields_count"] == 4


def test_run_on_empty_tables_passes(spark):
    from dqspark.plans.checker import run_all_checks

    tables = {
        "patient_records": spark.createDataFrame([], PATIENT_SCHEMA),
        "claims": spark.createDataFrame([], CLAIM_SCHEMA),
        "claims_line_items": spark.createDataFrame([], LINE_SCHEMA),
        "providers": spark.createDataFrame(
            [], "provider_id string, provider_name string, license_number string, license_state string, "
                "license_expiry_date date, is_active boolean"),
    }
    run = run_all_checks(tables, AS_OF)
    s = run.summary.first()
    assert (s["total_issues_found"], s["status"], s["total_discrepancy"], s["total_duplicates"]) == \
        (0, "PASS", Decimal("0.00"), 0)
    assert sorted(r["issues_found"] for r in run.check_counts.collect()) == [0] * 5
    assert run.audit.count() == 0


def test_updates_fail_on_a_repeated_key(spark):
    from dqspark.operators.updates import apply_updates

    base = spark.createDataFrame([("k1", 1), ("k2", 2)], "id string, v int")
    once = spark.createDataFrame([("k1", 5), (None, 7), (None, 8)], "id string, v int")
    out = apply_updates(base, once, "id", AS_OF, touch_column=None)
    assert sorted(map(tuple, out.collect())) == [("k1", 5), ("k2", 2)]
    twice = once.unionByName(spark.createDataFrame([("k1", 6)], "id string, v int"))
    for insert in (False, True):
        with pytest.raises(Exception, match="repeated update key id=k1"):
            apply_updates(base, twice, "id", AS_OF, touch_column=None, insert_missing=insert).collect()


def test_salted_anti_join_gives_the_same_orphans(spark):
    from dqspark.operators.core import orphans

    rows = [claim(f"h{i}", pid="HOT") for i in range(40)] + [claim("o1", pid="GONE"), claim("n1", pid=None)]
    claims = spark.createDataFrame(rows, CLAIM_SCHEMA)
    patients = spark.createDataFrame([patient("HOT")], PATIENT_SCHEMA)
    plain = ids(orphans(claims, patients, "patient_id"), "claim_id")
    salted = ids(orphans(claims, patients, "patient_id", salt_buckets=8), "claim_id")
    assert plain == salted == ["n1", "o1"]


def test_constraint_edges(spark):
    from dqspark.operators import constraints as K

    df = spark.createDataFrame([
        ("r1", 99999999.99, None, "ok", "PAID"),
        ("r2", 100000000.00, None, "x" * 11, "VOID"),
        ("r3", 1.005, "n", None, None),
        ("r3", -99999999.994, "n", "ok", "PAID"),
    ], "id string, amount double, note string, code string, status string")
    # overflow is rejected; extra scale only rounds (half up, still fits)
    bad = K.check_decimal_range(df, ["amount"], 10, 2, "id").collect()
    assert [(r["id"], r["column_name"]) for r in bad] == [("r2", "amount")]
    both = {(r["id"], r["column_name"]) for r in K.check_not_null(df, ["note", "code"], "id").collect()}
    assert both == {("r1", "note"), ("r2", "note"), ("r3", "code")}
    longs = K.check_max_length(df, {"code": 10, "note": 0}, "id").collect()
    assert sorted((r["id"], r["column_name"], r["length"]) for r in longs) == [
        ("r2", "code", 11), ("r3", "note", 1), ("r3", "note", 1)]
    assert [r["id"] for r in K.check_domain(df, "status", ("PAID",), "id").collect()] == ["r2"]
    pk = {r["id"]: r["occurrences"] for r in K.check_primary_key(df, "id").collect()}
    assert pk == {"r3": 2}
    assert K.check_unique(df.withColumn("u", F.lit(None).cast("string")), "u").count() == 0


def test_conform_rounds_extra_scale_half_up(spark):
    from dqspark.sources.readers import conform

    df = spark.createDataFrame([("c1", "12.345"), ("c2", "12.344"), ("c3", "-0.005")],
                               "claim_id string, claim_total_amount string")
    got = {r["claim_id"]: r["claim_total_amount"] for r in conform(df, "claims", now="2024-02-01").collect()}
    assert got == {"c1": Decimal("12.35"), "c2": Decimal("12.34"), "c3": Decimal("-0.01")}
