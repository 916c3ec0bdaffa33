"""Strict reads and the split of raw rows: each file by its own header or
footer, values that don't fit refused or set aside with their reasons."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dqspark.operators import constraints as K
from dqspark.sources.intake import take_in
from dqspark.sources.readers import SchemaMismatch, check_types, conform, read_csv_text, read_table

HEADER = "claim_id,patient_id,claim_total_amount,service_date,submission_date,status"


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(os.path.join(folder, name), "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_files_are_read_by_their_own_headers(spark, scratch):
    folder = os.path.join(scratch, "claims")
    write(folder, "a.csv", HEADER, "C1,P1,10.50,2024-01-01,2024-01-02,PAID")
    write(folder, "b.csv", "patient_id,claim_id,note,service_date,submission_date,claim_total_amount",
          'P2,C2,"a, b",2024-01-03,2024-01-04,7')
    write(folder, "c.csv.gz", "﻿" + HEADER, "C3,,,2024-01-05,2024-01-06,")
    open(os.path.join(folder, "empty.csv"), "w").close()
    rows = {r["claim_id"]: r for r in read_table(spark, folder, "claims", "csv").collect()}
    assert {k: r["patient_id"] for k, r in rows.items()} == {"C1": "P1", "C2": "P2", "C3": None}
    assert rows["C2"]["claim_total_amount"] == Decimal("7.00") and rows["C2"]["status"] is None
    assert rows["C1"]["service_date"] == dt.date(2024, 1, 1)
    assert conform(read_table(spark, folder, "claims", "csv"), "claims").count() == 3


@pytest.mark.parametrize("line", ["C9,P1,n/a,2024-01-01,2024-01-02,PAID", "C9,P1,123456789012,2024-01-01,2024-01-02,PAID",
                                  "C9,P1,1,2024-02-30,2024-01-02,PAID", "C9,P1,1,2024-01-01"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_malformed_csv_value_fails_the_read(spark, scratch, line, ansi):
    folder = os.path.join(scratch, "bad")
    write(folder, "a.csv", HEADER, line)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            read_table(spark, folder, "claims", "csv").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_repeated_header_name_is_refused(spark, scratch):
    folder = os.path.join(scratch, "twice")
    write(folder, "a.csv", "claim_id,claim_id", "1,2")
    with pytest.raises(SchemaMismatch, match="repeated column"):
        read_table(spark, folder, "claims", "csv")


@pytest.mark.parametrize("expr,wrong", [("CAST(1.5 AS double) AS claim_total_amount", "double"), ("CAST(1 AS string) AS service_date", "string"),
                                        ("current_timestamp() AS service_date", "timestamp"), ("5 AS status", "int"),
                                        ("CAST(1.234 AS decimal(10,3)) AS claim_total_amount", "decimal(10,3)")])
def test_parquet_types_that_lose_value_are_refused(spark, scratch, expr, wrong):
    path = os.path.join(scratch, "claims")
    spark.sql(f"SELECT 'C1' AS claim_id, {expr}").write.parquet(path)
    with pytest.raises(SchemaMismatch) as err:
        read_table(spark, path, "claims")
    assert f"is {wrong}" in str(err.value)


def test_parquet_files_may_lack_columns_and_lossless_types_pass(spark, scratch):
    path = os.path.join(scratch, "claims")
    spark.sql("SELECT 'C1' AS claim_id, 5 AS claim_total_amount").write.parquet(path)
    spark.sql("SELECT 'C2' AS claim_id, DATE '2024-01-01' AS service_date").write.mode("append").parquet(path)
    rows = {r["claim_id"]: r for r in conform(read_table(spark, path, "claims"), "claims").collect()}
    assert rows["C1"]["claim_total_amount"] == Decimal("5.00") and rows["C2"]["service_date"] == dt.date(2024, 1, 1)
    with pytest.raises(SchemaMismatch):
        check_types(spark.sql("SELECT CAST(1 AS bigint) AS quantity"), "claims_line_items")


RAW = [("C1", "10.005", "2024-01-01", "2024-01-02", "PAID", "99213"), ("C2", "123456789.00", "2024-02-30", None, "VOID", "X" * 11),
       (None, "abc", "2024-01-01", "2024-01-02", None, None), ("C4", None, None, "2024-01-02", "DENIED", "1")]
RAW_SCHEMA = "claim_id string, claim_total_amount string, service_date string, submission_date string, status string, procedure_code string"


def test_intake_splits_rows_and_keeps_raw_values(spark):
    got = take_in(spark.createDataFrame(RAW, RAW_SCHEMA), "claims", now="2024-02-01")
    rows = got.accepted.collect()
    assert [r["claim_id"] for r in rows] == ["C1"]
    assert rows[0]["claim_total_amount"] == Decimal("10.01") and rows[0]["adjustment_amount"] == 0     # rounded half up, default
    rejected = {r["record_id"]: r for r in got.rejected.collect()}
    assert rejected["C2"]["reasons"] == [
        "claim_total_amount: decimal_range 123456789.00", "service_date: type 2024-02-30", "submission_date: not_null",
        "status: domain VOID", "procedure_code: max_length 11"]
    assert rejected[None]["reasons"] == ["claim_id: not_null", "claim_total_amount: type abc"]
    assert json.loads(rejected["C4"]["raw"]) == dict(zip(RAW_SCHEMA.replace(" string", "").split(", "), RAW[3]))
    kinds = {(r["record_id"], r["constraint_type"], r["column_name"]) for r in got.violations.collect()}
    assert ("C4", "not_null", "service_date") in kinds and len(kinds) == 8
    assert got.accepted.count() + got.rejected.count() == len(RAW)


def test_intake_of_absent_columns_extra_columns_and_empty_tables(spark):
    lines = spark.createDataFrame([(1, "C1", "x")], "line_item_id long, claim_id string, _violations string")
    got = take_in(lines, "claims_line_items")
    assert got.accepted.count() == 0 and got.rejected.first()["reasons"] == ["procedure_code: not_null column is absent"]
    assert json.loads(got.rejected.first()["raw"])["_violations"] == "x"
    assert take_in(lines.limit(0), "claims_line_items").rejected.count() == 0
    ok = take_in(lines.withColumn("procedure_code", F.lit("1")), "claims_line_items", materialize=False)
    assert ok.accepted.first()["quantity"] == 1 and ok.rejected.count() == 0


def test_intake_of_csv_goes_on_where_the_strict_read_fails(spark, scratch):
    folder = os.path.join(scratch, "claims")
    write(folder, "a.csv", HEADER, "C1,P1,10.50,2024-01-01,2024-01-02,PAID", "C2,P1,n/a,2024-01-01,2024-01-02,PAID")
    got = take_in(read_csv_text(spark, folder, "claims"), "claims")
    assert [r["claim_id"] for r in got.accepted.collect()] == ["C1"] and [r["record_id"] for r in got.rejected.collect()] == ["C2"]


def test_daily_run_sets_rejected_rows_aside(spark, tables, scratch):
    from dqspark.plans.daily_run import daily_run, load_tables

    root = os.path.join(scratch, "tables")
    for name in ("patient_records", "providers", "claims_line_items", "encounters"):
        getattr(tables, name).withColumn("procedure_code", F.lit("1")).write.parquet(os.path.join(root, name))
    tables.raw_claims.write.parquet(os.path.join(root, "claims"))
    with pytest.raises(SchemaMismatch):
        load_tables(spark, root)
    loaded = load_tables(spark, root, rejects=os.path.join(scratch, "rejected"))
    back = spark.read.json(os.path.join(scratch, "rejected", "claims"))
    want = take_in(tables.raw_claims, "claims")
    assert back.count() == want.rejected.count() > 0 and loaded.claims.count() == want.accepted.count()
    run = daily_run(loaded, dt.date(2024, 2, 1), os.path.join(scratch, "out"), run_id="d")
    assert run.summary.first()["status"] == "FAIL"


def test_absent_columns_and_parents_are_reported(spark):
    lines = spark.createDataFrame([(1, "C1"), (2, "C2")], "line_item_id long, claim_id string")
    found = {(r["constraint_type"], r["column_name"], r["record_id"], r["detail"]) for r in K.check_table(lines, "claims_line_items").collect()}
    assert found == {("not_null", "procedure_code", "1", "column is absent"), ("not_null", "procedure_code", "2", "column is absent"),
                     ("foreign_key", "claim_id", None, "not checked: claims is not given")}
    assert K.check_not_null(lines, ["procedure_code"], "line_item_id").count() == 2
