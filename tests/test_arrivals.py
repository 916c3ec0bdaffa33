"""Tables that change: updates folder by folder, key counts over batches, the
log's history, orphans from one scan."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dqspark.operators import claims as C
from dqspark.operators import metrics as MT
from dqspark.operators import resolution as H
from dqspark.operators.core import orphans
from dqspark.operators.key_counts import add_batch, compact, merge_counts
from dqspark.operators.updates import BUCKET, apply_updates, store_by_key, touched_rows, update_stored

NOW = dt.datetime(2024, 2, 1, 12)
T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


def test_update_reads_and_replaces_only_touched_folders(spark, tables, scratch):
    path = os.path.join(scratch, "claims")
    base = tables.claims.withColumn("updated_at", F.lit(T0).cast("timestamp_ntz"))
    store_by_key(base, path, "claim_id", 16)

    def stored():
        return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    files = stored()
    updates = base.orderBy("claim_id").limit(2).select("claim_id", F.lit("DENIED").alias("status")).unionByName(
        spark.createDataFrame([(None, "X"), ("no such claim", "X")], "claim_id string, status string"))
    updates = spark.createDataFrame(updates.collect(), updates.schema)
    read = touched_rows(spark, path, updates, "claim_id", 16)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    hit = {r[0] for r in read.select(BUCKET).distinct().collect()}
    assert 1 <= len(hit) <= 3
    update_stored(spark, path, updates, "claim_id", 16, NOW)
    untouched = {f for f in files if int(os.path.dirname(f).rsplit("=", 1)[1]) not in hit}
    assert untouched == files & stored() and len(untouched) == 16 - len(hit)
    assert rows(spark.read.parquet(path).select(*base.columns)) == rows(apply_updates(base, updates, "claim_id", NOW))


def test_update_of_nothing_changes_nothing(spark, scratch):
    path = os.path.join(scratch, "t")
    base = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    store_by_key(base, path, "k", 4)
    update_stored(spark, path, base.limit(0), "k", 4, NOW, touch_column=None)
    assert rows(spark.read.parquet(path).select("k", "v")) == rows(base)
    update_stored(spark, path, spark.createDataFrame([("b", 5), (None, 6)], "k string, v int"), "k", 4, NOW, touch_column=None, insert_missing=True)
    assert rows(spark.read.parquet(path).select("k", "v")) == Counter({("a", "1"): 1, ("None", "2"): 1, ("b", "5"): 1})


def test_batches_give_the_keys_of_the_whole(spark, scratch):
    data = [(k, f"id{i:02d}", i % 4) for i, k in enumerate(["a", "b", None, "a", "c", None, "b", "a", "hot", "hot", "d"] + ["hot"] * 20)]
    df = spark.createDataFrame(data, "k string, id string, b int")
    path, found = os.path.join(scratch, "counts"), []
    for b in range(4):
        batch = df.filter(F.col("b") == b)
        for _ in range(2):                      # a replay changes nothing
            new = {(r["k"], r["n"], r["first_id"]) for r in add_batch(spark, path, batch, b, ["k"], "id").collect()}
        found += [(b, *x) for x in new]
    want = []
    for k in {k for k, _, _ in data}:
        mine = sorted((b, i) for kk, i, b in data if kk == k)
        if len(mine) > 1:
            since = mine[1][0]
            upto = [i for b, i in mine if b <= since]
            want.append((since, k, len(upto), min(upto)))
    assert sorted(found, key=str) == sorted(want, key=str)
    whole = {(r["k"], r["n"]) for r in merge_counts(spark.read.parquet(path)).filter("n > 1").collect()}
    assert whole == {(k, n) for k, n in Counter(k for k, _, _ in data).items() if n > 1}
    compact(spark, path, path + "-2", 1, ["k"])
    assert rows(merge_counts(spark.read.parquet(path + "-2"))) == rows(merge_counts(spark.read.parquet(path)))
    assert add_batch(spark, path + "-2", df.limit(0), 9, ["k"], "id").count() == 0


FINDINGS = ("audit_id long, check_timestamp timestamp_ntz, check_type string, issue_type string, status string, assigned_to string, "
            "resolution_notes string, resolved_at timestamp_ntz")
EVENTS = "event_id long, audit_id long, event_time timestamp_ntz, status string, assigned_to string, resolution_notes string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


@pytest.fixture()
def history(spark):
    findings = spark.createDataFrame([(i, T0, "c", "x", "OPEN", None, None, None) for i in (1, 2, 3, 4)], FINDINGS)
    events = spark.createDataFrame([
        (10, 1, at(1), "IN_PROGRESS", "ann", None), (11, 1, at(5), "RESOLVED", None, "fixed"),
        (12, 2, at(2), "RESOLVED", "bob", "done"), (13, 2, at(3), "OPEN", None, "back again"),
        (14, 3, at(4), "IN_PROGRESS", None, None), (15, 3, at(4), "RESOLVED", None, None),       # one time: the larger id
        (16, 99, at(1), "RESOLVED", None, None)], EVENTS)
    return findings, events


def test_current_state_follows_the_latest_event(history):
    log = {r["audit_id"]: r for r in H.current_log(*history).collect()}
    assert (log[1]["status"], log[1]["assigned_to"], log[1]["resolution_notes"], log[1]["resolved_at"]) == ("RESOLVED", "ann", "fixed", at(5))
    assert (log[2]["status"], log[2]["assigned_to"], log[2]["resolution_notes"], log[2]["resolved_at"]) == ("OPEN", "bob", "back again", None)
    assert (log[3]["status"], log[3]["resolved_at"]) == ("RESOLVED", at(4))
    assert (log[4]["status"], log[4]["resolved_at"]) == ("OPEN", None) and set(log) == {1, 2, 3, 4}
    times = {r["check_type"]: (r["resolved_count"], r["avg_resolution_hours"]) for r in MT.resolution_times(H.current_log(*history)).collect()}
    assert times == {"c": (2, 4.5)}


def test_timeline_and_time_in_status(history):
    line = H.status_timeline(*history)
    got = sorted((r["audit_id"], r["entry_no"], r["status"], r["valid_from"], r["valid_to"]) for r in line.filter("audit_id < 4").collect())
    assert [g[:3] for g in got] == [(1, 1, "OPEN"), (1, 2, "IN_PROGRESS"), (1, 3, "RESOLVED"), (2, 1, "OPEN"), (2, 2, "RESOLVED"), (2, 3, "OPEN"),
                                    (3, 1, "OPEN"), (3, 2, "IN_PROGRESS"), (3, 3, "RESOLVED")]
    assert [g[4] for g in got] == [at(1), at(5), None, at(2), at(3), None, at(4), at(4), None]
    stays = {r["status"]: (r["stays"], r["avg_hours"]) for r in H.time_in_status(line).collect()}
    assert stays == {"OPEN": (3, 2.33), "IN_PROGRESS": (2, 2.0), "RESOLVED": (1, 1.0)}


def test_empty_history(spark, history):
    findings, events = history
    assert rows(H.current_log(findings, events.limit(0))) == rows(findings)
    assert H.status_timeline(findings, events.limit(0)).count() == 4 and H.status_timeline(findings.limit(0), events).count() == 0


def test_a_rerun_keeps_resolutions(spark, tables, scratch):
    """The same run written again has the same ids, so its events still apply."""
    from dqspark.plans import sinks
    from dqspark.plans.checker import run_all_checks

    path = os.path.join(scratch, "log")
    sinks.append_audit(run_all_checks(tables, dt.date(2024, 2, 1), run_id="r").audit, path)
    log = spark.read.parquet(path)
    first = log.orderBy("audit_id").first()
    events = spark.createDataFrame([(1, first["audit_id"], at(1), "RESOLVED", None, None)], EVENTS)
    sinks.append_audit(run_all_checks(tables, dt.date(2024, 2, 1), run_id="r", materialize=True).audit, path)
    done = H.current_log(spark.read.parquet(path), events).filter("status = 'RESOLVED'").collect()
    assert [(r["audit_id"], r["check_type"], r["record_id"]) for r in done] == [(first["audit_id"], first["check_type"], first["record_id"])]


def test_orphans_scan_the_child_once_and_spread_null_keys(spark, tables, scratch):
    path = os.path.join(scratch, "claims")
    tables.claims.write.parquet(path)
    stored = spark.read.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = C.orphan_claims_patient(stored, tables.patient_records)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"[file:{path}]") == 1 and "LeftAnti" in plan
        nulls = spark.range(20_000).select(F.lit(None).cast("string").alias("k"), "id")
        parents = spark.createDataFrame([("a",)], "k string")
        out = orphans(nulls.unionByName(spark.createDataFrame([("a", 1), ("b", 2)], "k string, id long")), parents, "k")
        assert out.count() == 20_001
        assert orphans(nulls, parents, "k", null_passes=True).count() == 0
        assert orphans(nulls, parents, "k", salt_buckets=3).count() == 20_000
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_streams_of_two_checkpoints_both_add_rows(spark, tables, scratch):
    from dqspark.streaming.incremental import start_audit_stream

    src, sink = os.path.join(scratch, "src"), os.path.join(scratch, "sink")
    tables.providers.coalesce(1).write.parquet(src)
    for n in range(2):
        start_audit_stream(spark, "providers", src, sink, os.path.join(scratch, f"ckpt{n}")).awaitTermination(120)
    log = spark.read.parquet(sink)
    assert log.select("run_id").distinct().count() == 2 and log.count() % 2 == 0
    assert "batch_id" not in log.columns
    assert log.agg(F.max("check_timestamp")).first()[0].date() == dt.date.today()
