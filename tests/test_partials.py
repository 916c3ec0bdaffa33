"""Daily partials: any split of the days gives the numbers of one pass."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dqspark.operators import metrics as MT
from dqspark.operators import partials as D


def rows(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_split_of_the_days_gives_the_same_numbers(tables, parts):
    log, t = tables.quality_audit_log, tables
    merged = D.merge(*[D.log_partials(log.filter(F.pmod(F.dayofyear("check_timestamp"), F.lit(parts)) == i)) for i in range(parts)])
    assert rows(D.weekly_trend(merged)) == rows(MT.weekly_error_trend(log))
    assert rows(D.resolution_times(merged)) == rows(MT.resolution_times(log))
    records = D.merge(*[D.record_partials(t.patient_records.filter(F.crc32("patient_id") % parts == i),
                                          t.claims.filter(F.crc32("claim_id") % parts == i),
                                          t.providers.filter(F.crc32("provider_id") % parts == i)) for i in range(parts)])
    assert rows(D.completeness_rates(records)) == rows(MT.completeness_rates(t.patient_records, t.claims, t.providers))


def test_a_changed_day_is_replaced_alone(spark, tables, scratch):
    path, log = os.path.join(scratch, "partials"), tables.quality_audit_log
    D.store(D.log_partials(log), path)
    day = log.select(F.to_date("check_timestamp")).first()[0]
    one = log.filter(F.to_date("check_timestamp") == F.lit(day))
    D.store(D.log_partials(one.unionByName(one)), path)
    again = log.unionByName(one)
    stored = spark.read.parquet(path)
    assert rows(D.weekly_trend(stored)) == rows(MT.weekly_error_trend(again))
    D.store(D.log_partials(one), path)
    assert rows(D.weekly_trend(spark.read.parquet(path))) == rows(MT.weekly_error_trend(log))


def test_empty_log_has_no_partials(tables):
    none = D.log_partials(tables.quality_audit_log.limit(0))
    assert none.count() == 0 and D.weekly_trend(none).count() == 0 and D.resolution_times(none).count() == 0
